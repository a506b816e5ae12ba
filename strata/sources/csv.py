"""Delimited-text scans (S1-S3) and the landing-file writer used by stand-in runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import CSV_OPTIONS
from strata.specs import TableSpec

PERMISSIVE = "PERMISSIVE"
DROPMALFORMED = "DROPMALFORMED"
FAILFAST = "FAILFAST"
CORRUPT = "_corrupt_record"
ARRIVAL = "_arrival"
ARRIVAL_TYPE = "struct<load: bigint, time: timestamp, path: string, block: bigint, row: bigint>"


def read_csv(spark: SparkSession, path, schema: T.StructType | TableSpec,
             multiline: bool | None = None, mode: str = PERMISSIVE,
             corrupt_column: str | None = None, header: bool = True) -> DataFrame:
    """CSV with a declared schema; the header line is skipped unread.

    Short rows are padded with null and long rows cut (``PERMISSIVE``). With
    ``corrupt_column`` the raw text of such rows is kept in that column, so bad
    rows can be routed with one filter (``reject_rows``). ``multiline`` is needed when
    quoted fields hold newlines; a quoted field may span any split, so Spark reads such
    files one task per file: ``multiline.read_multiline`` reads a large one in splits.
    """
    if isinstance(schema, TableSpec):
        if multiline is None:
            multiline = schema.multiline
        schema = schema.raw_schema
    if corrupt_column:
        schema = T.StructType(list(schema.fields) +
                              [T.StructField(corrupt_column, T.StringType(), True)])
    reader = (spark.read.schema(schema).options(**CSV_OPTIONS)
              .option("header", str(header).lower())
              .option("multiLine", str(bool(multiline)).lower())
              .option("mode", mode)
              .option("enforceSchema", "true"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def file_place() -> Column:
    """Where a row comes from: file time, path and split. Only directly above a file scan."""
    meta = F.col("_metadata")
    return F.struct(meta["file_modification_time"].alias("time"), meta["file_path"].alias("path"),
                    meta["file_block_start"].alias("block"))


def arrival(place: Column, load: int | None = None) -> Column:
    """The place of a row in the order of arrival: load, file time, path, place in the file.

    Only on the rows as a scan gives them. A split's rows are read in order by one task,
    so the task's running number orders them; splits of a file are ordered by their start.
    """
    return F.struct(F.lit(load).cast("bigint").alias("load"), place["time"].alias("time"),
                    place["path"].alias("path"), place["block"].alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def with_source_order(df: DataFrame, load: int | None = None) -> DataFrame:
    """Add ``ARRIVAL``: "last" among the rows of a key means the one that came last."""
    return df.select("*", arrival(file_place(), load).alias(ARRIVAL))


def reject_rows(rows: DataFrame, fields: int) -> DataFrame:
    """(line, reason, time, path, block, row): the malformed ones of ``rows`` (which have ``CORRUPT``
    and ``ARRIVAL``), as their raw text, with what is wrong and where they are.

    Separators count outside of quotes: too few make a row ``short``, too many ``long``; a quote
    that does not close is an ``open quote``; what else the parser refused is ``malformed``."""
    line = F.col(CORRUPT)
    bare = F.regexp_replace(line, '"[^"]*"', "")             # a doubled quote is two quoted parts
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (F.when(bare.contains('"'), F.lit("open quote")).when(found < fields, F.lit("short"))
              .when(found > fields, F.lit("long")).otherwise(F.lit("malformed")))
    return (rows.where(line.isNotNull())
            .select(line.alias("line"), reason.alias("reason"),
                    *[F.col(ARRIVAL)[c].alias(c) for c in ("time", "path", "block", "row")]))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none",
              by: tuple[str, ...] = ()) -> str:
    """Write a frame as headed CSV in the feeds' dialect (a landing drop), in a folder for each value
    of ``by``."""
    (df.write.mode(mode).partitionBy(*by).options(**CSV_OPTIONS).option("header", "true")
     .option("nullValue", "").option("emptyValue", '""').option("compression", compression).csv(path))
    return path


def write_text_lines(df: DataFrame, column: str, path: str) -> str:
    """Write one text column as plain lines (no header, no quoting)."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path
