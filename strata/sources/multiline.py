"""S1 for a large file with newlines inside quoted fields: one file read by many tasks.

Spark reads such a file (``multiLine``) in one task, for a split may begin inside a quoted field.
Here the file is read as lines, in splits:

1. The quotes of each split are counted (partial sums; one row for each split). A running sum over
   a file's splits says which of them begin inside a quoted field: those with an odd number of
   quotes before them.
2. In each split a running sum of the quotes says for every line whether it begins a record. The
   lines of a record are put together again.
3. The pieces of records that reach over split ends (two for each split at most, and splits that
   lie inside one field) are put together by a second, much smaller grouping.

Then each record is parsed by ``from_csv``. All of this is built-in expressions; the feed is
shuffled once, by split.

A landing whose files are each no larger than a split has one task for each file either way: there
Spark's own reader takes the records as they stand, and no text is shuffled (``in_whole_files``).

In the feeds' dialect a quote stands around a field or is doubled inside one, so quotes alternate
between opening and closing. A file with an odd number of quotes has a field that never closes: its
record reaches to the file's end and is malformed, as ``multiLine`` reads it. A lone quote inside
an unquoted value, which the dialect does not have, opens a field here (in a file read whole it is a
character). Newlines inside a field stay as they are (``multiLine`` makes each a ``\\n`` in files whose
lines end in ``\\r\\n``, so files with a ``\\r`` are always read in splits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import CSV_OPTIONS
from strata.operators.joins import sized
from strata.sources import layers
from strata.sources.csv import ARRIVAL, CORRUPT, PERMISSIVE, file_place, read_csv, with_source_order


def records(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """(record, time, path, block, row): each record's text, and the place where it begins.

    The first record of a file is left out with ``header``, empty lines always."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", file_place().alias("place"), F.monotonically_increasing_id().alias("row"))
             .select("value", "place.*", "row",
                     (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit(""))))
                     .cast("bigint").alias("quotes")))
    # 1. which splits begin inside a field: one row for each split
    splits = lines.groupBy("path", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("path", "block", F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("open"))
    starts = sized(starts, materialize=True).frame
    # 2. records within a split; 0 is what belongs to the record before
    placed = lines.join(starts, ["path", "block"], "left")
    opened = F.coalesce("open", F.raise_error(F.lit("the file's splits changed while it was read"))
                        .cast("bigint"))
    split = Window.partitionBy("path", "block").orderBy("row")
    so_far = F.sum("quotes").over(split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = placed.withColumn("after", (opened + so_far) % 2)
    counted = counted.withColumn("begins", ((F.col("after") + F.col("quotes")) % 2 == 0).cast("bigint"))
    numbered = counted.withColumn("record", F.sum("begins").over(
        split.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pieces = (numbered.groupBy("path", "block", "record").agg(
        F.sort_array(F.collect_list(F.struct("row", "value"))).alias("lines"), F.min("time").alias("time"),
        F.min("row").alias("row"), F.max(F.struct("row", "after"))["after"].alias("after"))
        .select("path", "block", "record", "time", "row", (F.col("after") == 0).alias("closed"),
                F.array_join("lines.value", "\n").alias("text")))
    whole = (F.col("record") > 0) & F.col("closed")
    # 3. records over split ends: a piece that begins one, and those that follow until the next
    file = Window.partitionBy("path").orderBy("block", "record")
    cut = pieces.where(~whole).withColumn("id", F.sum((F.col("record") > 0).cast("bigint")).over(file))
    stitched = (cut.groupBy("path", "id").agg(
        F.sort_array(F.collect_list(F.struct("block", "record", "text", "row"))).alias("parts"),
        F.min("time").alias("time"))
        .select("path", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["record"].alias("record"),
                "time", F.col("parts")[0]["row"].alias("row"), F.array_join("parts.text", "\n").alias("text")))
    found = pieces.where(whole).drop("closed").unionByName(stitched)
    if header:
        found = found.where(~((F.col("block") == 0) & (F.col("record") == 1)))
    record = F.regexp_replace("text", "\r$", "")
    return (found.select(record.alias("record"), "time", "path", "block", "row")
            .where(F.col("record") != ""))


def in_whole_files(spark: SparkSession, path: str) -> bool:
    """Is no file of a landing larger than a split, and is there no ``\\r`` in them?"""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if layers.largest_file(spark, path) > split:
        return False
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.where(F.col("value").contains("\r")).isEmpty()


def read_multiline(spark: SparkSession, path, schema: T.StructType, header: bool = True,
                   corrupt_column: str | None = CORRUPT, load: int | None = None,
                   whole_files: bool = False) -> DataFrame:
    """The rows of CSV files with newlines in quoted fields, in many tasks, with ``ARRIVAL``.

    As ``read_csv(multiline=True)``: short rows padded, long rows cut, both with their text in
    ``corrupt_column``. With ``whole_files`` a landing for which ``in_whole_files`` holds is read
    file by file, without a shuffle."""
    if whole_files and in_whole_files(spark, path):
        return with_source_order(read_csv(spark, path, schema, True, corrupt_column=corrupt_column,
                                          header=header), load)
    fields = list(schema.fields)
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
    options = CSV_OPTIONS | {"mode": PERMISSIVE} | (
        {"columnNameOfCorruptRecord": corrupt_column} if corrupt_column else {})
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    place = F.struct(F.lit(load).cast("bigint").alias("load"), "time", "path", "block", "row")
    return (records(spark, path, header)
            .select(F.from_csv("record", ddl, options).alias("r"), place.alias(ARRIVAL))
            .select("r.*", ARRIVAL))
