"""Join sides with a measured size: broadcast only what is proven small.

``sized(df)`` measures a join side (rows and an upper bound of its bytes) and
returns it hinted ``broadcast`` when that bound is under the
session's ``spark.sql.autoBroadcastJoinThreshold``, else hinted ``merge`` (a
sort-merge join), so neither Catalyst's file-size estimate nor a stale statistic
can broadcast a side that grew with the data. A derived side (the result of a
join or aggregate) is first written as a Parquet table in the shared folder and
read back, so the measured rows are exactly the rows that are joined and the
lineage is cut; a side read from immutable files is measured as is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import temp_dir

ROW_OVERHEAD = 24        # bytes per row in a hashed relation, beyond the field data
FIELD_BYTES = 8          # fixed-width slot per field
HASH_FACTOR = 2          # hash table slack on top of the rows
NESTED_FACTOR = 8        # bytes for each character of a nested value's JSON text: a long is at
                         # least two characters ("1,"), a short string four, at 8 to 16 bytes


NESTED = (T.ArrayType, T.MapType, T.StructType)


@dataclass(frozen=True)
class Measured:
    frame: DataFrame
    rows: int
    bytes: int
    broadcast: bool


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (0 when broadcasting is off)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    text = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if text.endswith(suffix):
            return max(0, int(float(text[: -len(suffix)]) * units[suffix]))
    return max(0, int(float(text)))


def _row_bytes(df: DataFrame):
    parts = [F.lit(ROW_OVERHEAD)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.lit(FIELD_BYTES) + F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, NESTED):
            text = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
            parts.append(F.lit(FIELD_BYTES) + F.lit(NESTED_FACTOR) * F.octet_length(text))
        else:
            parts.append(F.lit(FIELD_BYTES))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("bigint")


def _fixed_row_bytes(df: DataFrame) -> int:
    return ROW_OVERHEAD + FIELD_BYTES * len(df.schema.fields)


def _has_variable_width(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, (T.StringType, T.BinaryType, *NESTED)) for f in df.schema.fields)


def fits_broadcast(df: DataFrame, columns: list[str]) -> bool:
    """May these columns fit a broadcast? By the row count (Parquet answers it without reading the
    rows) and the fixed part of a row; False is certain, and saves making and measuring the side."""
    return df.count() * _fixed_row_bytes(df.select(*columns)) * HASH_FACTOR <= broadcast_limit(df.sparkSession)


def sized(df: DataFrame, materialize: bool = False, limit: int | None = None) -> Measured:
    """Measure ``df`` and hint it for a join: broadcast if proven small, else merge.

    For a side read from files the row count comes first (Parquet answers it from
    file footers); if rows times the fixed part of a row already exceed the limit,
    or the side has no such columns, that decides it without reading data. Only a
    side that may fit and has text or nested columns has those columns' sizes summed
    (nested values by the length of their JSON text, which bounds them).
    """
    spark = df.sparkSession
    cap = broadcast_limit(spark) if limit is None else limit
    if not materialize:
        rows = df.count()
        floor = rows * _fixed_row_bytes(df) * HASH_FACTOR
        if rows == 0 or floor > cap or not _has_variable_width(df):
            small = rows == 0 or 0 < floor <= cap
            return Measured(F.broadcast(df) if small else df.hint("merge"), rows, floor, small)
    measures = [F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")]
    if materialize:
        # one job: the rows are written as a Parquet table in the shared folder and
        # measured on the way (an eager RDD checkpoint would compute its input twice)
        path = temp_dir(spark, "sized")
        obs = Observation(f"sized_{uuid.uuid4().hex}")
        df.observe(obs, *measures).write.parquet(path)
        stats = obs.get
        df = spark.read.parquet(path)
    else:
        stats = df.agg(*measures).collect()[0].asDict()
    rows, size = int(stats["n"]), int(stats["b"]) * HASH_FACTOR
    small = 0 < size <= cap or rows == 0
    return Measured(F.broadcast(df) if small else df.hint("merge"), rows, size, small)
