"""Sinks: layer versions (K1), published tables (K3) and the run log (K4)."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import layers

APPEND = "append"
OVERWRITE = "overwrite"
BUCKET_BYTES = 256 << 20     # of Parquet in a bucket, before its table is dealt to more of them
MAX_BUCKETS = 1 << 14        # folders that one listing can take
PUBLISHED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}
# of staged copies and layers, which this library reads: pages of version 2 hold sorted keys and
# running numbers as differences
PACKED = PUBLISHED | {"parquet.writer.version": "v2"}


def write_version(df: DataFrame, table_path: str, load: layers.Load | None = None,
                  sort_key=None, version: int | None = None, volume: int = 0) -> tuple[int, int]:
    """K1: write ``df`` as a new version of a layer table; return (version, rows written).

    The folder is this load's own: it is begun with the load's note, which fails if it is there,
    and seen once its ``_SUCCESS`` is. A table of several buckets (``load.buckets``) is dealt to
    them by ``load.key``; ``df`` then holds all rows of each bucket it has a row of. Rows that a
    merge has dealt already (``merge.keep_last_dealt``) have their ``BUCKET`` and are not shuffled
    again; others are dealt in tasks by their ``volume`` in memory. ``sort_key`` sorts each file's
    rows by the key (O1 for files), which the merge's window has done where there was one. Rows are
    counted by an ``Observation`` during the write.
    """
    spark = df.sparkSession
    version = version or layers.next_version(spark, table_path)
    dealt = layers.BUCKET in df.columns
    load = replace(load or layers.Load(id=uuid.uuid4().hex), schema=df.drop(layers.BUCKET).schema.json())
    keys = [] if sort_key is None else [sort_key] if isinstance(sort_key, str) else list(sort_key)
    order = [F.col(k).asc_nulls_first() for k in keys]       # as a window sorts: then not sorted again
    if load.buckets > 1:
        if not dealt and layers.parts_of(spark, volume):
            df = layers.deal(df, load.key, load.buckets, volume).drop(layers.CELL)
        elif not dealt:
            df = df.withColumn(layers.BUCKET, layers.bucket_of([F.col(k) for k in load.key], load.buckets))
            # a bucket in as many files as its rows fill, not one for each task that has a row of it
            df = df.hint("rebalance", layers.BUCKET)
        order = [F.col(layers.BUCKET), *order]
    if order:
        df = df.sortWithinPartitions(*order)
    obs = Observation(f"rows_{uuid.uuid4().hex}")     # unique: table jobs run concurrently
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    layers.note_load(spark, table_path, version, load)
    writer = counted.write.mode("append").options(**PACKED)
    if load.buckets > 1:
        writer = writer.partitionBy(layers.BUCKET)
    writer.parquet(layers.version_path(table_path, version))
    return version, int(obs.get["rows"])


class LayerLoad:
    """One load into a layer table: what is there, the buckets it meets, the version it writes."""

    def __init__(self, spark: SparkSession, table_path: str, keys: list[str], source: str | None = None,
                 merged: str | None = None, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path, self.keys = spark, table_path, keys
        self.bucket_bytes = bucket_bytes
        self.base = layers.latest_version(spark, table_path)
        self.before = layers.load_of(spark, table_path, self.base)
        if self.before and self.before.key and self.before.key != keys:
            raise layers.KeyMismatch(f"{table_path} is keyed by {self.before.key}, this load by {keys}: "
                                     "a lake keeps one key choice, start a new one to change it")
        self.version = layers.next_version(spark, table_path)
        name = uuid.uuid4().hex
        self.load = layers.Load(name, self.before.table if self.before else name, keys, source, merged)

    def plan(self, incoming: DataFrame | None, batch_bytes: int) -> DataFrame | None:
        """Fix the buckets; return the current rows that the batch's keys may meet (all of them where
        ``incoming``, the key columns in their order, is not given), or None on a first load.

        The number of buckets is a power of two by the table's size. When the buckets have grown to
        four times ``bucket_bytes`` the load writes the table anew in more of them."""
        if self.base is None:
            self.load = replace(self.load, buckets=self._buckets(batch_bytes))
            return None
        buckets = self.before.buckets if self.before else 1
        size = layers.size_of(self.spark, layers.folders(self.spark, self.path, self.base)) + batch_bytes
        if size > 4 * buckets * self.bucket_bytes:
            self.load = replace(self.load, buckets=self._buckets(size))
        elif buckets > 1:
            touched = None
            if incoming is not None:
                at = layers.bucket_of([F.col(f"`{c}`") for c in incoming.columns], buckets)
                touched = [r[0] for r in incoming.select(at.alias("b")).distinct().collect()]
            self.load = replace(self.load, buckets=buckets, whole=touched is None or len(touched) == buckets)
            return layers.read_layer(self.spark, self.path, below=self.version,
                                     buckets=None if self.load.whole else touched)
        return layers.read_layer(self.spark, self.path, below=self.version)

    def _buckets(self, size: int) -> int:
        wanted = -(-size // self.bucket_bytes)
        return min(MAX_BUCKETS, 1 << max(0, wanted - 1).bit_length())

    def write(self, rows: DataFrame, volume: int = 0, source_buckets: int = 0) -> int:
        """Write the version; return the rows that the table now has.

        Rows read from a layer of ``source_buckets`` by the same key, bucket by bucket, are not
        shuffled to buckets (as many there as here, or more, lie each in one of these), and, file by
        file in the order of the key, not sorted again where there is one bucket."""
        in_order = source_buckets > 0 and self.load.buckets == 1
        if 1 < self.load.buckets <= source_buckets:
            rows = rows.withColumn(layers.BUCKET, layers.bucket_of([F.col(k) for k in self.keys], self.load.buckets))
        _, written = write_version(rows, self.path, self.load, sort_key=None if in_order else self.keys,
                                   version=self.version, volume=volume)
        if self.load.whole:
            return written
        return layers.read_layer(self.spark, self.path, below=self.version + 1).count()   # file footers


def stage(df: DataFrame, path: str) -> DataFrame:
    """K2: materialise an incoming batch as Parquet beside the layer and read it back.

    The merge uses the batch more than once (the keep-last rows and the set of keys);
    reading a staged Parquet copy parses the source text once and lets the key pass
    read only the key columns. The stage also cuts the batch's lineage, so a retried
    merge task re-reads the stage, not the landing files. Drop it with
    ``layers.delete_path`` once the new version is written.
    """
    return staged(df, path)[0]


def staged(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """``stage``, and about how many bytes the rows' texts and numbers take in a plainly packed file (the
    staged copy's own files are smaller, the more so the better its rows are ordered)."""
    obs = Observation(f"staged_{uuid.uuid4().hex}")
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8)
             for f in df.schema.fields]
    total = F.sum(sum(sizes[1:], sizes[0]).cast("bigint"))
    df.observe(obs, total.alias("bytes")).write.mode("overwrite").options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), (obs.get["bytes"] or 0) // 2


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _check_schema(schema: T.StructType, wanted: T.StructType, what: str) -> None:
    if _types(schema) != _types(wanted):
        raise ValueError(f"{what} has columns {_types(wanted)}, the rows have {_types(schema)}")


def _restore(spark: SparkSession, path: str) -> None:
    """Put a table's rows back that an overwrite by path had set aside when it was ended."""
    fs, target = layers._fs(spark, path)
    _, aside = layers._fs(spark, f"{path.rstrip('/')}-before")
    if fs.exists(aside):
        if fs.exists(target):
            fs.delete(aside, True)
        elif not fs.rename(aside, target):
            raise OSError(f"cannot put {path}-before back")


def _replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a completely written folder in the place of another (two renames)."""
    fs, target = layers._fs(spark, path)
    _, aside = layers._fs(spark, f"{path.rstrip('/')}-before")
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"cannot move {path}")
    if not fs.rename(layers._fs(spark, new)[1], target):
        _restore(spark, path)
        raise OSError(f"cannot move {new} to {path}")
    fs.delete(aside, True)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _point(spark: SparkSession, table: str, folder: str, schema: T.StructType) -> None:
    """Make the catalog table read a complete folder: one change of the catalog, no data moves."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, folder, "parquet", schema)


def in_key_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """O1 for files: rows sorted by key (nulls last) over all files, so that each file, and each row
    group in it, holds a key range of its own and a reader of some keys skips the others by their
    footers. Range bounds come from Spark's sample of the keys; rows of equal keys may share a file
    with their neighbours only."""
    order = [F.col(k).asc_nulls_last() for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def publish(df: DataFrame, mode: str = APPEND, table: str | None = None,
            path: str | None = None, schema: T.StructType | None = None,
            sort_key: list[str] | None = None) -> int:
    """K3: publish refined rows; ``append`` adds (a rerun doubles), ``overwrite`` replaces.

    ``table`` writes a catalog table, whose data lie below ``path`` (else below the warehouse);
    ``path`` alone writes Parquet files. ``schema`` is the declared one; it and the columns of
    a table that exists are checked before anything is written. ``sort_key`` writes files of
    disjoint key ranges (one more shuffle). Returns the rows written.

    An overwrite never touches rows that can be read. Of a catalog table, it writes a complete new
    folder and then points the table there, one change in the catalog; the folder before it stays
    for readers in flight until the next overwrite. So at every moment, also when the job or its
    driver ends, the table has the old rows or the new ones. By path alone the new folder takes the
    old one's place by two renames: an end between them is mended by the next publish, and readers
    then find nothing meanwhile; on object stores, where a rename copies, give a ``table``.
    """
    if mode not in (APPEND, OVERWRITE):
        raise ValueError(f"mode must be 'append' or 'overwrite', got {mode!r}")
    if not (table or path):
        raise ValueError("give a table name or a path")
    spark = df.sparkSession
    if schema is not None:
        _check_schema(df.schema, schema, "the declared table")
    known = bool(table) and spark.catalog.tableExists(table)
    if not table:
        _restore(spark, path)
    there = known or not table and layers.exists(spark, path)
    if there and mode == APPEND:
        old = spark.table(table) if known else spark.read.parquet(path)
        _check_schema(df.schema, old.schema, table or path)
    if sort_key:
        df = in_key_ranges(df, sort_key)
    obs = Observation(f"published_{uuid.uuid4().hex}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if table and not (known and mode == APPEND):
        root = path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}.published"
        new = f"{root.rstrip('/')}/published-{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        before = _location(spark, table) if known else None
        try:
            counted.write.format("parquet").options(**PUBLISHED).save(new)
            _point(spark, table, new, df.schema)
        except Exception:
            layers.delete_path(spark, new)
            raise
        _drop_older(spark, root, {new, before})
    elif mode == APPEND or not there:
        writer = counted.write.mode(APPEND).format("parquet").options(**PUBLISHED)
        writer.saveAsTable(table) if table else writer.save(path)
    else:
        new = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
        try:
            counted.write.format("parquet").options(**PUBLISHED).save(new)
            _replace_folder(spark, new, path)
        finally:
            layers.delete_path(spark, new)
    return int(obs.get["rows"])


def _drop_older(spark: SparkSession, root: str, keep: set[str | None]) -> None:
    """Delete published folders but the current one and the one before it."""
    fs, p = layers._fs(spark, root)
    kept = {layers._fs(spark, k)[1].getName() for k in keep if k}
    for st in fs.listStatus(p):
        if st.getPath().getName() not in kept:
            fs.delete(st.getPath(), True)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("malformed", T.LongType()),      # raw steps: short or long landing rows
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
])


def run_log_frame(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """One row per (layer, table) step of a run: a handful of rows of metadata."""
    rows = [tuple(e.get(f.name) for f in RUN_LOG_SCHEMA.fields) for e in entries]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(spark: SparkSession, entries: list[dict], path: str) -> DataFrame:
    """K4: append the run's steps to the run-log table at ``path``."""
    frame = run_log_frame(spark, entries)
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame


def now() -> _dt.datetime:
    """Current time as an aware UTC datetime (stored as the same instant in any zone)."""
    return _dt.datetime.now(_dt.timezone.utc)
