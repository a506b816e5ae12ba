"""Versioned layer tables on a shared file system (S4-S6, K1 layout).

A layer table is a folder of versions: ``<table>/version-000001/`` ... One load writes one
version in a folder of its own; the commit protocol writes ``_SUCCESS`` last, so a version is
seen when it is whole, and never changes after that. No job renames or overwrites a file that
another may read, so the layout needs nothing of a file system that an object store lacks.

A large table is dealt to hash buckets of its key. A load then writes only the buckets that its
batch meets (``version-000007/__bucket=12/``); the table's rows are, for each bucket, those of
the newest version that has it. Small tables have one bucket and no such folders.

``_load.json`` in a version says what the load was: the table's key, the stream batch it came
from, what it had merged. A replayed stream batch finds its version by that, or its stream's last
batch in ``_streams/`` once the version has been pruned.

One rule is the caller's: a table has one writer at a time (a run, or its stream). Readers need
no rule. Paths go through the Hadoop file system API, so any Hadoop URI works.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
CELL = "__strata_cell"
CELLS = 16               # parts of a bucket, where rows are too few to be dealt by their size
SCANS = 64               # of a table read by its buckets
TASK_BYTES = 128 << 20   # of rows in memory that one task sorts
_VERSION = re.compile(r"^version-(\d{6,})$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist (file or folder)?"""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def versions(spark: SparkSession, table_path: str, complete_only: bool = True) -> list[int]:
    """Version numbers below a table folder, ascending."""
    fs, p = _fs(spark, table_path)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for st in fs.listStatus(p):
        if not st.isDirectory():
            continue
        m = _VERSION.match(st.getPath().getName())
        if not m:
            continue
        if complete_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            continue
        out.append(int(m.group(1)))
    return sorted(out)


def version_path(table_path: str, version: int) -> str:
    return f"{table_path.rstrip('/')}/version-{version:06d}"


def latest_version(spark: SparkSession, table_path: str, below: int | None = None) -> int | None:
    vs = [v for v in versions(spark, table_path) if below is None or v < below]
    return vs[-1] if vs else None


@dataclass(frozen=True)
class Load:
    """What a version's load was."""

    id: str                    # unlike the number, never used twice
    table: str | None = None   # the id of the table's first load, which its later loads hand on
    key: list[str] | None = None
    source: str | None = None  # raw: "<stream id>/<batch id>" of a stream batch
    merged: str | None = None  # trusted: the raw load and cast mode up to which raw is merged
    buckets: int = 1           # hash buckets of the table
    whole: bool = True         # all buckets are written anew
    schema: str | None = None  # of the rows, as JSON


def load_of(spark: SparkSession, table_path: str, version: int | None) -> Load | None:
    """What a version's load was (None for a version written without)."""
    text = None if version is None else _read_text(spark, f"{version_path(table_path, version)}/_load.json")
    return Load(**json.loads(text)) if text else None


def note_load(spark: SparkSession, table_path: str, version: int, load: Load) -> None:
    """Begin a version: its folder with the load's note. A folder that is there is an error."""
    _write_text(spark, f"{version_path(table_path, version)}/_load.json", json.dumps(asdict(load)), False)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def bucket_of(keys: list[Column], buckets: int) -> Column:
    """The bucket of a key: by its text, so that it does not depend on the column's type."""
    return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(buckets)).cast("int")


def memory_bytes(df: DataFrame, rows: int, file_bytes: int) -> int:
    """About how much memory rows take in a sort: their slots and short texts by the columns, an
    arrival with its path, and longer texts by what their files unpack to."""
    nested = sum(isinstance(f.dataType, T.StructType) for f in df.schema.fields)
    return rows * (24 + 16 * len(df.columns) + 200 * nested) + 4 * file_bytes


def parts_of(spark: SparkSession, volume: int) -> int | None:
    """Shuffle partitions of ``TASK_BYTES`` each, or None where rows are so few that Spark's own
    number leaves less in each."""
    parts = -(-volume // TASK_BYTES)
    return parts if parts > spark.sparkContext.defaultParallelism else None


def deal(df: DataFrame, keys: list[str], buckets: int, volume: int) -> DataFrame:
    """Rows shuffled by their key, with several buckets to parts of a bucket (then with ``BUCKET`` and
    ``CELL``): of ``TASK_BYTES`` each where ``volume``, their size in memory, makes it many."""
    by = [F.col(k) for k in keys]
    parts = parts_of(df.sparkSession, volume)
    if buckets == 1:
        return df.repartition(parts, *by) if parts else df.repartition(*by)
    cells = buckets * (-(-parts // buckets) if parts else CELLS)
    placed = df.withColumn(BUCKET, bucket_of(by, buckets)).withColumn(CELL, bucket_of(by, cells))
    return placed.repartitionById(cells, F.col(CELL)) if parts else placed.repartition(F.col(CELL))


def _bucket_folders(spark: SparkSession, table_path: str, version: int) -> dict[int, str]:
    fs, p = _fs(spark, version_path(table_path, version))
    named = ((st.getPath().getName(), st.getPath().toString()) for st in fs.listStatus(p))
    return {int(name.split("=")[1]): path for name, path in named if name.startswith(f"{BUCKET}=")}


def bucket_paths(spark: SparkSession, table_path: str, version: int) -> dict[int, tuple[int, str]]:
    """Bucket -> (version that has its rows, folder), as of a version. The newest first, back to
    the last version that wrote the whole table."""
    out: dict[int, tuple[int, str]] = {}
    for v in reversed([v for v in versions(spark, table_path) if v <= version]):
        for bucket, path in _bucket_folders(spark, table_path, v).items():
            out.setdefault(bucket, (v, path))
        load = load_of(spark, table_path, v)
        if load is None or load.whole:
            break
    return out


def read_layer(spark: SparkSession, table_path: str, below: int | None = None,
               buckets: list[int] | None = None, since: int | None = None) -> DataFrame | None:
    """The newest complete state of a layer table (None if there is none).

    ``buckets`` reads only those; ``since`` only buckets written after that version."""
    v = latest_version(spark, table_path, below)
    if v is None:
        return None
    load = load_of(spark, table_path, v)
    if not in_buckets(load):
        return spark.read.parquet(version_path(table_path, v))
    schema = T.StructType.fromJson(json.loads(load.schema))
    paths = [path for bucket, (written, path) in sorted(bucket_paths(spark, table_path, v).items())
             if (buckets is None or bucket in buckets) and (since is None or written > since)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_by_bucket(spark: SparkSession, table_path: str, below: int | None = None) -> DataFrame | None:
    """As ``read_layer``, in a scan for each of a few groups of buckets (each one where they are at
    most ``SCANS``): a task's rows are of one group, and as a scan is split by its own size, few."""
    v = latest_version(spark, table_path, below)
    load = load_of(spark, table_path, v)
    if not in_buckets(load):
        return read_layer(spark, table_path, below)
    out = None
    for n in range(min(load.buckets, SCANS)):
        part = read_layer(spark, table_path, below, buckets=list(range(n, load.buckets, SCANS)))
        out = part if out is None else out.unionByName(part)
    return out


def in_buckets(load: Load | None) -> bool:
    return load is not None and load.buckets > 1


def folders(spark: SparkSession, table_path: str, version: int | None) -> list[str]:
    """The folders that hold a table's rows, as of a version."""
    if version is None:
        return []
    if not in_buckets(load_of(spark, table_path, version)):
        return [version_path(table_path, version)]
    return [path for _, path in bucket_paths(spark, table_path, version).values()]


def size_of(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files below some folders."""
    return sum(fs.getContentSummary(p).getLength() for fs, p in (_fs(spark, path) for path in paths))


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file below a folder (or of the file)."""
    fs, p = _fs(spark, path)
    files, most = fs.listFiles(p, True), 0
    while files.hasNext():
        most = max(most, files.next().getLen())
    return most


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


class KeyMismatch(ValueError):
    """The table was loaded with another key."""


def next_version(spark: SparkSession, table_path: str) -> int:
    """The number after every version there is, unfinished ones too."""
    return max(versions(spark, table_path, complete_only=False), default=0) + 1


def _stream_path(table_path: str, stream: str) -> str:
    return f"{table_path.rstrip('/')}/_streams/{stream}.json"


def version_of_source(spark: SparkSession, table_path: str, source: str) -> int | None:
    """The version that a stream batch has completed, if it has; its folder may be gone."""
    for v in reversed(versions(spark, table_path)):
        load = load_of(spark, table_path, v)
        if load and load.source == source:
            return v
    stream, _, batch = source.rpartition("/")
    known = json.loads(_read_text(spark, _stream_path(table_path, stream)) or "{}")
    # a stream replays no batch but its last
    return known["version"] if known and int(batch) <= known["batch"] else None


def prune_versions(spark: SparkSession, table_path: str, keep: int = 2) -> list[int]:
    """Delete what neither the newest ``keep`` states of the table nor a version still being
    written need; return the numbers of the versions that are gone.

    Readers that started on the state before the newest can still finish with ``keep >= 2``. Of a
    version whose buckets have partly been written anew only the others stay. A stream's last
    batch is put down before its version goes.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    done = versions(spark, table_path)
    if len(done) <= keep:
        return []
    oldest_kept = done[-keep]
    needed: dict[int, set[str]] = {}
    for v in done[-keep:]:
        for written, path in bucket_paths(spark, table_path, v).values():
            needed.setdefault(written, set()).add(path)
    gone = []
    for v in versions(spark, table_path, complete_only=False):
        if v >= oldest_kept:
            continue
        if v in needed:
            for path in _bucket_folders(spark, table_path, v).values():
                if path not in needed[v]:
                    delete_path(spark, path)
            continue
        load = load_of(spark, table_path, v)
        if load and load.source and v in done:
            stream, _, batch = load.source.rpartition("/")
            known = json.loads(_read_text(spark, _stream_path(table_path, stream)) or "{}")
            if not known or known["batch"] < int(batch):
                _write_text(spark, _stream_path(table_path, stream),
                            json.dumps({"batch": int(batch), "version": v}), True)
        delete_path(spark, version_path(table_path, v))
        gone.append(v)
    return gone
