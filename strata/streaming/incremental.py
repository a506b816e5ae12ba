"""Incremental load of a landing folder with Structured Streaming.

New CSV files in the landing folder are read as a file stream; each micro-batch
is merged into a versioned layer table with ``foreachBatch``. A micro-batch starts
from the newest complete version, whoever wrote it (another stream before, a batch run),
and writes the next number. The version's note names the stream (the id in its
checkpoint) and the batch: when a batch is replayed after a failure
(``foreachBatch`` is at-least-once) and its version was completed, that version
stands, also when later loads have pruned its folder, so the table is exactly-once
in effect. Inside a batch, the row that arrived last wins (file time, path, place in
the file). A table has one writer at a time: its stream, or a run while that is stopped.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import CSV_OPTIONS
from strata.operators.merge import batch_keys, upsert
from strata.session import temporary
from strata.sinks.tables import LayerLoad, staged
from strata.sources import layers
from strata.sources.csv import ARRIVAL, ARRIVAL_TYPE, CORRUPT, arrival, file_place

MALFORMED = "_malformed"


def landing_stream(spark: SparkSession, landing: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None,
                   multiline: bool = False, archive_dir: str | None = None,
                   corrupt: bool = False) -> DataFrame:
    """A file stream over a landing folder, with the file and split of each row.

    ``archive_dir`` moves each file there once its batch is committed
    (``cleanSource=archive``), which keeps the folder listing short on a
    long-running stream."""
    if corrupt:       # keep the raw text of short / long rows in a corrupt-record column
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = (spark.readStream.schema(schema).options(**CSV_OPTIONS)
              .option("header", "true").option("multiLine", str(multiline).lower()))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = reader.csv(landing)
    return df.select("*", file_place().alias(ARRIVAL))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it made the checkpoint."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def merge_batch(target: str, key, columns, stage_batch: bool = True, checkpoint: str | None = None,
                keep_arrival: bool = False):
    """The ``foreachBatch`` function: upsert one micro-batch into ``target``.

    ``stage_batch`` first writes the micro-batch as Parquet (K2), so its files are
    parsed once instead of twice (keys, then rows). ``checkpoint`` is where the stream's
    id is read. ``keep_arrival`` writes the rows' arrival too (a raw layer has it).
    Returns (rows written, rows written that were malformed in their file; None without a
    corrupt column, or for a replay whose version was completed; of a pruned one the rows
    are None too)."""
    keys = [key] if isinstance(key, str) else list(key)

    def run(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        source = f"{stream_id(spark, checkpoint) if checkpoint else 'direct'}/{batch_id}"
        done = layers.version_of_source(spark, target, source)
        if done is not None:
            there = done in layers.versions(spark, target)
            return layers.read_layer(spark, target, below=done + 1).count() if there else None, None
        load = LayerLoad(spark, target, keys, source)
        flagged = CORRUPT in batch.columns
        if flagged:
            batch = batch.withColumn(MALFORMED, F.col(CORRUPT).isNotNull()).drop(CORRUPT)
        placed = ARRIVAL in batch.columns
        out = [*columns, *([ARRIVAL] if keep_arrival and placed else [])]
        if placed:
            batch = batch.withColumn(ARRIVAL, arrival(F.col(ARRIVAL), load.version))
        bad = Observation(f"malformed_{uuid.uuid4().hex}") if flagged else None
        stage_path = f"{target.rstrip('/')}/_stage/{uuid.uuid4().hex}" if stage_batch else None
        try:
            with temporary(spark):
                rows, size = staged(batch, stage_path) if stage_path else (batch, 0)
                found = batch_keys(rows, keys)
                current = load.plan(found.frame, size)
                if current is not None:
                    extra = [F.lit(False).alias(MALFORMED)] if flagged else []
                    if ARRIVAL in out:
                        old = F.col(ARRIVAL) if ARRIVAL in current.columns else F.lit(None)
                        extra.append(old.cast(ARRIVAL_TYPE).alias(ARRIVAL))
                    current = current.select(*columns, *extra)
                merged = upsert(current, rows, keys, order=[ARRIVAL] if placed else None,
                                current_is_unique=current is not None,
                                batch_is_unique=found.unique, incoming=found.frame,
                                one_shuffle=found.one_shuffle, buckets=load.load.buckets)
                if bad is not None:
                    merged = merged.observe(bad, F.count(F.when(F.col(MALFORMED), 1)).alias("n"))
                dealt = [layers.BUCKET] if layers.BUCKET in merged.columns else []
                rows_written = load.write(merged.select(*out, *dealt))
        finally:
            if stage_path:
                layers.delete_path(spark, stage_path)
        layers.prune_versions(spark, target, keep=2)
        return rows_written, (int(bad.get["n"]) if bad is not None else None)
    return run


def incremental_load(spark: SparkSession, landing: str, target: str, schema: T.StructType,
                     key, checkpoint: str, max_files_per_trigger: int | None = None,
                     processing_time: str | None = None, multiline: bool = False,
                     stage_batch: bool = True, archive_dir: str | None = None):
    """Start the stream; with no ``processing_time`` it drains what has landed
    (``availableNow``) and returns when done, else it keeps running on that interval
    (e.g. ``"20 minutes"``) and the query handle is returned."""
    stream = landing_stream(spark, landing, schema, max_files_per_trigger, multiline,
                            archive_dir)
    writer = (stream.writeStream.foreachBatch(merge_batch(target, key, schema.names, stage_batch,
                                                       checkpoint))
              .option("checkpointLocation", checkpoint))
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def refresh_layers(spec, base: str, key=None, cast_mode: str = "strict",
                   checkpoint: str | None = None):
    """A ``foreachBatch`` function for one table: raw upsert, then trusted and refined.

    The raw version carries the batch's id (replay-safe, see ``merge_batch``); the
    trusted load re-merges the newest raw version, and the refined table is
    overwritten, so a replayed batch leaves the same three layers behind.
    """
    from strata.plans import jobs
    from strata.sinks import tables
    from strata.sinks.tables import OVERWRITE

    raw_path = jobs.table_path(base, jobs.RAW, spec)
    keys = jobs._keys(spec, key)
    raw_merge = merge_batch(raw_path, keys, list(spec.columns), checkpoint=checkpoint,
                            keep_arrival=True)

    # one folder per writer: concurrent appends to one folder would share a commit area
    log_path = f"{base.rstrip('/')}/_run_log/source=stream_{spec.name}"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"stream-{spec.name}-{batch_id}"
        entries: list[dict] = []

        def step(layer: str, load) -> None:
            start = tables.now()
            malformed = None
            try:
                out, status, message = load(), jobs.OK, "success"
                rows, malformed = out if isinstance(out, tuple) else (out, None)
            except Exception as e:  # noqa: BLE001 - logged, then the stream fails as usual
                rows, status, message = None, jobs.FAILED, jobs._error_text(e)
            entries.append(dict(run_id=run_id, layer=layer, table_name=spec.name,
                                status=status, message=message, rows=rows, malformed=malformed,
                                started_at=start, ended_at=tables.now()))
            if status != jobs.OK:
                tables.append_run_log(spark, entries, log_path)
                raise RuntimeError(f"{spec.name} {layer} failed: {message}")

        step(jobs.RAW, lambda: raw_merge(batch, batch_id))
        step(jobs.TRUSTED, lambda: jobs.load_trusted(spark, spec, base, key, cast_mode,
                                                     raw_unique=True))
        step(jobs.REFINED, lambda: jobs.load_refined(spark, spec, base, write_mode=OVERWRITE,
                                                     mode=cast_mode))
        tables.append_run_log(spark, entries, log_path)       # K4 for the stream too
    return run


def watch_tables(spark: SparkSession, landing_root: str, base: str, specs,
                 checkpoint_root: str, processing_time: str | None = None, key=None,
                 cast_mode: str = "strict"):
    """J5 for a whole lake: one file stream per table over ``<landing>/<source file>/``.

    Each new drop of a table runs that table's raw -> trusted -> refined refresh.
    With ``processing_time`` (e.g. ``"20 minutes"``, the source system's schedule)
    the streams keep running and ``(queries, errors)`` is returned; without it each
    stream drains what has landed (``availableNow``) and the call returns the
    errors (table -> message) when all are done. A table's stream failing does not
    stop the others.
    """
    queries, errors = {}, {}
    for spec in specs:
        try:
            stream = landing_stream(spark, f"{landing_root.rstrip('/')}/{spec.source_file}",
                                    spec.raw_schema, multiline=spec.multiline, corrupt=True)
            checkpoint = f"{checkpoint_root.rstrip('/')}/{spec.name}"
            writer = (stream.writeStream.queryName(f"strata_{spec.name}")
                      .foreachBatch(refresh_layers(spec, base, key, cast_mode, checkpoint))
                      .option("checkpointLocation", checkpoint))
            writer = (writer.trigger(processingTime=processing_time) if processing_time
                      else writer.trigger(availableNow=True))
            queries[spec.name] = writer.start()
        except Exception as e:  # noqa: BLE001 - e.g. no landing folder yet for this table
            errors[spec.name] = str(e).splitlines()[0]
    if processing_time:
        return queries, errors
    for name, q in queries.items():
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - one table's failure is reported, not raised
            errors[name] = str(e).splitlines()[0]
    return errors
