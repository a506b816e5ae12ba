"""Layer jobs (J1-J4): landing CSV -> raw -> trusted -> refined, and a full run.

Folder layout below ``base`` (a path on shared storage)::

    raw/<table>/version-NNNNNN/        all-text rows and their arrival, one per key
    trusted/<table>/version-NNNNNN/    cast rows, one per key
                    .../__bucket=N/    large tables: only the buckets of the key that a load met
    refined/<table>/                   published rows (append or overwrite)
    _rejects/<table>/load=N/           malformed landing rows, where they are routed aside
    _run_log/source=<writer>/          one row per (layer, table) step

Raw and trusted jobs read complete versions only and write a new one, in a folder of its
own; a refined overwrite is written beside the table and takes its place when it is
whole. So a failed or retried job never leaves a half-written table behind, and a
lost executor only costs the retry of its tasks. A table has one writer at a time.

"Last" means the row that arrived last: by load, then by the landing file's time and
path, then by the place in the file (``sources.csv.arrival``). Raw rows keep that
place, so the trusted merge orders rows of different raw keys the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions import casts
from strata.operators.joins import fits_broadcast
from strata.operators.merge import (_AT, _PLACE, _key_cols, batch_keys, count_keys, has_duplicate_keys, keep_last,
                                    last_in_batches, number_places, upsert, with_number, with_place)
from strata.session import temp_dir, temporary
from strata.sinks import tables
from strata.sources import layers
from strata.sources.csv import ARRIVAL, ARRIVAL_TYPE, CORRUPT, read_csv, reject_rows, with_source_order
from strata.sources.multiline import read_multiline
from strata.specs import ALL_SPECS, TEXT, TableSpec

RAW, TRUSTED, REFINED = "raw", "trusted", "refined"
KEEP, REJECT = "keep", "reject"      # malformed landing rows: padded or cut, or routed aside
OK, FAILED, SKIPPED = "ok", "failed", "skipped"
MALFORMED = "_malformed"
KEEP_VERSIONS = 2        # the newest version and the one before it, for readers in flight


def table_path(base: str, layer: str, spec: TableSpec) -> str:
    return f"{base.rstrip('/')}/{layer}/{spec.name}"


def rejects_path(base: str, spec: TableSpec) -> str:
    return f"{base.rstrip('/')}/_rejects/{spec.name}"


def _keys(spec: TableSpec, key) -> list[str]:
    if key in (None, "natural"):
        return spec.keys(natural=True)
    if key == "reference":
        return spec.keys(natural=False)
    keys = [key] if isinstance(key, str) else list(key)
    missing = [k for k in keys if k not in spec.columns]
    if missing:
        raise ValueError(f"key column(s) {missing} not in table {spec.name}")
    return keys


def raw_rows(spark: SparkSession, spec: TableSpec, landing: str, key=None,
             current: DataFrame | Callable[[DataFrame, int], DataFrame | None] | None = None,
             stage_path: str | None = None, full_snapshot: bool = False,
             malformed: Observation | None = None, load: int | None = None,
             header: bool = True, reject_path: str | None = None,
             buckets: Callable[[], int] = lambda: 1,
             sized: Callable[[int], None] = lambda volume: None) -> DataFrame:
    """J1 plan: CSV batch merged into the current raw rows (batch wins).

    Inside the batch the row of a key that arrived last stays. With ``stage_path`` the
    landing files are parsed once, into Parquet (K2); everything after reads that. One
    keys-only aggregate gives the batch's key set and says whether each key came once;
    if so the full-row dedupe (a sort and shuffle of every row) is left out. Of a large batch whose
    rows are shuffled in any case, keys are counted without a shuffle (``count_keys``). ``current``
    may be a function that gives the current rows for that key set and the batch's bytes
    (those that the batch can meet are enough); ``buckets`` then gives the table's number of
    buckets, to which a merge by shuffle deals its rows, and ``sized`` is told what the rows take in
    memory. Short and long rows are kept (padded with
    null, or cut); with ``malformed`` the ones written from this batch are counted. With
    ``reject_path`` they are written there instead, each with its raw text, place and
    reason, and are not loaded: of the one staged parse the good rows are one output and
    the rejected rows the other.
    """
    keys = _keys(spec, key)
    batch = landing_rows(spark, spec, landing, load, header)
    flag = F.col(CORRUPT).isNotNull()
    size = None
    if reject_path:
        batch, size = tables.staged(batch, stage_path or temp_dir(spark, "landing"))
        bad = reject_rows(batch, len(spec.columns))
        if malformed is not None:
            bad = bad.observe(malformed, F.count(F.lit(1)).alias("malformed"))
            malformed = None
        bad.write.mode("overwrite").parquet(reject_path)
        batch = batch.where(~flag).withColumn(MALFORMED, F.lit(False)).drop(CORRUPT)
    else:
        # the flag is made where every field is parsed (a job that reads only some fields,
        # like the key aggregate, cannot tell a short row)
        batch = batch.withColumn(MALFORMED, flag).drop(CORRUPT)
        if stage_path:
            batch, size = tables.staged(batch, stage_path)
    found = batch_keys(batch, keys) if fits_broadcast(batch, keys) else None
    size = layers.size_of(spark, [landing]) if size is None else size
    if callable(current):
        current = current(found.frame if found else _key_cols(batch, keys, "__k_"), size)
    if current is not None:
        current = raw_columns(current, spec).withColumn(MALFORMED, F.lit(False))
    if found is None:
        covering = current is not None and full_snapshot
        by_shuffle = buckets() > 1 or current is not None and not covering
        found = count_keys(batch, keys, exact=not by_shuffle, current=current if covering else None,
                           place=ARRIVAL)
    rows = found.rows + (current.count() if current is not None else 0)            # counted in file footers
    if found.repeated:
        batch = last_in_batches(batch, keys, ARRIVAL)
    places, order, kind = None, [ARRIVAL], batch.schema[ARRIVAL].dataType
    if found.one_shuffle and not (found.unique and (current is None or full_snapshot)):     # whole rows are shuffled
        places = number_places([batch] if current is None or found.covers else [batch, current], ARRIVAL)
    if places is not None:
        order = [_PLACE, _AT]
        batch = with_number(batch, places, ARRIVAL)
        current = with_number(current, places, ARRIVAL) if current is not None else None
    volume = layers.memory_bytes(batch, rows, size * rows // max(found.rows, 1))
    sized(volume)
    merged = upsert(current, batch, keys, order=order, current_is_unique=current is not None,
                    batch_is_unique=found.unique, batch_covers_current=full_snapshot,
                    incoming=found.frame, one_shuffle=found.one_shuffle, buckets=buckets(), volume=volume,
                    none_lacking=found.covers)
    if places is not None:
        merged = with_place(merged, places, ARRIVAL, kind)
    if malformed is not None:
        merged = merged.observe(malformed, F.count(F.when(F.col(MALFORMED), 1)).alias("malformed"))
    return merged.select(*spec.columns, ARRIVAL, *([layers.BUCKET] if layers.BUCKET in merged.columns else []))


def landing_rows(spark: SparkSession, spec: TableSpec, landing: str, load: int | None = None,
                 header: bool = True) -> DataFrame:
    """The rows of landing files as text, with ``CORRUPT`` and ``ARRIVAL``. Large files with newlines
    in quoted fields are read in splits, too; others file by file."""
    if spec.multiline:
        return read_multiline(spark, landing, spec.raw_schema, header, load=load, whole_files=True)
    return with_source_order(read_csv(spark, landing, spec, corrupt_column=CORRUPT, header=header), load)


def raw_columns(current: DataFrame, spec: TableSpec) -> DataFrame:
    """The current raw rows with their arrival (null in a version written without it)."""
    place = F.col(ARRIVAL) if ARRIVAL in current.columns else F.lit(None)
    return current.select(*spec.columns, place.cast(ARRIVAL_TYPE).alias(ARRIVAL))


def load_raw(spark: SparkSession, spec: TableSpec, landing: str, base: str,
             key=None, keep: int = KEEP_VERSIONS, stage: bool = True,
             full_snapshot: bool = False, bucket_bytes: int = tables.BUCKET_BYTES,
             on_malformed: str = KEEP, header: bool = True) -> int:
    """Landing CSV -> new raw version (older ones pruned to ``keep``). Returns rows."""
    return raw_load(spark, spec, landing, base, key, keep, stage, full_snapshot, bucket_bytes,
                    on_malformed, header)[0]


def raw_load(spark: SparkSession, spec: TableSpec, landing: str, base: str,
             key=None, keep: int = KEEP_VERSIONS, stage: bool = True, full_snapshot: bool = False,
             bucket_bytes: int = tables.BUCKET_BYTES, on_malformed: str = KEEP,
             header: bool = True) -> tuple[int, int]:
    """J1 with its counts: (rows of the table, rows of this batch that were malformed in the file).

    The landing files are parsed once, into a staged Parquet copy (K2) that is deleted
    at the end; with ``stage=False`` each of the two passes (keys, rows) parses them. Of a
    table in buckets (``bucket_bytes`` each) only those that the batch meets are read and
    written. ``full_snapshot=True`` says the landing file re-delivers the whole table (as the
    source system's feeds do): the merge then shuffles keys only, not current rows.
    ``on_malformed="reject"`` leaves short, long and otherwise malformed rows out and writes them,
    with their raw text, to ``<base>/_rejects/<table>/load=<version>``; a load that is retried
    writes that folder anew.
    """
    keys = _keys(spec, key)                        # a wrong key fails before any I/O
    if on_malformed not in (KEEP, REJECT):
        raise ValueError(f"on_malformed must be {KEEP!r} or {REJECT!r}, got {on_malformed!r}")
    if not layers.exists(spark, landing):          # S6: probe before planning the read
        raise FileNotFoundError(f"PATH_NOT_FOUND: no landing file for {spec.name}: {landing}")
    path = table_path(base, RAW, spec)
    stage_path = (f"{base.rstrip('/')}/_stage/{spec.name}-{uuid.uuid4().hex[:12]}"
                  if stage else None)
    bad = Observation(f"malformed_{uuid.uuid4().hex}")
    target = tables.LayerLoad(spark, path, keys, bucket_bytes=bucket_bytes)
    volumes = []
    try:
        with temporary(spark):
            merged = raw_rows(spark, spec, landing, key,
                              lambda met, size: target.plan(None if full_snapshot else met, size),
                              stage_path, full_snapshot, malformed=bad, load=target.version, header=header,
                              reject_path=(f"{rejects_path(base, spec)}/load={target.version}"
                                           if on_malformed == REJECT else None),
                              buckets=lambda: target.load.buckets, sized=volumes.append)
            rows = target.write(merged, volumes[0])
    finally:
        if stage_path:
            layers.delete_path(spark, stage_path)
    layers.prune_versions(spark, path, keep)
    return rows, int(bad.get["malformed"])


def _key_is_cast(spec: TableSpec, keys: list[str]) -> bool:
    """Does the trusted step change the value of any key column?"""
    def changed(k: str) -> bool:
        filled = spec.fill_zero and k not in spec.natural_key and k not in spec.dates
        return spec.trusted.get(k, TEXT) != TEXT or k in spec.blank_zero or filled
    return any(changed(k) for k in keys)


def trusted_rows(raw: DataFrame, spec: TableSpec, key=None, mode: str = casts.STRICT,
                 current: DataFrame | Callable[[DataFrame | None], DataFrame | None] | None = None,
                 raw_unique: bool | None = False, covers: bool = True,
                 buckets: Callable[[], int] = lambda: 1, volume: int = 0,
                 settled: bool = False) -> DataFrame:
    """J2 plan: cast first (so '01037' and '1037' are one key), then merge.

    Rows that casts make one key are ordered by their arrival: the last one stays. In
    coerce mode a key text that does not cast gives a null key; such rows are known by
    their text, so none is lost to another.
    ``raw_unique=True`` says the raw rows are one per key (a raw load with the same
    key wrote them); when the casts leave the key columns alone, or a keys-only probe says
    so, they stay one per key, and the dedupe (a sort and shuffle of the whole table) is skipped.
    ``raw_unique=None`` finds out with that probe of the cast rows. ``covers``
    says that ``raw`` is all of the raw layer, not what is new in it. ``current`` may be
    a function that gives the current rows for the new rows' key set (None: for all);
    ``buckets`` is as in ``raw_rows``, ``volume`` what the rows take in memory. ``settled`` says
    that every current row was made from a row of this raw layer by these casts, keys as they are:
    then the cast rows are the table, and nothing is merged.
    """
    keys = _keys(spec, key)
    texts = {k: f"_text_{k}" for k in keys if spec.trusted.get(k, TEXT) != TEXT}
    order = [ARRIVAL] if ARRIVAL in raw.columns else []
    cast = casts.trusted_columns(raw, spec, mode, keep={**{t: F.col(k) for k, t in texts.items()},
                                                        **{c: F.col(c) for c in order}})
    for k, t in texts.items():
        cast = cast.withColumn(t, F.when(F.col(k).isNull(), F.col(t)))
    wide = [*keys, *texts.values()]
    if raw_unique is None:
        unique = not has_duplicate_keys(cast, wide)
    else:
        # rows that are one per raw key may be one per cast key, too: keys alone are shuffled to see
        unique = raw_unique and (not _key_is_cast(spec, keys) or not has_duplicate_keys(cast, wide))
    newest = (cast if unique else keep_last(cast, wide, order)).select(*spec.columns)
    incoming, by_shuffle = None, False
    if callable(current):
        if covers:
            current = current(None)
            if settled:
                return newest
        elif fits_broadcast(raw, keys):
            found = batch_keys(newest, keys)
            incoming, by_shuffle = found.frame, found.one_shuffle
            current = current(incoming)
        else:                                      # one row for each key: none can be hot
            by_shuffle = True
            current = current(_key_cols(newest, keys, "__k_"))
    # the whole of raw covers every trusted key (a raw merge never drops one)
    return upsert(current, newest, keys, current_is_unique=current is not None,
                  batch_is_unique=True, batch_covers_current=covers, incoming=incoming,
                  one_shuffle=by_shuffle, buckets=buckets() if by_shuffle else 1, volume=volume)


def new_raw_rows(spark: SparkSession, spec: TableSpec, base: str, merged: str | None,
                 keys: list[str], mode: str) -> DataFrame | None:
    """The raw rows that arrived after the trusted version's own raw version, or None where
    all have to be merged: no record of that version, another cast mode since, or rows
    whose cast key is null (those are known by their raw text only). Only raw buckets
    written since are read."""
    if merged is None:
        return None
    raw_id, seen, its_mode = merged.split("/")
    if its_mode != mode or (mode != casts.STRICT and any(spec.trusted.get(k, TEXT) != TEXT for k in keys)):
        return None
    path = table_path(base, RAW, spec)
    load = layers.load_of(spark, path, layers.latest_version(spark, path))
    if load is None or load.table != raw_id:       # a raw layer made anew counts its versions anew
        return None
    new = layers.read_layer(spark, path, since=int(seen))
    return new.where(F.col(ARRIVAL)["load"] > int(seen)) if ARRIVAL in new.columns else None


def load_trusted(spark: SparkSession, spec: TableSpec, base: str, key=None,
                 mode: str = casts.STRICT, keep: int = KEEP_VERSIONS,
                 raw_unique: bool | None = None, full_snapshot: bool = False,
                 bucket_bytes: int = tables.BUCKET_BYTES) -> int:
    """Newest raw version -> new trusted version (older ones pruned). Returns rows.

    Only raw rows that arrived since the last trusted load are cast and merged (the
    filter reaches the Parquet scan), into the trusted buckets that they meet; where that
    load left no record, all are. ``full_snapshot`` says that the last raw load re-delivered
    the table: then a merge that shuffles keys only is the better one. Where raw rows are one for
    each trusted key, keys as they are, and all trusted rows came from this raw layer, a load that
    is not small casts the whole of it: no row or key is shuffled to find what it replaces.
    """
    keys = _keys(spec, key)
    raw_path, path = table_path(base, RAW, spec), table_path(base, TRUSTED, spec)
    raw_version = layers.latest_version(spark, raw_path)
    if raw_version is None:
        raise FileNotFoundError(f"no raw version of {spec.name}")
    raw_load = layers.load_of(spark, raw_path, raw_version)
    target = tables.LayerLoad(spark, path, keys, merged=raw_load and f"{raw_load.table}/{raw_version}/{mode}",
                              bucket_bytes=bucket_bytes)
    raw_folders = layers.folders(spark, raw_path, raw_version)
    one_for_each = raw_load is not None and raw_load.key == keys and not _key_is_cast(spec, keys)
    settled = (one_for_each and target.before is not None and target.before.merged is not None
               and target.before.merged.split("/")[::2] == [raw_load.table, mode])
    with temporary(spark):
        new = (None if full_snapshot or target.before is None
               else new_raw_rows(spark, spec, base, target.before.merged, keys, mode))
        if settled and new is not None and not fits_broadcast(new, keys):
            new = None
        plain = one_for_each and new is None and (settled or target.before is None)
        raw = new
        if new is None:
            raw = (layers.read_by_bucket if plain else layers.read_layer)(spark, raw_path, below=raw_version + 1)
        volume = layers.memory_bytes(raw.select(*spec.columns), raw.count(), layers.size_of(spark, raw_folders))
        merged = trusted_rows(raw, spec, key, mode,
                              lambda met: target.plan(met, layers.size_of(spark, raw_folders if met is None else [])),
                              raw_unique or one_for_each, covers=new is None,
                              buckets=lambda: target.load.buckets, volume=volume, settled=settled)
        rows = target.write(merged, volume, raw_load.buckets if plain else 0)
    layers.prune_versions(spark, path, keep)
    return rows


def refined_rows(trusted: DataFrame, spec: TableSpec, mode: str = casts.STRICT) -> DataFrame:
    """J3 plan: the typed projection of the trusted rows."""
    return casts.typed_projection(trusted, spec, mode)


def load_refined(spark: SparkSession, spec: TableSpec, base: str,
                 write_mode: str = tables.APPEND, mode: str = casts.STRICT,
                 table: str | None = None, sort_files: bool = False) -> int:
    """Newest trusted version -> refined table (append by default), with ``sort_files`` in
    files of disjoint ranges of the natural key."""
    trusted = layers.read_layer(spark, table_path(base, TRUSTED, spec))
    if trusted is None:
        raise FileNotFoundError(f"no trusted version of {spec.name}")
    return tables.publish(refined_rows(trusted, spec, mode), write_mode, table=table,
                          path=table_path(base, REFINED, spec), schema=spec.refined_schema,
                          sort_key=spec.keys() if sort_files else None)


def _error_text(e: BaseException) -> str:
    cond = None
    for attr in ("getCondition", "getErrorClass"):
        fn = getattr(e, attr, None)
        if callable(fn):
            try:
                cond = fn()
            except Exception:  # noqa: BLE001
                cond = None
            if cond:
                break
    first = (str(e).strip().splitlines() or [type(e).__name__])[0]
    return f"{cond}: {first}" if cond else f"{type(e).__name__}: {first}"


@dataclass
class RunResult:
    run_id: str
    log: DataFrame


def run_all(spark: SparkSession, landing_root: str, base: str,
            specs: tuple[TableSpec, ...] = ALL_SPECS, key=None,
            cast_mode: str = casts.STRICT, write_mode: str = tables.APPEND,
            on_error: str = "skip", parallelism: int = 8,
            full_snapshot: bool = False, database: str | None = None,
            on_malformed: str = KEEP) -> RunResult:
    """Every table through its layers; one table's failure does not stop the rest.

    Tables run as concurrent Spark jobs (``parallelism`` threads), each in its own scheduler
    pool. A table goes on to its next layer without waiting for other tables, so a slow or
    hanging feed holds up only itself. With ``on_error="skip"`` a table that failed in one layer is ``skipped`` in the
    later ones; ``"continue"`` runs them anyway (they then read older versions).
    Every step becomes a run-log row, appended to ``<base>/_run_log/source=batch``. With
    ``database`` the refined tables are also catalog tables ``<database>.<table>``
    whose data stays at ``<base>/refined/<table>``.
    """
    run_id = uuid.uuid4().hex
    failed: set[tuple[str, str]] = set()       # (layer, table): each table is one thread's
    loaded: set[tuple[str, str]] = set()

    def step(layer: str, spec: TableSpec) -> dict:
        start = tables.now()
        if on_error == "skip" and any((before, spec.name) in failed for before in (RAW, TRUSTED)):
            return dict(run_id=run_id, layer=layer, table_name=spec.name, status=SKIPPED,
                        message="an earlier layer failed", rows=None, malformed=None,
                        started_at=start, ended_at=tables.now())
        try:
            malformed = None
            if layer == RAW:
                rows, malformed = raw_load(spark, spec,
                                           f"{landing_root.rstrip('/')}/{spec.source_file}",
                                           base, key, full_snapshot=full_snapshot,
                                           on_malformed=on_malformed)
            elif layer == TRUSTED:
                # raw was just written by this run with the same key: one row per key
                rows = load_trusted(spark, spec, base, key, cast_mode,
                                    raw_unique=(RAW, spec.name) in loaded, full_snapshot=full_snapshot)
            else:
                rows = load_refined(spark, spec, base, write_mode, cast_mode,
                                    table=f"{database}.{spec.name}" if database else None)
            status, message = OK, "success"
        except Exception as e:  # noqa: BLE001 - every failure is logged, none stops the run
            rows, malformed, status, message = None, None, FAILED, _error_text(e)
        return dict(run_id=run_id, layer=layer, table_name=spec.name, status=status,
                    message=message, rows=rows, malformed=malformed,
                    started_at=start, ended_at=tables.now())

    def chain(spec: TableSpec) -> list[dict]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{run_id}-{spec.name}")
        out = []
        for layer in (RAW, TRUSTED, REFINED):
            out.append(step(layer, spec))
            (loaded if out[-1]["status"] == OK else failed).add((layer, spec.name))
        return out

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        chains = list(pool.map(chain, specs))
    entries = [steps[i] for i in range(3) for steps in chains]       # layer by layer, as a log is read
    # the run log is one table partitioned by writer (batch runs, each table's stream)
    log = tables.append_run_log(spark, entries, f"{base.rstrip('/')}/_run_log/source=batch")
    return RunResult(run_id, log)
