"""Keyed row operators: union, keep-last, first-per-key, grouping, sorting, upsert.

"Last" and "first" are always defined by an explicit order: the caller's
sequence columns (the loads pass the place of arrival, see ``sources.csv.arrival``),
then every other orderable column as a tie-break, so the result never depends on
partitioning.

Scale notes
-----------
* ``keep_last`` / ``first_per_key`` are ``row_number() = 1`` over a key window.
  Spark plans a partial ``WindowGroupLimit`` *before* the shuffle, so each map
  task sends at most one row per key: a key that holds a third of the table
  costs one row per input partition in the exchange, not a third of the table.
* A window before a write may not need its sort in the map tasks: ``keep_last_dealt`` shuffles
  the rows once, straight to the table's buckets, and sorts them once, as the files want them, in
  partitions by the rows' size in memory (``layers.TASK_BYTES``): AQE sizes them by their compressed
  bytes, several times less, so that sorts spill. It is for keys of which none fills a task (``HOT_ROWS``).
  Where keys come several times (``REPEATS``), ``last_in_batches`` leaves out before that shuffle, without a
  sort, what a later row of the same scan and Arrow batch replaces. Rows cross that shuffle with the number of
  their place of arrival (``number_places``), not with its path and time.
* ``upsert`` does not re-shuffle the current table's rows to merge a batch. Rows
  of the batch win, so the result is ``keep_last(batch)`` plus the current rows
  whose key is not in the batch. For a small batch that is a left-anti join against
  the batch keys, which are materialised and measured first and broadcast only
  when proven under the threshold (else a sort-merge join; with ``one_shuffle`` both sides
  go through one window instead, without a shuffle of keys or a second one by bucket). For a batch that
  re-delivers the table, only key columns are shuffled (see ``batch_covers_current``).
* ``group_rows`` collects rows per (key, block, part), never per key alone, so one
  output row holds at most ``block_size`` input rows however hot a key is and
  however often an order value repeats.
* ``sort_rows`` sorts on the key plus the full-row tie-break: range partitioning
  can then split one hot key over many partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import HASH_FACTOR, _fixed_row_bytes, broadcast_limit, fits_broadcast, sized
from strata.session import temp_dir
from strata.sources.layers import BUCKET, CELL, deal

_RN = "__strata_rn"
_INCOMING = "__strata_incoming"
_PLACE = "__strata_place"
_AT = "__strata_at"
HOT_ROWS = 100_000       # rows of one key that a task may sort
HASH_CELLS = 16          # cells of the keys' hash for each HOT_ROWS rows, where keys are counted by cells
REPEATS = 2              # rows for each key, from which a batch is thinned before its shuffle
NEAR = 1.2               # the same, for each key among neighbours, where that is known
NEIGHBOURS = 10_000      # rows of a file that come together


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    """Columns usable in a sort, in schema order, minus ``skip``."""
    bad = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, bad)]


def tie_break_order(df: DataFrame, key, order=None, descending: bool = False) -> list[Column]:
    """Sort expressions: ``order`` columns, then every other orderable column."""
    keys = _names(key)
    seq = _names(order)
    rest = _orderable(df, keys + seq)
    cols = seq + rest
    if descending:
        return [F.col(c).desc_nulls_last() for c in cols]
    return [F.col(c).asc_nulls_first() for c in cols]


def has_duplicate_keys(df: DataFrame, key) -> bool:
    """Does any key (null counting as one key) occur more than once?

    A keys-only aggregate: partial counts before the shuffle, and the job stops at
    the first duplicate found. Much cheaper than a full-row dedupe when, as with
    most source exports, the answer is no.
    """
    keys = _names(key)
    return not df.groupBy(*[F.col(k) for k in keys]).count().filter(F.col("count") > 1).isEmpty()


def union_rows(*frames: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _top1(df: DataFrame, key, order, descending: bool) -> DataFrame:
    keys = _names(key)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(
        *tie_break_order(df, keys, order, descending=descending))
    return (df.withColumn(_RN, F.row_number().over(w))
            .filter(F.col(_RN) == 1).drop(_RN))


def keep_last(df: DataFrame, key, order=None) -> DataFrame:
    """One row per key, the last in (order, full row) ascending order.

    Null keys form one group, as in a pandas ``drop_duplicates``.
    """
    return _top1(df, key, order, descending=True)


def keep_last_dealt(df: DataFrame, key, order=None, buckets: int = 1, volume: int = 0) -> DataFrame:
    """D1 for a layer write: ``keep_last`` with one shuffle and one sort for window and files.

    With ``buckets`` the rows come with their bucket (``BUCKET``), sorted by it and the key. A
    bucket is dealt in parts of the key's hash, so no task needs a whole one; ``volume``, the rows'
    bytes in memory, says how many (see ``layers.deal``). There is no step before the shuffle:
    every row crosses it, so no key may hold more than a task can sort.
    """
    keys = _names(key)
    sort = tie_break_order(df, keys, order, descending=True)
    dealt = deal(df, keys, buckets, volume)
    group = [BUCKET, *keys, CELL] if buckets > 1 else keys    # the cell follows from the key
    w = Window.partitionBy(*[F.col(k) for k in group]).orderBy(*sort)
    return dealt.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN, CELL)


def last_in_batches(df: DataFrame, key, place: str) -> DataFrame:
    """D1 in part, without a shuffle or sort: of a key's rows in one Arrow batch (Spark's number of rows) those
    that arrived last of their file's split; null keys are one key.

    ``place`` is a struct that orders rows (``sources.csv.ARRIVAL``); its last field numbers them within the
    others. The rows that a ``keep_last`` by key and place keeps are all among the result's.
    """
    import pyarrow as pa

    at, keys = df.columns.index(place), [df.columns.index(k) for k in _names(key)]

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            *split, row = batch.column(at).flatten()
            by = {f"by_{i}": c for i, c in enumerate([*map(batch.column, keys), *split])}
            rows = pa.table(by | {"row": row, "at": np.arange(batch.num_rows)})
            found = rows.group_by(list(by), use_threads=False).aggregate(
                [("row", "max"), ("row", "list"), ("at", "list")]).combine_chunks()
            listed, most = (found[c].chunk(0) for c in ("row_list", "row_max"))
            last = pc.equal(listed.flatten(), most.take(pc.list_parent_indices(listed)))
            kept = found["at_list"].chunk(0).flatten().filter(pc.fill_null(last, True)).to_numpy()
            yield batch.take(pa.array(np.sort(kept)))

    return df.mapInArrow(run, df.schema)


def number_places(frames: list[DataFrame], place: str) -> DataFrame | None:
    """A number for each place (all fields of the struct but the last, which numbers the rows there), in
    the order of the places; None where they are too many for a broadcast."""
    *split, _ = [f.name for f in frames[0].schema[place].dataType.fields]
    seen = union_rows(*[f.where(F.col(place).isNotNull()).select(*[F.col(place)[n].alias(f"__p_{n}") for n in split])
                        .distinct() for f in frames]).distinct()
    if not fits_broadcast(seen, seen.columns):
        return None
    numbered = seen.withColumn(_PLACE, F.row_number().over(Window.orderBy(*seen.columns)))     # a row for each split
    found = sized(numbered, materialize=True)
    return found.frame if found.broadcast else None


def with_number(df: DataFrame, places: DataFrame, place: str) -> DataFrame:
    """The rows with ``_PLACE`` and ``_AT`` (the number of their place, and in it) instead of the struct: of the
    same order, and much shorter where whole rows are shuffled and sorted."""
    *split, row = [f.name for f in df.schema[place].dataType.fields]
    same = [F.col(place)[n].eqNullSafe(F.col(f"__p_{n}")) for n in split]
    rest = [c for c in df.columns if c != place]
    return df.join(places, same, "left").select(*rest, _PLACE, F.col(place)[row].alias(_AT))


def with_place(df: DataFrame, places: DataFrame, place: str, kind: T.StructType) -> DataFrame:
    """The rows of ``with_number`` with their struct again."""
    *split, row = [f.name for f in kind.fields]
    known = places.withColumnRenamed(_PLACE, "__p_number")
    struct = F.struct(*[F.col(f"__p_{n}").alias(n) for n in split], F.col(_AT).alias(row))
    return (df.join(known, F.col(_PLACE) == F.col("__p_number"), "left")
            .withColumn(place, F.when(F.col(_PLACE).isNotNull(), struct)).drop(_PLACE, _AT, *known.columns))


def first_per_key(df: DataFrame, key, order=None) -> DataFrame:
    """A2: one row per key, the first in (order, full row) ascending order."""
    return _top1(df, key, order, descending=False)


def _key_cols(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)])


def _any_null(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def keyed_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
               how: str) -> DataFrame:
    """Semi or anti join on keys where null matches null (a null key is one key).

    Rows whose keys are all non-null join on plain equality, so a side already
    hash-partitioned on the key (by a keep-last window, say) is not shuffled
    again; rows with a null key component, at most one per null pattern in a
    table unique by key, join null-safely in a separate branch whose scan skips
    row groups without nulls.
    """
    eq = [left[a] == right[b] for a, b in zip(left_keys, right_keys)]
    whole = left.filter(~_any_null(left_keys)).join(right, eq, how)
    holes_right = right.filter(_any_null(right_keys))
    holes_left = left.filter(_any_null(left_keys))
    safe = [holes_left[a].eqNullSafe(holes_right[b]) for a, b in zip(left_keys, right_keys)]
    return whole.unionByName(holes_left.join(holes_right, safe, how))


@dataclass(frozen=True)
class BatchKeys:
    """The distinct keys of a batch, measured, and how often they came."""

    frame: DataFrame        # columns __k_0, __k_1, ... hinted for a join
    unique: bool
    small: bool             # proven to fit a broadcast
    most: int               # rows of the most frequent key
    rows: int               # of the batch
    keys: int               # of the frame
    covers: bool = False    # proven to have every key of the current rows
    near: int = 0           # rows that are left when of neighbours of one key one stays (0: not known)

    @property
    def one_shuffle(self) -> bool:
        """Is a merge in one shuffle of all rows the better plan?"""
        return not self.small and self.most <= HOT_ROWS

    @property
    def repeated(self) -> bool:
        """Do keys come so often that rows should be left out before that shuffle?"""
        often = self.rows >= NEAR * self.near if self.near else self.rows >= REPEATS * self.keys
        return self.one_shuffle and not self.unique and often


def batch_keys(batch: DataFrame, key) -> BatchKeys:
    """One keys-only aggregate that answers both: which keys, and is each there once?"""
    keys = _names(key)
    spark = batch.sparkSession
    counted = (_key_cols(batch, keys, "__k_").groupBy(*[f"__k_{i}" for i in range(len(keys))])
               .agg(F.count(F.lit(1)).alias("__n")))
    path = temp_dir(spark, "batch-keys")
    obs = Observation(f"batch_keys_{uuid.uuid4().hex}")
    (counted.observe(obs, F.max("__n").alias("n"), F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("keys"))
     .write.option("compression", "zstd").parquet(path))
    side = sized(spark.read.schema(counted.schema).parquet(path).drop("__n"))
    most = obs.get["n"] or 0
    return BatchKeys(side.frame, most <= 1, side.broadcast, most, obs.get["rows"] or 0, obs.get["keys"] or 0)


def count_keys(batch: DataFrame, key, exact: bool = True, current: DataFrame | None = None,
               place: str | None = None) -> BatchKeys:
    """As ``batch_keys``; the keys of a batch that are too many for a broadcast are not written.

    ``exact=False`` says that the batch's rows cross a shuffle whether their keys are unique or not. Then,
    and where keys are seen to come several times, no key is shuffled either: rows are counted by cells of
    their key's hash, of which the fullest bounds the most frequent key (``unique`` is then False, ``most``
    that bound and ``keys`` an estimate). If that bound is too high, keys are counted one by one. With
    ``current`` the same count says whether the batch has every key of these rows (``covers``). With
    ``place`` (see ``last_in_batches``) rows of a key that lie near each other in a file are estimated, too.
    """
    keys = _names(key)
    named = _key_cols(batch, keys, "__k_")
    if fits_broadcast(named, named.columns):
        return batch_keys(batch, keys)
    hashed = F.xxhash64(*named.columns)
    counts = [F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys))]
    if place:
        *split, row = [F.col(place)[f.name] for f in batch.schema[place].dataType.fields]
        counts.append(F.approx_count_distinct(F.xxhash64(*keys, *split, F.floor(row / NEIGHBOURS))))
    rows, about, *near = batch.agg(*counts).first()
    if about * _fixed_row_bytes(named) * HASH_FACTOR <= 2 * broadcast_limit(batch.sparkSession):
        return batch_keys(batch, keys)
    frame = named.distinct().hint("merge")
    if current is None and (not exact or rows > 1.25 * about):       # the estimate is within some 5 %
        cell = F.pmod(hashed, F.lit(max(1024, HASH_CELLS * rows // HOT_ROWS)))
        fullest = named.groupBy(cell.alias("cell")).count().agg(F.max("count")).first()[0]
        if fullest <= HOT_ROWS:
            return BatchKeys(frame, False, False, fullest, rows, about, near=sum(near))
    marked = named.withColumn("__new", F.lit(1))
    if current is not None:
        marked = marked.unionByName(_key_cols(current, keys, "__k_").withColumn("__new", F.lit(0)))
    counted = marked.groupBy(*named.columns).agg(F.sum("__new").alias("n"))
    most, n, lacking = counted.agg(F.max("n"), F.count(F.when(F.col("n") > 0, 1)),
                                   F.count(F.when(F.col("n") == 0, 1))).first()
    return BatchKeys(frame, most <= 1, False, most, rows, n, current is not None and lacking == 0, sum(near))


def upsert(current: DataFrame | None, batch: DataFrame, key, order=None,
           current_is_unique: bool = False, batch_is_unique: bool = False,
           batch_covers_current: bool = False, incoming: DataFrame | None = None,
           one_shuffle: bool = False, buckets: int = 1, volume: int = 0,
           none_lacking: bool = False) -> DataFrame:
    """Merge ``batch`` into ``current`` by key; the incoming row wins.

    Equal to ``keep_last(current (precedence 0) U batch (precedence 1))`` ordered by
    precedence, then ``order``, then the full row. ``current=None`` is a first load
    (all batch columns are kept); otherwise the output has ``current``'s columns.
    ``current_is_unique`` skips the dedupe of ``current`` when it was written by an
    earlier upsert (unique by construction), so the current table is only scanned;
    ``batch_is_unique`` does the same for a batch known to hold one row per key.
    ``incoming`` is the batch's key set where ``batch_keys`` has made it already; ``none_lacking`` says
    that a covering batch is proven to have every current key (``BatchKeys.covers``).

    ``one_shuffle`` (see ``BatchKeys``) takes ``keep_last_dealt`` for every dedupe, and for the
    merge of a batch that is neither small nor covering: current and incoming rows are shuffled
    once, straight to the ``buckets`` of the table (the rows then have ``BUCKET``). ``volume`` is
    their size in memory, where it is known.

    Else two exact plans for "current rows whose key is not in the batch":

    * default (a batch that is small next to the table, e.g. a day's drop): a
      left-anti join of the current rows against the batch keys; the key set is
      broadcast when it fits, and the current table is only scanned.
    * ``batch_covers_current=True`` (a full re-delivery, or the trusted re-merge of
      a cumulative raw table): only key columns are shuffled to find the current
      keys the batch lacks, and the current rows are semi-joined with that set,
      normally empty or small. Full current rows never cross the network.
    """
    keys = _names(key)
    if one_shuffle and current is not None and not batch_covers_current:
        both = (current.withColumn(_INCOMING, F.lit(0))
                .unionByName(batch.withColumn(_INCOMING, F.lit(1)), allowMissingColumns=True))
        merged = keep_last_dealt(both, keys, [_INCOMING, *_names(order)], buckets, volume)
        return merged.select(*current.columns, *([BUCKET] if buckets > 1 else []))
    newest = (batch if batch_is_unique else keep_last_dealt(batch, keys, order, buckets, volume) if one_shuffle
              else keep_last(batch, keys, order))
    if current is None:
        return newest
    covered = newest
    newest = newest.select(*current.columns)   # helper order columns are dropped
    if batch_covers_current and none_lacking:
        return covered.select(*newest.columns, *([BUCKET] if BUCKET in covered.columns else []))
    current_rows = current
    if not current_is_unique:
        current = keep_last(current, keys, [c for c in _names(order) if c in current.columns])
    # the keys of keep_last(batch) are exactly the distinct batch keys: an aggregate
    # (partial before the shuffle) is cheaper than reading the window's output twice
    made = incoming is not None
    if not made:
        incoming = _key_cols(batch, keys, "__k_")
        if not batch_is_unique:
            incoming = incoming.distinct()
    k_names = [f"__k_{i}" for i in range(len(keys))]
    c_names = [f"__c_{i}" for i in range(len(keys))]
    if not batch_covers_current:
        # the batch key set is materialised and measured: broadcast only when proven small
        side = incoming if made else sized(incoming, materialize=True).frame
        kept = keyed_join(current, side, keys, k_names, "left_anti")
        return newest.unionByName(kept)
    # the key set of the current table, taken from its rows (no keep-last needed)
    current_keys = _key_cols(current_rows, keys, "__c_")
    if not current_is_unique:
        current_keys = current_keys.distinct()
    incoming = incoming.hint("merge")             # a re-delivery: as large as the table
    orphans = sized(keyed_join(current_keys, incoming, c_names, k_names, "left_anti"),
                    materialize=True)
    if orphans.rows == 0:                         # every current key was re-delivered
        return covered.select(*newest.columns, *([BUCKET] if BUCKET in covered.columns else []))
    kept = keyed_join(current, orphans.frame, keys, c_names, "left_semi")
    return newest.unionByName(kept)


def group_rows(df: DataFrame, key, order: str, block_size: int = 256,
               rows_name: str = "rows", block: Column | None = None) -> DataFrame:
    """A1: rows of a key collected in ``order``, in lists of at most ``block_size`` rows.

    The output has ``key..., block, part, rows`` where ``block = floor(order /
    block_size)``. With unique integer ``order`` values inside a key every block is one
    part. Where order values repeat a block can hold more rows than that; such blocks
    (found by a count with partial sums) are cut into parts by the rows' place in a
    distributed sort, so no list ever holds more than ``block_size`` rows and no task
    needs all rows of a key. "The list of a key" is its parts in (block, part) order.
    For a non-numeric order (a timestamp, say) pass ``block`` (e.g. the hour).
    """
    keys = _names(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    if block is None:
        if not isinstance(df.schema[order].dataType, T.NumericType):
            raise ValueError(f"order column {order!r} is not numeric: pass block=")
        block = F.floor(F.col(order) / F.lit(block_size))
    rows = df.withColumn("block", block.cast("bigint"))
    cell = [*keys, "block"]

    def lists(frame: DataFrame) -> DataFrame:
        return (frame.groupBy(*[F.col(k) for k in cell], "part")
                .agg(F.sort_array(F.collect_list(F.struct(F.col(order), *[F.col(c) for c in rest])))
                     .alias(rows_name)))

    counts = rows.groupBy(*[F.col(k) for k in cell]).count().where(F.col("count") > block_size)
    full = sized(_key_cols(counts, cell, "__f_"), materialize=True)
    one = F.lit(0).cast("bigint")
    if full.rows == 0:
        return lists(rows.withColumn("part", one))
    names = [f"__f_{i}" for i in range(len(cell))]
    fits = keyed_join(rows, full.frame, cell, names, "left_anti").withColumn("part", one)
    over = keyed_join(rows, full.frame, cell, names, "left_semi")
    placed = with_positions(sort_rows(over, [*cell, order]), "__place")
    starts = placed.groupBy(*[F.col(k).alias(n) for k, n in zip(cell, names)]).agg(
        F.min("__place").alias("__start"))
    starts = sized(starts, materialize=True).frame
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(cell, names)]
    cut = (placed.join(starts, same).withColumn(
        "part", F.floor((F.col("__place") - F.col("__start")) / F.lit(block_size)).cast("bigint"))
        .drop("__place", "__start", *names))
    return lists(fits).unionByName(lists(cut))


def sort_rows(df: DataFrame, key) -> DataFrame:
    """O1: ascending by key (nulls last), then by the full row for a total order.

    A seeded random number is the last sort key: it only orders rows that are
    identical copies (so the output is the same), but lets the range partitioner
    spread a mass of copies over many tasks instead of one.
    """
    keys = _names(key)
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys],
                      *tie_break_order(df, keys), F.rand(seed=7))


def with_positions(sorted_df: DataFrame, name: str = "position") -> DataFrame:
    """1-based global position of each row of an ordered frame, without one task.

    Each row is tagged with its partition and its index inside the partition right
    after the sort, and the tagged rows are written as Parquet to the shared folder,
    which fixes them (a retried task cannot land rows in a different partition).
    Partition sizes (one row per partition) become offsets; only that table is
    broadcast, and its size is the partition count.
    """
    spark = sorted_df.sparkSession
    path = temp_dir(spark, "positions")
    sorted_df.select("*", F.spark_partition_id().alias("__pid"),
                     F.monotonically_increasing_id().alias("__mid")).write.parquet(path)
    fixed = spark.read.parquet(path)
    sizes = fixed.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0))
                           .alias("__off"))
    index = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return (fixed.join(F.broadcast(offsets), "__pid")
            .select(*[F.col(c) for c in sorted_df.columns],
                    (F.col("__off") + index + F.lit(1)).cast("bigint").alias(name)))
