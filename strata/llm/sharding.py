"""Sharding by rendezvous hashing of stable record keys over weighted shards.

For each shard a hash of (shard, key) gives a number u in (0, 1); the record goes to
the shard with the smallest -ln(u) / weight. A shard's score depends on nothing
but the key, its own name and its own weight, so a new shard only takes records
(those where it scores best) and none moves between the old ones.

All DataFrame expressions: one narrow projection picks the shard. Slots (0, 1, ...
inside each shard) come from one range-partitioned sort on (shard, key): a shard
is cut into many tasks, and only one row for each (task, shard) is added up.

Defined results: a null key is a key of its own; equal keys go to one shard; a null
or empty text has size 1 and CRC 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ID, write_table

MANTISSA = 1 << 53


def score(key: Column, shard: int, weight: float) -> Column:
    """The shard's score for the key; the smallest one wins."""
    h = F.xxhash64(F.lit(shard), key)
    u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(MANTISSA))
    return -F.log(u) / F.lit(float(weight))


def choose(key: Column, weights: Sequence[float]) -> Column:
    """The winning shard, (score, shard) being smallest; a weight of zero never wins."""
    if not any(w > 0 for w in weights):
        raise ValueError("a shard needs a positive weight")
    cells = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard"))
             for s, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*cells))["shard"]


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], slot: str) -> DataFrame:
    """Gapless numbers from 0 inside each shard, in ``order``.

    The sorted rows are written once with their place in the sort, so every retry
    reads the same order; offsets are sums over one row for each (task, shard). A
    random last sort key lets equal rows lie in more than one task.
    """
    placed = (rows.repartitionByRange(*[F.col(c) for c in (shard, *order)], F.rand(7))
              .sortWithinPartitions(shard, *order)
              .withColumn("__task", F.spark_partition_id())
              .withColumn("__place", F.monotonically_increasing_id()))
    placed = write_table(placed, "slots")
    runs = placed.groupBy("__task", shard).agg(F.count(F.lit(1)).alias("__n"),
                                               F.min("__place").alias("__first"))
    before = Window.partitionBy(shard).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("__task", shard, (F.coalesce(F.sum("__n").over(before), F.lit(0))
                                         - F.col("__first")).alias("__shift"))
    # at most a row for each pair of task and shard that meet: tasks + shards - 1 rows
    return (placed.join(F.broadcast(runs), ["__task", shard])
            .withColumn(slot, F.col("__place") + F.col("__shift"))
            .drop("__task", "__place", "__shift"))


def assign(docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, grown_by: float = 1.0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    ``grown_shard`` is the shard when one more, of weight ``grown_by``, is added.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null:"))
    rows = docs.select(F.col(f"`{id_col}`").alias(ID), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       choose(key, weights).alias("shard"),
                       choose(key, [*weights, grown_by]).alias("grown_shard"))
    slotted = with_slots(rows, "shard", [ID, "text_crc32", "size"], "slot")
    return slotted.select(F.col(ID).alias(id_col), "size", "text_crc32", F.lit("key").alias("law"),
                          "shard", "slot", "grown_shard")
