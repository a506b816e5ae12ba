"""Union, keep-last, grouping, first-per-key, sort, upsert."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import merge
from strata.sources import layers

SCHEMA = "k string, seq int, v string"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([("o1", 1, "x")], SCHEMA)
    assert merge.union_rows(a, a, a).count() == 3


def test_duplicates_in_one_batch_later_sequence_wins(spark):
    batch = spark.createDataFrame([("o1", 1, "created"), ("o1", 2, "delivered")], SCHEMA)
    assert rows(merge.keep_last(batch, "k", "seq")) == [("o1", 2, "delivered")]


def test_batch_over_snapshot(spark):
    snap = spark.createDataFrame([("o1", 0, "old1"), ("o2", 0, "old2")], SCHEMA)
    batch = spark.createDataFrame([("o2", 0, "new2"), ("o3", 0, "new3")], SCHEMA)
    got = rows(merge.upsert(snap, batch, "k", "seq"), "k", "v")
    assert got == [("o1", "old1"), ("o2", "new2"), ("o3", "new3")]


def test_incoming_wins_even_with_lower_sequence(spark):
    snap = spark.createDataFrame([("o1", 9, "old")], SCHEMA)
    batch = spark.createDataFrame([("o1", 1, "new")], SCHEMA)
    assert rows(merge.upsert(snap, batch, "k", "seq"), "v") == [("new",)]


def test_first_load(spark):
    batch = spark.createDataFrame([("o1", 0, "a"), ("o2", 0, "b")], SCHEMA)
    assert rows(merge.upsert(None, batch, "k"), "k") == [("o1",), ("o2",)]


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 1, "c")], SCHEMA)
    got = rows(merge.keep_last(df, "k", "seq"), "k", "v")
    assert got == sorted([(None, "b"), ("x", "c")], key=str)
    snap = spark.createDataFrame([(None, 0, "old")], SCHEMA)
    up = merge.upsert(snap, spark.createDataFrame([(None, 0, "new")], SCHEMA), "k")
    assert [r.v for r in up.collect()] == ["new"]


def test_items_natural_against_reference_key(spark):
    items = spark.createDataFrame([("o1", "1", "p1"), ("o1", "2", "p2")], "order_id string, "
                                  "order_item_id string, product_id string")
    assert merge.keep_last(items, ["order_id", "order_item_id"]).count() == 2
    assert rows(merge.keep_last(items, "order_id"), "order_item_id") == [("2",)]


def test_full_row_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "c"), ("k", 1, "b")], SCHEMA)
    for n in (1, 3, 7):
        assert rows(merge.keep_last(df.repartition(n), "k", "seq"), "v") == [("c",)]
        assert rows(merge.first_per_key(df.repartition(n), "k", "seq"), "v") == [("a",)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("u", 3, "c"), ("u", 1, "a"), ("w", 2, "b")], SCHEMA)
    assert rows(merge.first_per_key(df, "k", "seq"), "k", "v") == [("u", "a"), ("w", "b")]


def test_group_rows_blocks(spark):
    df = spark.createDataFrame([("c", t, f"t{t}") for t in range(10)] + [("d", 0, "x")], SCHEMA)
    g = merge.group_rows(df, "k", "seq", block_size=4).orderBy("k", "block").collect()
    assert [(r.k, r.block, [x.seq for x in r.rows]) for r in g] == [
        ("c", 0, [0, 1, 2, 3]), ("c", 1, [4, 5, 6, 7]), ("c", 2, [8, 9]), ("d", 0, [0])]


def test_sort_rows_with_positions(spark):
    data = [(None, 1, "z"), ("b", 2, "y"), ("a", 3, "x"), ("b", 1, "w")] * 3
    df = spark.createDataFrame(data, SCHEMA)
    for n in (1, 7):
        out = merge.with_positions(merge.sort_rows(df.repartition(n), "k")).collect()
        ordered = [(r.k, r.seq, r.v) for r in sorted(out, key=lambda r: r.position)]
        assert [r.position for r in sorted(out, key=lambda r: r.position)] == list(range(1, 13))
        assert ordered == ([("a", 3, "x")] * 3 + [("b", 1, "w")] * 3 + [("b", 2, "y")] * 3
                           + [(None, 1, "z")] * 3)


def test_upsert_idempotent_and_unique(spark):
    snap = spark.createDataFrame([(f"k{i % 5}", i, f"s{i}") for i in range(20)], SCHEMA)
    batch = spark.createDataFrame([(f"k{i % 7}", i, f"b{i}") for i in range(14)], SCHEMA)
    once = merge.upsert(snap, batch, "k", "seq")
    twice = merge.upsert(once, batch, "k", "seq", current_is_unique=True)
    assert rows(once) == rows(twice)
    assert once.groupBy("k").count().filter("count > 1").count() == 0


def test_upsert_does_not_shuffle_current_when_unique(spark):
    snap = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(0).alias("seq"),
                                    F.lit("s").alias("v"))
    batch = spark.createDataFrame([("1", 1, "b")], SCHEMA)
    up = merge.upsert(snap, batch, "k", "seq", current_is_unique=True)
    assert up.count() == 1000
    up.collect()                      # AQE settles the final plan on measured sizes
    plan = up._jdf.queryExecution().executedPlan().toString()
    # the small batch's keys are broadcast; the current table is scanned, not shuffled
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def model_upsert(current, batch):
    """Pure-Python model: keep_last over (precedence, seq, row)."""
    best = {}
    for prec, rs in ((0, current), (1, batch)):
        for k, seq, v in rs:
            rank = (prec, seq if prec == 1 else 0, (seq, v))
            if k not in best or rank > best[k][0]:
                best[k] = (rank, (k, seq, v))
    return sorted((r for _, r in best.values()), key=str)


row_st = st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3),
                   st.sampled_from(["x", "y", "z"]))


@settings(max_examples=15, deadline=None)
@given(st.lists(row_st, max_size=8), st.lists(row_st, max_size=8), st.integers(1, 5),
       st.booleans())
def test_upsert_matches_model(spark, current, batch, parts, covers):
    cur = spark.createDataFrame(current, SCHEMA).repartition(parts)
    bat = spark.createDataFrame(batch, SCHEMA).repartition(parts)
    out = merge.upsert(cur, bat, "k", "seq", batch_covers_current=covers)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == model_upsert(current, batch)


def test_covering_batch_shuffles_keys_not_rows(spark, tmp_dir):
    # a re-delivery of the whole table: only keys are compared, full rows never shuffle
    cur = spark.range(20000).select(F.col("id").cast("string").alias("k"),
                                    F.lit(0).alias("seq"), F.lit("x" * 50).alias("v"))
    cur.write.parquet(f"{tmp_dir}/cur")
    cur = spark.read.parquet(f"{tmp_dir}/cur")
    full = cur.withColumn("seq", F.lit(1))
    out = merge.upsert(cur, full, "k", "seq", current_is_unique=True, batch_is_unique=True,
                       batch_covers_current=True)
    assert out.count() == 20000 and out.filter("seq = 1").count() == 20000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan      # nothing left to merge
    # three keys are missing from the batch: they come back through a broadcast semi-join
    partial = full.filter(~F.col("k").isin("1", "2", "3"))
    out = merge.upsert(cur, partial, "k", "seq", current_is_unique=True, batch_is_unique=True,
                       batch_covers_current=True)
    got = {r.k: r.seq for r in out.collect()}
    assert len(got) == 20000 and got["1"] == 0 and got["4"] == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_sized_broadcast_needs_proof(spark):
    from strata.operators.joins import broadcast_limit, sized
    small = sized(spark.range(10))
    assert small.broadcast and small.rows == 10
    big = sized(spark.range(10), limit=100)
    assert not big.broadcast
    assert broadcast_limit(spark) == 10 * 1024 * 1024


def test_group_rows_by_time_blocks(spark):
    import datetime as dt
    import pytest
    df = spark.createDataFrame([("u", dt.datetime(2024, 1, 1, h, 0), str(h)) for h in range(5)],
                               "k string, ts timestamp, v string")
    with pytest.raises(ValueError, match="not numeric"):
        merge.group_rows(df, "k", "ts")
    g = merge.group_rows(df, "k", "ts", block=F.floor(F.hour("ts") / 2)).orderBy("block").collect()
    assert [[x.v for x in r.rows] for r in g] == [["0", "1"], ["2", "3"], ["4"]]


def test_sized_decides_big_fixed_width_sides_from_the_count(spark, tmp_dir):
    from strata.operators.joins import sized
    spark.range(5000).select("id", (F.col("id") * 2).alias("x")).write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")
    m = sized(t, limit=1000)                       # 5000 rows x 40 bytes x 2 > 1000
    assert not m.broadcast and m.rows == 5000
    m = sized(t)                                   # fits the default 10 MB
    assert m.broadcast and m.bytes == 5000 * (24 + 16) * 2
    s = sized(t.select("id", F.lit("abc").alias("s")), limit=5000 * (24 + 16 + 3) * 2)
    assert s.broadcast and s.bytes == 5000 * (24 + 16 + 3) * 2


def test_keyed_join_null_safe_composite_keys(spark):
    left = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, None, 3), ("b", "y", 4)],
                                 "k1 string, k2 string, v int")
    right = spark.createDataFrame([("a", None), (None, None), ("b", "z")], "r1 string, r2 string")
    anti = merge.keyed_join(left, right, ["k1", "k2"], ["r1", "r2"], "left_anti")
    semi = merge.keyed_join(left, right, ["k1", "k2"], ["r1", "r2"], "left_semi")
    assert sorted(r.v for r in anti.collect()) == [2, 4]
    assert sorted(r.v for r in semi.collect()) == [1, 3]


def test_sort_spreads_a_mass_of_copies(spark):
    # a third of the rows are one identical copy: they must not land in one range partition
    copies = spark.range(3000).select(F.lit("same").alias("k"), F.lit(1).alias("seq"),
                                      F.lit("v").alias("v"))
    rest = spark.range(6000).select(F.col("id").cast("string").alias("k"),
                                    F.lit(1).alias("seq"), F.lit("v").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = merge.sort_rows(copies.unionByName(rest).repartition(6), "k")
        sizes = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 3000


def _model_top(rows_, last):
    """keep_last / first_per_key model: per key, max / min of (seq, v) with None lowest."""
    def rank(r):
        k, seq, v = r
        return ((seq is not None, seq if seq is not None else 0),
                (v is not None, v if v is not None else ""))
    best = {}
    for r in rows_:
        k = r[0]
        if k not in best or (rank(r) > rank(best[k]) if last else rank(r) < rank(best[k])):
            best[k] = r
    return sorted(best.values(), key=str)


nullable_row = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 2)),
                         st.one_of(st.none(), st.sampled_from(["x", "y"])))


@settings(max_examples=15, deadline=None)
@given(st.lists(nullable_row, max_size=10), st.integers(1, 4))
def test_keep_last_and_first_match_model(spark, data, parts):
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    last = sorted((tuple(r) for r in merge.keep_last(df, "k", "seq").collect()), key=str)
    first = sorted((tuple(r) for r in merge.first_per_key(df, "k", "seq").collect()), key=str)
    assert last == _model_top(data, last=True)
    assert first == _model_top(data, last=False)


def test_group_rows_bounds_lists_of_equal_order_values(spark):
    df = spark.range(3000).selectExpr("id % 2 as k", "cast(7 as bigint) as ord", "id as v")
    extra = spark.createDataFrame([(None, 1, -1), (5, 300, -2), (5, 301, -3)], "k long, ord long, v long")
    out = merge.group_rows(df.union(extra), "k", "ord", block_size=256).collect()
    assert max(len(r.rows) for r in out) <= 256
    by_key = {}
    for r in sorted(out, key=lambda r: (r.k is None, r.k, r.block, r.part)):
        by_key.setdefault(r.k, []).extend(x.v for x in r.rows)
    assert by_key == {0: list(range(0, 3000, 2)), 1: list(range(1, 3000, 2)), None: [-1], 5: [-2, -3]}


def test_nested_sides_are_measured(spark):
    from strata.operators.joins import sized
    wide = spark.range(200).selectExpr("id", "sequence(0, 20000) as xs", "struct(id as a, 'x' as b) as s")
    assert not sized(wide, limit=1 << 20).broadcast
    small = spark.range(5).selectExpr("id", "array(1, 2) as xs", "map('a', 1) as m")
    assert sized(small, limit=1 << 20).broadcast
    assert sized(wide, limit=1 << 20).bytes > 200 * 20000 * 8


def test_batch_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k long, v string")
    one = merge.batch_keys(df, "k")
    assert one.unique and one.frame.count() == 3
    two = merge.batch_keys(df.union(df), "k")
    assert not two.unique and two.frame.count() == 3
    assert merge.batch_keys(df.limit(0), "k").unique


@pytest.mark.parametrize("buckets", [1, 4])
def test_one_shuffle_merge_deals_rows_once(spark, buckets):
    """no sort of whole rows before the shuffle, one shuffle to window, buckets and files."""
    cur = [(f"o{i}" if i else None, i, f"old{i}") for i in range(40)]
    bat = [(f"o{i}" if i else None, s, f"new{i}-{s}") for i in range(0, 60, 3) for s in (2, 1, 3)]
    current, batch = spark.createDataFrame(cur, SCHEMA), spark.createDataFrame(bat, SCHEMA)
    plain = merge.upsert(current, batch, "k", "seq", current_is_unique=True)
    out = merge.upsert(current, batch, "k", "seq", current_is_unique=True, one_shuffle=True, buckets=buckets)
    assert rows(out.select("k", "seq", "v"), "k", "v") == rows(plain, "k", "v")
    assert ("__bucket" in out.columns) == (buckets > 1)
    order = [*(["__bucket"] if buckets > 1 else []), "k"]
    plan = out.sortWithinPartitions(*order)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    before = plan[plan.index("Exchange"):]                  # printed from the last step to the first
    assert "WindowGroupLimit" not in before and "Sort" not in before
    first = merge.upsert(None, batch, "k", "seq", one_shuffle=True, buckets=buckets)
    assert rows(first.select("k", "seq", "v"), "k", "v") == rows(merge.keep_last(batch, "k", "seq"), "k", "v")


def test_a_hot_key_keeps_the_step_before_the_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, "x")] * 5 + [("b", 1, "y")], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert merge.batch_keys(df, "k").one_shuffle
        monkeypatch.setattr(merge, "HOT_ROWS", 4)
        found = merge.batch_keys(df, "k")
        assert found.most == 5 and not found.small and not found.one_shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("buckets", [1, 4])
def test_large_volumes_are_dealt_by_their_size_in_memory(spark, buckets):
    """AQE joins partitions by their compressed bytes, so that each task's sort spilled."""
    bat = [(f"o{i}" if i else None, s, f"new{i}-{s}") for i in range(400) for s in (2, 1, 3)]
    batch = spark.createDataFrame(bat, SCHEMA)
    out = merge.upsert(None, batch, "k", "seq", one_shuffle=True, buckets=buckets,
                       volume=40 * layers.TASK_BYTES)
    assert out.rdd.getNumPartitions() == 40
    assert rows(out.select("k", "seq", "v"), "k", "v") == rows(merge.keep_last(batch, "k", "seq"), "k", "v")
    plan = out.sortWithinPartitions("k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    if buckets > 1:                                   # a task's rows are of one bucket
        tasks = out.select(F.spark_partition_id().alias("t"), layers.BUCKET).distinct().groupBy("t").count()
        assert tasks.where("count > 1").isEmpty()
        right = layers.bucket_of([F.col("k")], buckets)
        assert out.where(F.col(layers.BUCKET) != right).isEmpty()


ARRIVED = "struct<load: bigint, time: timestamp, path: string, block: bigint, row: bigint>"


@pytest.mark.parametrize("per_batch", [1, 7, 10_000])
def test_rows_of_a_batch_that_a_later_one_replaces_are_left_out(spark, per_batch):
    """each row of a key went through the shuffle, though one of them stays."""
    rng = random.Random(per_batch)
    keys = [None, "", "a", "b", "c"]
    data = [(rng.choice(keys), rng.choice([None, 1]), i, (None, None, rng.choice(["p", "q"]), 0, rng.randrange(300)))
            for i in range(400)]
    df = spark.createDataFrame(data, f"k string, n int, v int, _arrival {ARRIVED}").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        thin = merge.last_in_batches(df, ["k", "n"], "_arrival")
        assert thin.schema == df.schema
        got = thin.collect()
        assert merge.last_in_batches(df.limit(0), ["k", "n"], "_arrival").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []                       # by the definition, batch by batch; rows that arrived at one place stay, all of them
    for start in range(0, len(data), per_batch):
        part, last = data[start:start + per_batch], {}
        for k, n, _, at in part:
            last[k, n, at[:4]] = max(last.get((k, n, at[:4]), -1), at[4])
        want += [r for r in part if r[3][4] == last[r[0], r[1], r[3][:4]]]
    assert [tuple(r[:3]) for r in got] == [r[:3] for r in want]
    final = [merge.keep_last(x, ["k", "n"], "_arrival").orderBy("v").collect() for x in (df, thin)]
    assert final[0] == final[1]
