"""What a load shuffles, stages and leaves on disk."""

import re
import threading

import pytest
from pyspark.sql import functions as F

from strata import session
from strata import specs as S
from strata.operators import merge
from strata.plans import catalog, jobs, standins
from strata.sinks import tables
from strata.sources import layers
from test_jobs import drop, land, load_buckets

SMALL = "/root/testdata/sf0.001"
ARRIVED = "struct<load: bigint, time: timestamp, path: string, block: bigint, row: bigint>"


@pytest.fixture()
def no_broadcast(spark):
    """Every batch is too large for a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_a_large_batch_are_counted_and_not_written(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(merge, "temp_dir", lambda *a: pytest.fail("keys are written"))
    df = spark.createDataFrame([(None if i == 7 else i, str(i % 3)) for i in range(500)], "k long, v string")
    once = merge.count_keys(df, "k")
    assert once.unique and once.most == 1 and (once.rows, once.keys) == (500, 500) and once.one_shuffle
    assert once.frame.count() == 500 and not once.repeated
    twice = merge.count_keys(df.union(df.limit(1)), "k")            # seen by an exact count only
    assert not twice.unique and twice.most == 2 and (twice.rows, twice.keys) == (501, 500)
    cells = merge.count_keys(df, "k", exact=False)
    assert not cells.unique and 1 <= cells.most <= 500 and cells.one_shuffle
    monkeypatch.setattr(merge, "HOT_ROWS", 1)                       # a cell has more: counted one by one
    assert merge.count_keys(df, "k", exact=False).unique
    assert merge.count_keys(df.union(df).union(df), "k", exact=False).most == 3


def test_a_key_count_says_whether_a_batch_covers_the_current_rows(spark, no_broadcast):
    keys = [(None,), *((i,) for i in range(300))]
    batch, current = (spark.createDataFrame(k, "k int") for k in (keys, keys[:200]))
    assert merge.count_keys(batch, "k", current=current).covers
    assert not merge.count_keys(current, "k", current=batch).covers
    assert not merge.count_keys(batch.where("k is not null"), "k", current=current).covers
    assert not merge.count_keys(batch, "k").covers                  # not asked


def test_near_repeats_are_told_from_far_ones(spark, no_broadcast):
    rows = [(i % 2000, (1, None, "p", 0, i)) for i in range(4000)]
    schema = f"k int, _arrival {ARRIVED}"
    by_key = [(i // 2, (1, None, "p", 0, i)) for i in range(4000)]
    assert merge.count_keys(spark.createDataFrame(by_key, schema), "k", exact=False, place="_arrival").repeated
    monkey = merge.NEIGHBOURS
    merge.NEIGHBOURS = 1000
    try:
        far = merge.count_keys(spark.createDataFrame(rows, schema), "k", exact=False, place="_arrival")
    finally:
        merge.NEIGHBOURS = monkey
    assert far.keys < 2400 and not far.repeated


def test_numbered_places_are_in_the_order_of_arrival(spark):
    """A number instead of load, time and path gives the same last row, and the same arrival again."""
    data = [(f"k{i % 9}", i, (load, None, path, block, (i * 7) % 50)) for i, (load, path, block) in enumerate(
        [(load, path, block) for load in (None, 1, 2) for path in ("b", "a", "a/b") for block in (128, 0)] * 6)]
    data += [(f"k{i}", 1000 + i, None) for i in range(12)]           # versions written without an arrival
    df = spark.createDataFrame(data, f"k string, v int, _arrival {ARRIVED}")
    places = merge.number_places([df.limit(40), df], "_arrival")
    numbered = merge.with_number(df, places, "_arrival")
    assert "_arrival" not in numbered.columns and places.count() == 18
    again = merge.with_place(numbered, places, "_arrival", df.schema["_arrival"].dataType)
    assert sorted(map(str, again.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    want = merge.keep_last(df, "k", "_arrival").select("k", "v")
    got = merge.keep_last_dealt(numbered, "k", [merge._PLACE, merge._AT]).select("k", "v")
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("size", [1 << 28, 1000])
def test_no_path_crosses_the_shuffle_of_a_large_drop(spark, tmp_dir, no_broadcast, monkeypatch, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")          # the places fit, 300 keys do not
    plans = []
    write = tables.write_version

    def spy(df, path, *args, **kw):
        if "/raw/" in path:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, path, *args, **kw)

    monkeypatch.setattr(tables, "write_version", spy)
    first = [(i, f"city{i}") for i in range(300)] + [(i, f"later{i}") for i in range(0, 300, 2)]
    second = [(i, f"new{i}") for i in range(100, 400)]
    third = [(i, f"third{i}") for i in range(400)] * 2
    base = f"{tmp_dir}/lake"
    for n, batch in enumerate((first, second)):
        load_buckets(spark, drop(tmp_dir, n, batch), base, size)
    load_buckets(spark, drop(tmp_dir, 2, third), base, size, full_snapshot=True)
    assert len(plans) == 3
    for plan in plans:                                               # printed from the last step to the first
        above, below = plan.split(" Exchange ", 1)
        assert "__p_path" in above and "BroadcastHashJoin" in above       # the path is put back
        assert not re.search(r"_arrival#\d+[],]", below.splitlines()[1]) and "BroadcastHashJoin" in below
    got = layers.read_layer(spark, jobs.table_path(base, jobs.RAW, S.SELLERS))
    assert sorted((r.seller_id, r.seller_city) for r in got.collect()) == sorted((f"s{k}", v) for k, v in dict(third).items())
    assert {r[0] for r in got.select("_arrival.load").distinct().collect()} == {3}
    assert got.where("_arrival.path is null or _arrival.row is null or _arrival.time is null").isEmpty()


def test_a_snapshot_that_lacks_keys_keeps_their_rows(spark, tmp_dir, no_broadcast):
    first = [(i, f"city{i}") for i in range(300)] * 2
    base = f"{tmp_dir}/lake"
    load_buckets(spark, drop(tmp_dir, 0, first), base, 1 << 28)
    second = [(i, f"new{i}") for i in range(100, 400)] * 2
    assert load_buckets(spark, drop(tmp_dir, 1, second), base, 1 << 28, full_snapshot=True) == 400
    got = layers.read_layer(spark, jobs.table_path(base, jobs.RAW, S.SELLERS))
    model = dict(first) | dict(second)
    assert sorted((r.seller_id, r.seller_city) for r in got.collect()) == sorted((f"s{k}", v) for k, v in model.items())
    assert {r[0]: r[1] for r in got.groupBy("_arrival.load").count().collect()} == {1: 100, 2: 300}


def test_cast_keys_that_stay_unique_need_no_shuffle_of_rows(spark, tmp_dir, no_broadcast, monkeypatch):
    """payments' rows went through the window, in a re-run twice."""
    plans = []
    write = tables.write_version

    def spy(df, path, *args, **kw):
        if "/trusted/" in path:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, path, *args, **kw)

    monkeypatch.setattr(tables, "write_version", spy)
    body = "".join(f"o{i % 50},{i},card,{i % 3},1.5\n" for i in range(200))
    for n, more in enumerate(("", "", "o7,0007,cash,1,2.5\n")):      # '0007' and '7' are one key once cast
        src = land(f"{tmp_dir}/l{n}", S.PAYMENTS, body + more).rsplit("/", 1)[0]
        jobs.load_raw(spark, S.PAYMENTS, src, f"{tmp_dir}/lake", full_snapshot=True)
        assert jobs.load_trusted(spark, S.PAYMENTS, f"{tmp_dir}/lake", raw_unique=True, full_snapshot=True) == 200
    assert ["Window" in p for p in plans] == [False, False, True]
    got = layers.read_layer(spark, jobs.table_path(f"{tmp_dir}/lake", jobs.TRUSTED, S.PAYMENTS))
    assert [r.payment_type for r in got.where("order_id = 'o7' and payment_sequential = 7").collect()] == ["cash"]


def test_a_staged_copy_holds_running_numbers_as_differences(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    df = spark.range(0, 20000, 1, 1).select(F.concat(F.lit("order"), "id").alias("k"), "id")
    assert tables.stage(df, f"{tmp_dir}/stage").count() == 20000
    group = pq.ParquetFile(glob.glob(f"{tmp_dir.removeprefix('file:')}/stage/*.parquet")[0]).metadata.row_group(0)
    assert {group.column(i).compression for i in range(2)} == {"ZSTD"}
    assert group.total_byte_size < 150_000                            # plain values: 460,000
    assert layers.size_of(spark, [f"{tmp_dir}/stage"]) < 100_000


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_with_the_action_that_made_them(spark, tmp_dir):
    import time

    before = shuffle_files(spark)
    setting = spark.conf.get(session.RELEASE_KEY, None)
    with session.temporary(spark):
        assert spark.conf.get(session.RELEASE_KEY) == "true"
        spark.range(1000).repartition(3, "id").write.parquet(f"{tmp_dir}/rows")
        for _ in range(50):
            left = shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.2)
    assert not left and spark.read.parquet(f"{tmp_dir}/rows").count() == 1000
    assert spark.conf.get(session.RELEASE_KEY, None) == setting


def test_the_setting_comes_back_when_the_last_thread_leaves(spark):
    setting, inside, leave, seen = spark.conf.get(session.RELEASE_KEY, None), threading.Event(), threading.Event(), []

    def other():
        with session.released(spark):
            inside.set()
            leave.wait(20)
            seen.append(spark.conf.get(session.RELEASE_KEY))

    thread = threading.Thread(target=other)
    with session.released(spark):
        thread.start()
        assert inside.wait(20)
    assert spark.conf.get(session.RELEASE_KEY) == "true"              # the other thread is still inside
    leave.set()
    thread.join()
    assert seen == ["true"] and spark.conf.get(session.RELEASE_KEY, None) == setting

@pytest.mark.parametrize("name", ["items", "geolocation", "reviews"])
def test_a_dealt_feed_shuffles_the_tables_own_rows(spark, name):
    """the landing drops' texts went through the shuffle."""
    spec = S.SPECS[name]
    feed = standins.feed(spark, SMALL, spec)
    dealt = catalog.dealt_feed(spark, SMALL, spec, spec.keys())
    assert dealt.exceptAll(feed).isEmpty() and feed.exceptAll(dealt).isEmpty() and dealt.schema == feed.schema
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Project") < plan.index("RepartitionByExpression")      # texts are made above the shuffle
    parts = dealt.select(*spec.keys(), F.spark_partition_id().alias("p")).distinct().groupBy(*spec.keys()).count()
    assert parts.where("count > 1").isEmpty()


def test_texts_are_published_smaller_than_at_the_codecs_own_level(spark, tmp_dir):
    """layer and published files of reviews are most of what a run leaves on disk."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    docs.write.option("compression", "zstd").parquet(f"{tmp_dir}/plain")
    assert tables.publish(docs, path=f"{tmp_dir}/published") == docs.count()
    plain, published = (layers.size_of(spark, [f"{tmp_dir}/{n}"]) for n in ("plain", "published"))
    assert published < 0.98 * plain
    assert spark.read.parquet(f"{tmp_dir}/published").exceptAll(docs).isEmpty()
