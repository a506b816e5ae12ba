"""Multiline files read in splits against Spark's one-task reader; malformed rows routed aside."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, write_text
from strata import specs as S
from strata.plans import jobs, standins
from strata.plans.standins import table
from strata.sources import csv as C
from strata.sources import layers
from strata.sources.multiline import in_whole_files, read_multiline, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


@pytest.fixture()
def small_splits(spark):
    """Splits of some bytes: records and quoted fields span several of them."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def value(rng):
    text = "".join(rng.choice(["a", "bc", " ", "é文", "\n", "\n\n", '"', ",", "x" * 50, "\r\n", "\t"])
                   for _ in range(rng.randint(0, 5)))
    plain = not any(c in text for c in ',"\n\r') and rng.random() < 0.5
    return text if plain else '"' + text.replace('"', '""') + '"'


def both(spark, path, schema=SCHEMA, header=True):
    names = [*schema.names, C.CORRUPT]
    one = C.read_csv(spark, path, schema, multiline=True, corrupt_column=C.CORRUPT, header=header).cache()
    many = read_multiline(spark, path, schema, header).cache()
    order = lambda df: sorted(map(tuple, df.select(*names).collect()), key=str)
    return order(one), order(many), many


def test_random_files_equal_the_one_task_reader(spark, tmp_dir, small_splits):
    rng = random.Random(11)
    for n in range(12):
        end = rng.choice(["\n", "\n", "\r\n"])
        path = f"{tmp_dir}/{n}"
        for f in range(rng.randint(1, 3)):
            rows = [",".join(value(rng) for _ in range(rng.choice([3, 3, 3, 2, 4]))) for _ in range(rng.randint(0, 25))]
            rows = [r for r in rows if r.strip()]
            body = end.join(["a,b,c", *rows]) + rng.choice(["", end])
            if end == "\n":
                body = body.replace("\r\n", "\n")
            write_text(f"{path}/part-{f}.csv", body)
        one, many, _ = both(spark, path)
        # in files whose lines end in \r\n Spark turns that into \n inside fields, too
        many = [(*((v and v.replace("\r\n", "\n")) for v in r[:3]), r[3]) for r in many]
        assert sorted(one, key=str) == sorted(many, key=str), n


def test_documents_in_many_splits(spark, tmp_dir):
    docs = table(spark, SF_SMALL, "documents")
    path = C.write_csv(docs.coalesce(1), f"{tmp_dir}/csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        one, many, frame = both(spark, path, docs.schema)
        assert one == many and len(one) == docs.count()
        assert frame.select("_arrival.block").distinct().count() > 5
        assert frame.groupBy("_arrival").count().where("count > 1").count() == 0
        plan = records(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_quote_that_never_closes(spark, tmp_dir, small_splits):
    body = "a,b,c\n1,x,y\n2,\"open " + "text\n" * 60 + "3,x,y\n4,x,y\n"
    write_text(f"{tmp_dir}/l/part-0.csv", body)
    write_text(f"{tmp_dir}/l/part-1.csv", "a,b,c\n5,\"closed\nhere\",z\n")
    rows = {r.a: r for r in read_multiline(spark, f"{tmp_dir}/l", SCHEMA).collect()}
    assert set(rows) == {"1", "2", "5"}                       # the record reaches to its file's end
    assert rows["2"][C.CORRUPT] is not None and rows["5"].b == "closed\nhere"


def test_no_rows_and_no_header(spark, tmp_dir, small_splits):
    write_text(f"{tmp_dir}/e/part-0.csv", "a,b,c\n")
    write_text(f"{tmp_dir}/e/part-1.csv", "")
    assert read_multiline(spark, f"{tmp_dir}/e", SCHEMA).count() == 0
    write_text(f"{tmp_dir}/h/part-0.csv", "1,\"two\nlines\",3\n\n4,5,6")
    assert sorted(r.a for r in read_multiline(spark, f"{tmp_dir}/h", SCHEMA, header=False).collect()) == ["1", "4"]


def test_order_of_arrival_in_a_split_file(spark, tmp_dir, small_splits):
    header = ",".join(S.REVIEWS.columns)
    body = "".join(f'r{n % 7},o1,{n % 5},t,"line {n}\nand more",,\n' for n in range(60))
    write_text(f"{tmp_dir}/l/part-0.csv", f"{header}\n{body}")
    jobs.load_raw(spark, S.REVIEWS, f"{tmp_dir}/l", f"{tmp_dir}/lake")
    rows = layers.read_layer(spark, jobs.table_path(f"{tmp_dir}/lake", jobs.RAW, S.REVIEWS)).collect()
    assert {r.review_id: r.review_comment_message for r in rows} == {
        f"r{k}": f"line {max(n for n in range(60) if n % 7 == k)}\nand more" for k in range(7)}


def test_malformed_rows_are_routed_aside(spark, tmp_dir):
    header = ",".join(S.SELLERS.columns) + "\n"
    base = f"{tmp_dir}/lake"
    write_text(f"{tmp_dir}/l/part-0.csv",
               header + 's1,1,"a, ""b""",SP\ns2,2,b\ns3,3,c,SP,more\ns4,4,"d,e",SP\ns1,9\n')
    assert jobs.raw_load(spark, S.SELLERS, f"{tmp_dir}/l", base, on_malformed="reject") == (2, 3)
    bad = spark.read.parquet(jobs.rejects_path(base, S.SELLERS)).collect()
    assert sorted((r.line, r.reason, r.load) for r in bad) == [
        ("s1,9", "short", 1), ("s2,2,b", "short", 1), ("s3,3,c,SP,more", "long", 1)]
    assert all(r.path.endswith("part-0.csv") and r.time is not None for r in bad)
    raw = layers.read_layer(spark, jobs.table_path(base, jobs.RAW, S.SELLERS))
    assert sorted((r.seller_id, r.seller_city) for r in raw.collect()) == [("s1", 'a, "b"'), ("s4", "d,e")]
    # kept by default: padded and cut, nothing rejected
    assert jobs.raw_load(spark, S.SELLERS, f"{tmp_dir}/l", f"{tmp_dir}/lake2") == (4, 3)
    assert not layers.exists(spark, jobs.rejects_path(f"{tmp_dir}/lake2", S.SELLERS))
    with pytest.raises(ValueError, match="on_malformed"):
        jobs.raw_load(spark, S.SELLERS, f"{tmp_dir}/l", base, on_malformed="drop")


def test_reasons(spark):
    lines = {"a,b": "short", "a,b,c,d": "long", '"a,b",c': "short", '"a,""b",c,d,e': "long", 'a,"b': "open quote",
             "a,b,c": "malformed"}
    rows = spark.createDataFrame([(k,) for k in lines], f"{C.CORRUPT} string")
    rows = rows.withColumn(C.ARRIVAL, F.lit(None).cast(C.ARRIVAL_TYPE))
    assert {r.line: r.reason for r in C.reject_rows(rows, 3).collect()} == lines


def test_files_no_larger_than_a_split_are_read_without_a_shuffle(spark, tmp_dir):
    docs = table(spark, SF_SMALL, "documents")
    path = C.write_csv(docs.repartition(3), f"{tmp_dir}/csv")
    split = read_multiline(spark, path, docs.schema)
    whole = read_multiline(spark, path, docs.schema, whole_files=True)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan(split) and "Exchange" not in plan(whole)
    assert split.dtypes == whole.dtypes
    rows = lambda df: sorted(map(str, df.drop(C.ARRIVAL).collect()))
    assert rows(whole) == rows(split) and whole.count() == docs.count()
    # the order of arrival in a file is that of its records
    at = lambda df: [r[0] for r in df.orderBy(f"{C.ARRIVAL}.path", f"{C.ARRIVAL}.block",
                                              f"{C.ARRIVAL}.row").select("doc_id").collect()]
    assert at(whole) == at(split)
    plain = jobs.landing_rows(spark, S.REVIEWS, C.write_csv(standins.feed(spark, SF_SMALL, S.REVIEWS), f"{tmp_dir}/r"))
    assert "Exchange" not in plan(plain) and plain.columns == [*S.REVIEWS.columns, C.CORRUPT, C.ARRIVAL]


def test_large_files_and_files_with_carriage_returns_are_read_in_splits(spark, tmp_dir, small_splits):
    write_text(f"{tmp_dir}/l/part-0.csv", "a,b,c\n1,\"" + "text\n" * 30 + "\",z\n")
    write_text(f"{tmp_dir}/r/part-0.csv", 'a,b,c\r\n1,"x\r\ny",z\r\n')
    write_text(f"{tmp_dir}/n/part-0.csv", 'a,b,c\n1,"x\ny",z\n')
    assert [in_whole_files(spark, f"{tmp_dir}/{d}") for d in "lrn"] == [False, False, True]
    assert read_multiline(spark, f"{tmp_dir}/r", SCHEMA, whole_files=True).first().b == "x\r\ny"
