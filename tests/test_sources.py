"""CSV scans, ragged rows, record parsing, layer versions, existence probe."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import write_text
from strata import specs as S
from strata.functions import text
from strata.sinks.tables import write_version
from strata.sources import layers
from strata.sources.csv import CORRUPT, read_csv

REVIEWS_HEADER = ("review_id,order_id,review_score,review_comment_title,"
                  "review_comment_message,review_creation_date,review_answer_timestamp\n")


def test_header_skipped_and_quotes(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/r.csv", REVIEWS_HEADER +
                   'r1,o1,5,"ok, good","said ""yes""",2018-01-18 00:00:00,2018-01-18 21:46:59\n')
    rows = read_csv(spark, p, S.REVIEWS).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.review_comment_title == "ok, good"
    assert r.review_comment_message == 'said "yes"'
    assert r.review_answer_timestamp == "2018-01-18 21:46:59"


def test_newline_in_quotes_multiline_vs_lines(spark, tmp_dir):
    body = REVIEWS_HEADER + 'r2,o2,4,,"line one\nline two",2018-01-18 00:00:00,2018-01-19 00:00:00\n'
    p = write_text(f"{tmp_dir}/r.csv", body)
    multi = read_csv(spark, p, S.REVIEWS, multiline=True).collect()
    assert len(multi) == 1 and multi[0].review_comment_message == "line one\nline two"
    lines = read_csv(spark, p, S.REVIEWS, multiline=False).collect()
    assert len(lines) == 2


def test_short_and_long_rows_flagged(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/r.csv", REVIEWS_HEADER + "r3,o3\n")
    df = read_csv(spark, p, S.REVIEWS, corrupt_column=CORRUPT).cache()
    r = df.collect()[0]
    assert (r.review_id, r.order_id) == ("r3", "o3")
    assert all(getattr(r, c) is None for c in S.REVIEWS.columns[2:])
    assert r[CORRUPT] == "r3,o3"

    p2 = write_text(f"{tmp_dir}/s.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                    "s1,13023,campinas,SP,extra\n")
    df2 = read_csv(spark, p2, S.SELLERS, corrupt_column=CORRUPT).cache()
    r2 = df2.collect()[0]
    assert (r2.seller_id, r2.seller_zip_code_prefix, r2.seller_city, r2.seller_state) == \
        ("s1", "13023", "campinas", "SP")
    assert r2[CORRUPT] is not None


def test_empty_field_is_null(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/o.csv", ",".join(S.ORDERS.columns) + "\n" +
                   "o1,c1,shipped,2017-09-13 08:59:02,2017-09-13 09:45:35,,,2017-09-29 00:00:00\n")
    r = read_csv(spark, p, S.ORDERS).collect()[0]
    assert r.order_delivered_carrier_date is None and r.order_delivered_customer_date is None


def test_parse_csv_column(spark):
    df = spark.createDataFrame([('c1,u1,01151,"sao paulo, centro",SP',)], ["line"])
    ddl = ", ".join(f"{c} string" for c in S.CUSTOMERS.columns)
    r = df.select(text.parse_csv("line", ddl).alias("r")).select("r.*").collect()[0]
    assert r.customer_zip_code_prefix == "01151"
    assert r.customer_city == "sao paulo, centro"


def test_versions_newest_complete(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert layers.read_layer(spark, path) is None
    assert not layers.exists(spark, path)
    v1, n1 = write_version(spark.range(3), path)
    v2, n2 = write_version(spark.range(5), path)
    assert (v1, n1, v2, n2) == (1, 3, 2, 5)
    # an unfinished version (no _SUCCESS) is ignored by readers
    write_text(f"{layers.version_path(path, 3)}/part-0.parquet", "garbage")
    assert layers.latest_version(spark, path) == 2
    assert layers.read_layer(spark, path).count() == 5
    assert layers.read_layer(spark, path, below=2).count() == 3
    # the next writer skips the unfinished number
    v4, _ = write_version(spark.range(1), path)
    assert v4 == 4


def test_parquet_scan_prunes_columns(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(10).select(F.col("id"), (F.col("id") * 2).alias("x"), F.lit("a").alias("y"))
    write_version(df, path)
    q = layers.read_layer(spark, path).filter(F.col("id") > 3).select("x")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan
    assert "ReadSchema: struct<id:bigint,x:bigint>" in plan
    assert sorted(r.x for r in q.collect()) == [8, 10, 12, 14, 16, 18]


def test_raw_schema_all_text():
    for spec in S.ALL_SPECS:
        assert all(isinstance(f.dataType, T.StringType) for f in spec.raw_schema.fields)
        assert spec.key[0] == spec.columns[0]


def test_prune_versions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for n in range(4):
        write_version(spark.range(n + 1), path)
    assert layers.prune_versions(spark, path, keep=2) == [1, 2]
    assert layers.versions(spark, path) == [3, 4]
    assert layers.read_layer(spark, path).count() == 4
    assert layers.prune_versions(spark, path, keep=2) == []


def test_dropmalformed_and_failfast(spark, tmp_dir):
    import pytest
    from strata.sources.csv import DROPMALFORMED, FAILFAST
    p = write_text(f"{tmp_dir}/s.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                   "s1,13023,campinas,SP\ns2,1\ns3,2,x,y,extra\n")
    assert [r.seller_id for r in read_csv(spark, p, S.SELLERS, mode=DROPMALFORMED).collect()] \
        == ["s1"]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, p, S.SELLERS, mode=FAILFAST).collect()


def test_documents_csv_round_trip_is_lossless(spark, tmp_dir):
    # SURVEY §5.4: commas, quotes and newlines in whole texts survive write + multiline read
    from strata.sources.csv import write_csv
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    back = read_csv(spark, write_csv(docs, f"{tmp_dir}/docs"), docs.schema, multiline=True)
    assert back.count() == docs.count()
    assert docs.exceptAll(back).count() == 0 and back.exceptAll(docs).count() == 0
