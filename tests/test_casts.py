"""Strict and coercing casts, fills, null tokens, dates, typed projection."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import specs as S
from strata.functions import casts


def types_of(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr(F.col("v")).alias("o")).collect()[0].o


def test_long_strict(spark):
    assert one(spark, "01151", lambda c: casts.cast_text(c, "long")) == 1151
    assert one(spark, " 12 ", lambda c: casts.cast_text(c, "long")) == 12
    assert one(spark, None, lambda c: casts.cast_text(c, "long")) is None
    for bad in ("None", "40.0", "x"):
        with pytest.raises(Exception, match="cannot convert"):
            one(spark, bad, lambda c: casts.cast_text(c, "long"))


def test_long_coerce_mode(spark):
    assert one(spark, "None", lambda c: casts.cast_text(c, "long", casts.COERCE)) is None
    assert one(spark, "7", lambda c: casts.cast_text(c, "long", casts.COERCE)) == 7


def test_double_strict(spark):
    assert one(spark, "-23.5", lambda c: casts.cast_text(c, "double")) == -23.5
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, "abc", lambda c: casts.cast_text(c, "double"))


def test_strict_raises_with_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot convert"):
            one(spark, "bad", lambda c: casts.cast_text(c, "long"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_coerce_score(spark):
    # fixture: coerced score 'abc', '4.7', '' -> 0, 4, 0; negatives truncate toward zero
    got = [one(spark, v, casts.coerce_long) for v in ("abc", "4.7", "", None, "-2.9", "5", "nan")]
    assert got == [0, 4, 0, 0, -2, 5, 0]


def test_null_tokens(spark):
    assert [one(spark, v, casts.null_token) for v in ("", "None", None, "x")] == \
        [None, None, None, "x"]


@pytest.mark.parametrize("text,expected", [
    ("2017-09-19 09:45:35", dt.date(2017, 9, 19)),      # time of day dropped
    ("2017-9-1 1:2:3", dt.date(2017, 9, 1)),            # unpadded fields
    ("", None), ("None", None), (None, None),
])
def test_dates_both_policies(spark, text, expected):
    assert one(spark, text, lambda c: casts.parse_date(c, S.STRICT)) == expected
    assert one(spark, text, lambda c: casts.parse_date(c, S.TOLERANT)) == expected


@pytest.mark.parametrize("text", [" arrived a day late.", "17-9-1 1:2:3", "2017-02-30 00:00:00",
                                  "2017-09-19"])
def test_bad_dates(spark, text):
    assert one(spark, text, lambda c: casts.parse_date(c, S.TOLERANT)) is None
    with pytest.raises(Exception, match="cannot convert"):
        one(spark, text, lambda c: casts.parse_date(c, S.STRICT))


def test_fill_zero_by_type(spark):
    df = spark.createDataFrame([("k", None, None, None)], "k string, s string, i int, d double")
    r = casts.fill_zero(df, exclude=["k"]).collect()[0]
    assert (r.s, r.i, r.d) == ("0", 0, 0.0)
    r = casts.fill_zero(spark.createDataFrame([(None, 1)], "k string, i int"), exclude=["k"]).collect()[0]
    assert r.k is None


def test_blank_products_row(spark):
    # fixture: p1,,,,,,,, -> columns 3-9 zero, category null
    df = spark.createDataFrame([("p1",) + (None,) * 8], S.PRODUCTS.raw_schema)
    r = casts.trusted_columns(df, S.PRODUCTS).collect()[0]
    assert r.product_category_name is None
    assert [r[c] for c in S.PRODUCTS.columns[2:]] == [0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0]
    assert isinstance(r.product_photos_qty, int)


def test_products_double_text_in_integer_column(spark):
    row = ("p1", "cat", "12", "100", "40.0", "1", "2", "3", "4")
    df = spark.createDataFrame([row], S.PRODUCTS.raw_schema)
    with pytest.raises(Exception, match="cannot convert"):
        casts.trusted_columns(df, S.PRODUCTS).collect()
    r = casts.trusted_columns(df, S.PRODUCTS, casts.COERCE).collect()[0]
    assert r.product_photos_qty is None


def test_zip_leading_zero_and_bad_zip(spark):
    df = spark.createDataFrame([("c1", "u1", "01151", "sao paulo", "SP")], S.CUSTOMERS.raw_schema)
    assert casts.trusted_columns(df, S.CUSTOMERS).collect()[0].customer_zip_code_prefix == 1151
    bad = spark.createDataFrame([("c2", "u2", "None", "x", "SP")], S.CUSTOMERS.raw_schema)
    with pytest.raises(Exception, match="cannot convert"):
        casts.trusted_columns(bad, S.CUSTOMERS).collect()
    assert casts.trusted_columns(bad, S.CUSTOMERS, casts.COERCE).collect()[0] \
        .customer_zip_code_prefix is None


def test_typed_projection_orders(spark):
    row = ("o1", "c1", "shipped", "2017-09-13 08:59:02", "2017-09-13 09:45:35", None, "None",
           "2017-09-29 00:00:00")
    df = spark.createDataFrame([row], S.ORDERS.raw_schema)
    out = casts.typed_projection(casts.trusted_columns(df, S.ORDERS), S.ORDERS)
    assert types_of(out.schema) == types_of(S.ORDERS.refined_schema)
    r = out.collect()[0]
    assert r.order_purchase_timestamp == dt.date(2017, 9, 13)
    assert r.order_delivered_carrier_date is None and r.order_delivered_customer_date is None
    bad = spark.createDataFrame([row[:3] + (" arrived a day late.",) + row[4:]],
                                S.ORDERS.raw_schema)
    with pytest.raises(Exception, match="cannot convert"):
        casts.typed_projection(bad, S.ORDERS).collect()


def test_typed_projection_reviews_tolerant(spark):
    row = ("r1", "o1", "abc", "t", "m", " arrived a day late.", "2018-01-18 21:46:59")
    df = spark.createDataFrame([row], S.REVIEWS.raw_schema)
    out = casts.typed_projection(casts.trusted_columns(df, S.REVIEWS), S.REVIEWS)
    assert types_of(out.schema) == types_of(S.REVIEWS.refined_schema)
    r = out.collect()[0]
    assert (r.review_score, r.review_creation_date, r.review_answer_timestamp) == \
        (0, None, dt.date(2018, 1, 18))


def test_refined_schemas_cover_all_columns():
    for spec in S.ALL_SPECS:
        assert list(spec.refined) == list(spec.columns)
        assert set(spec.trusted) <= set(spec.columns)
        assert set(spec.dates) <= set(spec.columns)


@pytest.mark.parametrize("text,value", [("4d", None), ("4f", None), ("inf", float("inf")), (" 7 ", 7.0),
                                        ("1e3", 1000.0), ("-.5", -0.5), ("4.", 4.0), ("", None), (".", None),
                                        ("0x1", None), ("1_0", None), ("-Infinity", float("-inf"))])
def test_number_grammar(spark, text, value):
    assert one(spark, text, casts.number) == value
    if value is None:
        with pytest.raises(Exception, match="cannot convert"):
            one(spark, text, lambda c: casts.cast_text(c, "double"))
        assert one(spark, text, casts.coerce_long) == 0
