"""Stand-in feeds: the eight landing tables derived from the driver's tables.

Each builder turns a whole driver table into the all-text rows of one feed
(zero-padded zip prefixes, timestamps as 'yyyy-MM-dd HH:mm:ss' text, money as
two-decimal text), and writes dirty values (blanks, 'None', unparseable text)
by deterministic rules on the row's key. Nothing is filtered: a feed has one row
per input row, so its size grows with the input.

Stand-in map: customers <- customer, geolocation <- customer (25 zip prefixes,
so a few keys hold many rows), items <- lineitem, orders <- orders,
payments <- events, products <- part, reviews <- documents, sellers <- supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import specs as S

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)").cast("string")


def _ts(c) -> Column:
    return F.date_format(c, TS_TEXT)


def _every(key: str, n: int) -> Column:
    return (F.col(key) % F.lit(n)) == 0


def _feed(rows: DataFrame, arrange, *columns: Column) -> DataFrame:
    """A table's rows as a feed's. ``arrange`` deals the table's own rows, which are shorter than their texts;
    it is given the feed's columns over them by name."""
    made = rows.select(*columns)
    return arrange(rows, dict(zip(made.columns, columns))).select(*columns) if arrange else made


def customers(spark, sf_dir, arrange=None) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return _feed(c, arrange,
        _s("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(_s("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.when(~_every("c_custkey", 13), F.concat(F.lit("N"), _s("c_nationkey")))
        .alias("customer_state"))


def geolocation(spark, sf_dir, arrange=None) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return _feed(c, arrange,
        F.lpad(_s("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
        _money("c_acctbal").alias("geolocation_lat"),
        F.when(~_every("c_custkey", 17),
               F.concat(F.lit("-"), _s(F.col("c_custkey") % 90))).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.concat(F.lit("N"), _s("c_nationkey")).alias("geolocation_state"))


def items(spark, sf_dir, arrange=None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return _feed(li, arrange,
        _s("l_orderkey").alias("order_id"),
        _s("l_linenumber").alias("order_item_id"),
        _s("l_partkey").alias("product_id"),
        _s("l_suppkey").alias("seller_id"),
        F.when(_every("l_partkey", 50), F.lit("")).otherwise(_ts(F.col("l_shipdate")))
        .alias("shipping_limit_date"),
        _money("l_extendedprice").alias("price"),
        _money("l_tax").alias("freight_value"))


def orders(spark, sf_dir, arrange=None) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return _feed(o, arrange,
        _s("o_orderkey").alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        _ts(d).alias("order_purchase_timestamp"),
        F.when(_every("o_orderkey", 5), F.lit(""))
        .otherwise(_ts(d + F.expr("INTERVAL 1 DAY"))).alias("order_approved_at"),
        F.when(_every("o_orderkey", 7), F.lit("None"))
        .otherwise(_ts(d + F.expr("INTERVAL 3 DAYS"))).alias("order_delivered_carrier_date"),
        F.when(~_every("o_orderkey", 11), _ts(d + F.expr("INTERVAL 9 DAYS 5 HOURS")))
        .alias("order_delivered_customer_date"),
        _ts(d + F.expr("INTERVAL 30 DAYS")).alias("order_estimated_delivery_date"))


def payments(spark, sf_dir, arrange=None) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return _feed(e, arrange,
        _s("user_id").alias("order_id"),
        _s("event_id").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        _s(F.col("event_id") % 12 + 1).alias("payment_installments"),
        _money("value").alias("payment_value"))


def products(spark, sf_dir, arrange=None) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return _feed(p, arrange,
        _s("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.when(_every("p_partkey", 9), F.lit(""))
        .when(_every("p_partkey", 10), F.lit("n/a"))
        .otherwise(_s(F.length("p_name"))).alias("product_name_lenght"),
        _s(size * 10).alias("product_description_lenght"),
        F.when(_every("p_partkey", 8), F.lit("")).otherwise(_s(size % 6))
        .alias("product_photos_qty"),
        _money("p_retailprice").alias("product_weight_g"),
        _s(size).alias("product_length_cm"),
        F.when(_every("p_partkey", 12), F.lit("")).otherwise(_s(size + 1))
        .alias("product_height_cm"),
        _s(size + 2).alias("product_width_cm"))


def _doc_time(hours_after: Column) -> Column:
    return F.expr("TIMESTAMP_NTZ '2018-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), hours_after.cast("int"), F.lit(0), F.lit(0))


def reviews(spark, sf_dir, arrange=None) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    created = _doc_time(F.col("doc_id"))
    answered = _doc_time(F.col("doc_id") + 31)
    return _feed(d, arrange,
        _s("doc_id").alias("review_id"),
        F.col("source").alias("order_id"),
        F.when(_every("doc_id", 6), F.lit("abc"))
        .when(_every("doc_id", 9), F.lit("4.7"))
        .otherwise(_s(F.col("n_chars") % 5 + 1)).alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.when(_every("doc_id", 10), F.lit("None"))
        .when(_every("doc_id", 15), F.col("source"))
        .otherwise(_ts(created)).alias("review_creation_date"),
        F.when(_every("doc_id", 7), F.lit("None"))
        .otherwise(_ts(answered)).alias("review_answer_timestamp"))


def sellers(spark, sf_dir, arrange=None) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return _feed(s, arrange,
        _s("s_suppkey").alias("seller_id"),
        F.lpad(_s("s_nationkey"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.concat(F.lit("N"), _s("s_nationkey")).alias("seller_state"))


BUILDERS = {
    "customers": customers, "geolocation": geolocation, "items": items,
    "orders": orders, "payments": payments, "products": products,
    "reviews": reviews, "sellers": sellers,
}


def feed(spark: SparkSession, sf_dir: str, spec: S.TableSpec, arrange=None) -> DataFrame:
    return BUILDERS[spec.name](spark, sf_dir, arrange).select(*spec.columns)
