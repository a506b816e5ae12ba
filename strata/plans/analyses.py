"""Analyses over the driver's tables, which the stand-in feeds are made of.

Money is summed as DECIMAL(18,2) (exact, so the result does not depend on the
order rows are added in) and returned as double. The build side of each join is
projected to the columns it needs and measured (``operators.joins.sized``): it is
broadcast only when proven under the threshold, otherwise the join is a
sort-merge join on the key (AQE splits skewed partitions). Every aggregate is
partial-then-final, so a hot group key costs one partial row per map task in
the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.joins import sized
from strata.plans.standins import table


def _money(c):
    return F.col(c).cast("decimal(18,2)")


def sales_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per part type and month, with the previous month's revenue."""
    li = table(spark, sf_dir, "lineitem")
    o = sized(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).frame
    p = sized(table(spark, sf_dir, "part").select("p_partkey", "p_type")).frame
    lines = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(p, li.l_partkey == p.p_partkey)
             .select("p_type", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
                     "l_orderkey",
                     (_money("l_extendedprice") * (F.lit(1) - F.col("l_discount")
                                                    .cast("decimal(4,2)"))).alias("rev")))
    monthly = lines.groupBy("p_type", "month").agg(
        F.sum("rev").cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("l_orderkey").alias("n_orders"))
    w = Window.partitionBy("p_type").orderBy("month")
    return monthly.withColumn("prev_revenue", F.lag("revenue").over(w))


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation, customers who ordered, orders, repeat buyers and spend."""
    c = sized(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")).frame
    o = table(spark, sf_dir, "orders")
    n = sized(table(spark, sf_dir, "nation").select("n_nationkey", "n_name")).frame
    per_customer = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(_money("o_totalprice")).alias("spend"))
    return (per_customer.join(c, per_customer.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .groupBy("n_name").agg(
                F.count(F.lit(1)).alias("n_customers"),
                F.sum("n_orders").alias("n_orders"),
                F.sum(F.when(F.col("n_orders") > 1, 1).otherwise(0)).cast("bigint")
                .alias("repeat_customers"),
                F.sum("spend").cast("double").alias("spend")))


def review_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity labels per language and source."""
    d = table(spark, sf_dir, "documents")
    lb = sized(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")).frame
    j = d.join(lb, "doc_id", "left")
    return j.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count("quality").alias("n_labeled"),
        F.sum("quality").cast("bigint").alias("n_quality"),
        F.sum("toxic").cast("bigint").alias("n_toxic"),
        (F.sum("quality").cast("double") / F.count("quality")).alias("quality_rate"))


def delivery_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipment per order priority, and freight (tax) paid."""
    li = table(spark, sf_dir, "lineitem")
    o = sized(table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_orderdate", "o_orderpriority")).frame
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "o_orderpriority",
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("bigint")
        .alias("days"),
        (_money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).alias("freight"))
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("days").cast("bigint").alias("total_days"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
        (F.sum("days").cast("double") / F.count(F.lit(1))).alias("avg_days"),
        F.sum(F.when(F.col("days") > 60, 1).otherwise(0)).cast("bigint").alias("late_lines"),
        F.sum("freight").cast("double").alias("freight"))
