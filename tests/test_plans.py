"""Plan shapes that matter at scale, checked on the driver's tables."""

from pyspark.sql import functions as F

from strata.plans import analyses
from strata.plans.standins import table

SF = "/root/testdata/sf0.01"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_measured_bound_overrides_file_size_estimate(spark):
    # orders is ~260 KB on disk at sf0.01, so Catalyst alone would broadcast it under a
    # 1 MB threshold; its measured in-memory bound is ~2 MB, so the join is sort-merge
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1024 * 1024))
    try:
        plan = _plan(analyses.delivery_times(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_small_dimension_is_broadcast(spark):
    plan = _plan(analyses.customer_profile(spark, SF))
    assert "BroadcastHashJoin" in plan            # nation and customer fit the default bound


def test_scans_read_only_needed_columns(spark):
    li = table(spark, SF, "lineitem").filter(F.col("l_quantity") > 40).select("l_orderkey")
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,40.0)" in plan


def test_partial_aggregation_before_every_exchange(spark):
    plan = _plan(analyses.review_scores(spark, SF))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(lang")
