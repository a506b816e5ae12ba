"""Rendering rows as text, splitting, nested lists."""

from pyspark.sql import functions as F

from strata.functions import text


def test_render_quoted_and_bare(spark):
    df = spark.createDataFrame([(1, 'a, "b"', None, " x ")], "k int, v string, n string, w string")
    r = df.select(text.render_csv("k", "v", "n", "w").alias("q"),
                  text.render_csv("k", "v", quote_all=True).alias("all"),
                  text.render_bare("k", "v", "n").alias("bare")).collect()[0]
    assert r.q == '1,"a, ""b""",, x '
    assert r["all"] == '"1","a, ""b"""'
    assert r.bare == '1,a, "b",None'


def test_render_then_parse_round_trip(spark):
    df = spark.createDataFrame([(1, 'multi\nline, "q"'), (2, "")], "k int, v string")
    back = (df.select(text.render_csv("k", "v").alias("line"))
            .select(text.parse_csv("line", "k int, v string").alias("r")).select("r.*"))
    got = sorted((r.k, r.v) for r in back.collect())
    assert got[0] == (1, 'multi\nline, "q"')


def test_split_key(spark):
    df = spark.createDataFrame([("k,a,b",), ("k",), ("k,,",)], ["line"])
    key, rest = text.split_key("line")
    got = [(r.key, r.rest) for r in df.select(key.alias("key"), rest.alias("rest")).collect()]
    assert got == [("k", ["a", "b"]), ("k", []), ("k", ["", ""])]


def test_expand_lists_and_render_joins(spark):
    # fixture: (k, [[a, b], [c]]) -> rows (k, [a, b]), (k, [c]); rendered 'k,a,b' and 'k,c'
    df = spark.createDataFrame([("k", [["a", "b"], ["c"]]), ("e", []), ("n", None)],
                               "key string, joins array<array<string>>")
    flat = text.expand_lists(df, "key", "joins")
    assert [(r.key, r.joins) for r in flat.collect()] == [("k", ["a", "b"]), ("k", ["c"])]
    lines = [r.line for r in flat.select(text.render_joins("key", "joins").alias("line")).collect()]
    assert lines == ["k,a,b", "k,c"]


def test_expressions_stay_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("v"))
    q = df.select(text.render_bare("v", "v").alias("b"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
