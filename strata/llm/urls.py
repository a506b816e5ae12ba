"""URL filter: allow and block rules, then gradient-boosted trees on lexical features.

A rule is a host and a path prefix; it fits its host and all subdomains, and the
longest fitting rule decides. URLs without a rule are judged by boosted trees over
lengths, depth, digit ratios, entropy, parameter counts and statistics of the
host's suffix. The trees are trained on labelled URLs: by default those that a rule
decides, else a table of the caller. ``max_train`` bounds the training rows (drawn
by a hash of the URL); suffix statistics cover all rows.

Only DataFrame functions and Spark ML's DataFrame classes are used. Suffix counts are
partial sums before the shuffle; the suffix table is broadcast below a measured size
and joined by a join that Spark can split above it.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged by the trees on its text; without labels of both kinds every URL
that no rule decides is allowed; repeated rows are judged each; very long URLs are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import smallest, write_table
from strata.operators.joins import sized

BROADCAST_BYTES = 8 << 20
FORM = "(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
LEXICAL = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "host_digit_ratio",
           "entropy", "params", "hyphens", "labels", "last_length")
SUFFIX = ("suffix_pages", "suffix_share", "top_pages", "top_share")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), FORM, 1)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), FORM, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):      # the longest is asked first
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits."""
    n = F.length(text)
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.coalesce(F.aggregate(letters, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c))),
                      F.lit(0.0))


def suffixes(host: Column) -> tuple[Column, Column]:
    """The host's last two labels and its last label."""
    return F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    last = F.substring_index(path, "/", -1)
    ratio = lambda text: count_of(text, "[0-9]") / F.greatest(F.length(text), F.lit(1))
    return {"url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
            "depth": count_of(path, "/"), "digit_ratio": ratio(url), "host_digit_ratio": ratio(host),
            "entropy": entropy(url), "params": count_of(url, "="), "hyphens": count_of(url, "-"),
            "labels": count_of(host, "\\."), "last_length": F.length(last)}


def featured(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str, url_col: str) -> DataFrame:
    """(id, url, host, path, rule, decision, suffix, top and lexical features)."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), host_of(url).alias("host"),
                        path_of(url).alias("path"))
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    suffix, top = suffixes(F.col("host"))
    values = lexical(F.col("url"), F.col("host"), F.col("path"))
    return rows.select("*", rule.alias("rule"), decision.alias("decision"), suffix.alias("suffix"),
                       top.alias("top"), *[v.cast("double").alias(k) for k, v in values.items()])


def with_suffix_statistics(rows: DataFrame) -> DataFrame:
    """Pages of the host's suffix and of its last label (logarithm), and the share of blocked
    ones among those labelled but the page itself (drawn towards one half where there are few):
    a page's own label is no feature of it."""
    out = rows
    own, known = F.coalesce("label", F.lit(0.0)), F.when(F.col("label").isNull(), 0).otherwise(1)
    for key in ("suffix", "top"):
        stats = rows.groupBy(key).agg(
            F.log1p(F.count(F.lit(1))).alias(f"{key}_pages"),
            F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"), F.count("label").alias("labelled"))
        share = (F.col("blocked") - own + 5) / (F.col("labelled") - known + 10)
        out = (out.join(sized(stats, materialize=True, limit=BROADCAST_BYTES).frame, key)
               .withColumn(f"{key}_share", share).drop("blocked", "labelled"))
    return out


def train(rows: DataFrame, max_train: int, trees: int, depth: int) -> GBTClassificationModel | None:
    """Boosted trees on a bounded draw of the labelled rows; None without both labels."""
    drawn = smallest(rows.where("label is not null"), ["url"], max_train)
    assembler = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features")
    sample = write_table(assembler.transform(drawn).select("features", "label"), "url-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1, cacheNodeIds=False).fit(sample)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", label_col: str = "label",
          max_train: int = 20_000, trees: int = 10, depth: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of blocking, by the trees) for every row.

    ``labelled`` (url, label: 1 block, 0 allow) replaces the labels that rules give.
    """
    rows = featured(pages, rules, id_col, url_col)
    if labelled is None:
        rows = rows.withColumn("label", F.when(F.col("decision") == "block", 1.0)
                               .when(F.col("decision") == "allow", 0.0))
    else:
        known = (labelled.select(F.col(f"`{url_col}`").alias("url"), F.col(f"`{label_col}`").cast("double").alias("label"))
                 .groupBy("url").agg(F.max("label").alias("label")))
        rows = rows.join(known, "url", "left")
    rows = write_table(with_suffix_statistics(rows), "url-features")
    model = train(rows, max_train, trees, depth)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        wide = VectorAssembler(inputCols=[*LEXICAL, *SUFFIX], outputCol="features").transform(rows)
        scored = model.transform(wide).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce(F.col("decision"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
