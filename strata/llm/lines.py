"""Line dedup by distinct-site spread: HyperLogLog sketches of sites per line hash.

A line that many sites carry is boilerplate. Each task builds a sketch of sites for
every line hash it sees and the sketches merge in the aggregation, so a line that a
third of all rows hold costs one small sketch for each task. Estimates well above or
below ``min_sites`` decide; lines near the threshold (within ``band``, many
standard errors) get an exact distinct count, so the result equals exact counting.

Boilerplate lines are removed from their documents, all of them. A document stays as
it is (``copied``) only where nothing of it would be left and its very text is seen in
another row too: then it is a copy of a spread text, for document dedup.

Lines are the parts between line feeds; lines of spaces only are never counted or
removed. Defined results: a null site counts as no site; a null or empty text has
no lines and is kept as it is; repeated rows add no sites; very long texts give one
row for each line; an empty table gives an empty result. Texts and lines are known
by 128-bit hashes, so no row number is needed and copies have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, key_columns, write_table
from strata.operators.joins import sized

SKETCH_BITS = 12             # 2^12 registers: standard error about 1.6 %
BROADCAST_BYTES = 4 << 20    # flagged lines are broadcast below this measured size


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def with_content(line: Column) -> Column:
    return F.trim(line) != ""


def line_rows(docs: DataFrame, text: str, *more: Column) -> DataFrame:
    """(l1, l2, ...): the hash of each line that is not blank."""
    rows = docs.select(*more, F.explode(F.filter(lines_of(F.col(text)), with_content)).alias("line"))
    l1, l2 = key_columns(F.col("line"))
    return rows.withColumn("l1", l1).withColumn("l2", l2).drop("line")


def spread_lines(docs: DataFrame, text: str, site: str, min_sites: int, band: float) -> DataFrame:
    """(l1, l2) of lines on at least ``min_sites`` distinct sites."""
    rows = line_rows(docs, text, F.col(site).cast("string").alias("site"))
    sketches = rows.where("site is not null").groupBy("l1", "l2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"))
    seen = write_table(sketches.where(F.col("sites") >= int(min_sites * (1 - band))), "spread")
    sure = seen.where(F.col("sites") > min_sites * (1 + band)).select("l1", "l2")
    near = sized(seen.where(F.col("sites") <= min_sites * (1 + band)).select("l1", "l2"),
                 limit=BROADCAST_BYTES).frame
    exact = (rows.where("site is not null").join(near, ["l1", "l2"], "left_semi")
             .groupBy("l1", "l2").agg(F.countDistinct("site").alias("sites"))
             .where(F.col("sites") >= min_sites).select("l1", "l2"))
    return write_table(sure.unionByName(exact), "boilerplate")


def remove_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source",
                 min_sites: int = 10, band: float = 0.25, into: str = "__lines") -> DataFrame:
    """The rows of ``docs`` with a struct column ``into``: kept (text), n_lines,
    n_flagged, copied and n_removed."""
    at1, at2, at_hits, at_rows = fresh(docs, "__k1", "__k2", "__hits", "__rows")
    own = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), F.col(f"`{site_col}`").alias("s"))
    flagged = sized(spread_lines(own, "t", "s", min_sites, band), limit=BROADCAST_BYTES).frame
    k1, k2 = key_columns(F.col("t"))
    places = own.select(k1.alias(at1), k2.alias(at2),
                        F.posexplode(lines_of(F.col("t"))).alias("pos", "line"))
    l1, l2 = key_columns(F.col("line"))
    hits = (places.where(with_content(F.col("line")))
            .select(at1, at2, "pos", l1.alias("l1"), l2.alias("l2"))
            .join(flagged, ["l1", "l2"], "left_semi")
            .groupBy(at1, at2).agg(F.collect_set("pos").alias(at_hits)))
    # the rows of a text are counted from its key alone, whatever its length
    rows = own.groupBy(k1.alias(at1), k2.alias(at2)).agg(F.count(F.lit(1)).alias(at_rows))
    hits = hits.join(rows, [at1, at2])
    # written first: a join of two plain tables can be split where a text has many copies
    hits = write_table(hits, "line-hits")
    t = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d1, d2 = key_columns(t)
    joined = docs.withColumn(at1, d1).withColumn(at2, d2).join(hits, [at1, at2], "left")
    lines = lines_of(t)
    at = lambda p: F.get(lines, p)
    content = F.size(F.filter(lines, with_content))
    # a set difference of places: linear in the lines, however many are flagged
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at_hits), at)
    found = F.coalesce(F.size(at_hits), F.lit(0))
    copied = F.coalesce((F.col(at_rows) > 1) & (F.size(at_hits) == content), F.lit(False))
    removes = F.col(at_hits).isNotNull() & ~copied
    return joined.withColumn(into, F.struct(
        F.when(removes, F.array_join(rest, "\n")).otherwise(t).alias("kept"),
        content.cast("long").alias("n_lines"),
        F.when(F.col(at_hits).isNull(), 0).otherwise(found).cast("long").alias("n_flagged"),
        copied.alias("copied"),
        F.when(removes, found).otherwise(0).cast("long").alias("n_removed"),
    )).drop(at1, at2, at_hits, at_rows)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               site_col: str = "source", **options) -> DataFrame:
    """doc_id, n_lines, n_flagged, copied, n_removed, kept_sha256 for every row."""
    rows = remove_lines(docs.select(*dict.fromkeys(f"`{c}`" for c in (id_col, text_col, site_col))), text_col,
                        site_col, **options)
    return rows.select(F.col(f"`{id_col}`"), "__lines.n_lines", "__lines.n_flagged", "__lines.copied",
                       "__lines.n_removed", F.sha2(F.encode("__lines.kept", "UTF-8"), 256).alias("kept_sha256"))


def dedup_stage(docs: DataFrame, text_col: str = "text", site_col: str = "source",
                length_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with its boilerplate lines removed: same rows, same columns.

    A text that lost no line stays as it is (null too); ``length_col``, where there is
    one, follows the text.
    """
    into, = fresh(docs, "__lines")
    rows = remove_lines(docs, text_col, site_col, into=into, **options)
    changed = F.col(into)["n_removed"] > 0
    kept = F.col(into)["kept"]
    columns = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name == text_col:
            c = F.when(changed, kept).otherwise(c)
        elif f.name == length_col:
            c = F.when(changed, F.length(kept)).otherwise(c).cast(f.dataType)
        columns.append(c.alias(f.name))
    return rows.select(*columns)


def sql(min_sites: int = 10) -> str:
    """The same result by exact counting, for DuckDB."""
    return f"""
WITH d AS (SELECT *, row_number() OVER () AS rn, coalesce("text", '') AS t,
                  count(*) OVER (PARTITION BY "text") AS n_rows FROM documents),
l AS (SELECT rn, source, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
spread AS (SELECT line FROM l WHERE trim(line) <> '' GROUP BY line
           HAVING count(DISTINCT source) >= {min_sites}),
m AS (SELECT rn, pos, line, trim(line) <> '' AS filled,
             line IN (SELECT line FROM spread) AS hit FROM l),
a AS (SELECT rn, count(*) FILTER (filled) AS n_lines, count(*) FILTER (hit) AS n_flagged,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS rest
      FROM m GROUP BY rn)
SELECT doc_id, n_lines, n_flagged, copied, CASE WHEN copied THEN 0 ELSE n_flagged END AS n_removed,
       sha256(CASE WHEN n_flagged > 0 AND NOT copied THEN rest ELSE t END) AS kept_sha256
FROM (SELECT *, n_flagged > 0 AND n_flagged = n_lines AND n_rows > 1 AS copied FROM d JOIN a USING (rn))"""
