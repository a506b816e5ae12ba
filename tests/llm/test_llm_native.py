"""The operators made of DataFrame expressions: URL rules, sharding, line dedup, templates."""

import hashlib
import math
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strata.llm import lines, sharding, templates, urls

import cases

SMALL = "/root/testdata/sf0.001"


def no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# sharding

def test_key_law(spark):
    docs = cases.documents(spark)
    frame = sharding.assign(docs)
    assert no_python(frame)
    out = frame.collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()))
                  for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sharding.assign(cases.empty(spark)).collect() == []


def test_rendezvous_scores(spark):
    def plain(key, weights):
        scores = []
        for s, w in enumerate(weights):
            seed = xxh64_intdigest(s.to_bytes(4, "little", signed=True), 42)
            h = xxh64_intdigest(key.encode(), seed)
            scores.append((-math.log(((h >> 11) + 0.5) / 2**53) / w, s))
        return min(scores)[1]

    weights = [1.0, 2.0, 0.5, 4.0]
    got = (spark.range(2000).withColumn("k", F.col("id").cast("string"))
           .select("k", sharding.choose(F.col("k"), weights).alias("s")).collect())
    assert all(r.s == plain(r.k, weights) for r in got)
    share = [sum(r.s == i for r in got) / 2000 for i in range(4)]
    assert all(abs(a - w / 7.5) < 0.04 for a, w in zip(share, weights))


def test_growth_moves_few_rows(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.assign(docs).collect()
    moved = sum(r.grown_shard == 16 for r in out)
    assert 150 < moved < 330            # 4000 / 17 = 235
    with pytest.raises(ValueError):
        sharding.choose(F.lit("a"), [0.0])


# URL filter

def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, path


def plain_rule(host, path):
    best = None
    for rule, verdict in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    return best or (None, None)


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/en/1", "https://a.example.org/en/12?x=1",
        "https://example.org/es/", "https://example.org/ES/", "https://notexample.org/es/1", "http://org",
        "http://org/", "http://x.com/fr/9#a", "http://x.com/de/9", "http://x.com?de/", "http://x.com/en/7",
        "ftp://a.b.net/c/d?e=f://g", "http://É.com/de/", "http://x.net/" + "9" * 5000, "://h.com/de/x",
        "http://x.com\n/de/", "http://a.com/de/1://b.org/"]


def test_urls_and_rules(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS + URLS[4:9])] + [(None, "http://n.net/", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, label int")
    frame = urls.judge(pages)
    assert no_python(frame)
    out = frame.collect()
    assert len(out) == len(rows)
    by_id = {r.page_id: r for r in out}
    for i, u, *_ in rows:
        r = by_id[i]
        host, path = plain_url(u)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert urls.judge(pages.limit(0)).collect() == []


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("aaaa",), ("abcd",)], "u string").select(
        urls.entropy(F.col("u")).alias("e")).collect()
    assert [round(r.e, 9) for r in got] == [1.0, 0.0, 0.0, 2.0]


def test_trees_learn_labelled_urls(spark):
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        path = f"/{'x' * 5}/{i * 7919}?a={i}&b={i}&c={i}" if bad else f"/news/story-{'abcdefgh'[i % 8]}"
        rows.append((i, f"http://h{i % 20}.net{path}", float(bad)))
    frame = spark.createDataFrame(rows, "page_id long, url string, label double")
    seen = frame.where("page_id % 5 <> 0").select("url", "label")
    out = urls.judge(frame.select("page_id", "url"), rules=(), labelled=seen).join(frame, "page_id").collect()
    held = [r for r in out if r.page_id % 5 == 0]
    assert sum((r.verdict == "block") == bool(r.label) for r in held) / len(held) > 0.95


def test_a_page_is_no_evidence_for_itself(spark):
    rows = [(f"http://h{i}.a{i % 3}.net/x", f"a{i % 3}.net", "net", float(i % 2) if i % 4 else None) for i in range(40)]
    frame = spark.createDataFrame(rows, "url string, suffix string, top string, label double")
    got = {r.url: r for r in urls.with_suffix_statistics(frame).collect()}
    for url, suffix, _, label in rows:
        for key, group in (("suffix", [r for r in rows if r[1] == suffix]), ("top", rows)):
            others = [r[3] for r in group if r[3] is not None and r[0] != url]
            assert got[url][f"{key}_share"] == pytest.approx((sum(others) + 5) / (len(others) + 10))


# line dedup

def duck(sql, docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return sorted(con.sql(sql).fetchall(), key=str)


def test_line_dedup_equals_sql(spark):
    docs = cases.documents(spark, sites=5)
    for sites in (2, 3, 4):
        frame = lines.line_dedup(docs, min_sites=sites)
        got = sorted((tuple(r) for r in frame.select(
            "doc_id", "n_lines", "n_flagged", "copied", "n_removed", "kept_sha256").collect()), key=str)
        want = [(None if isinstance(r[0], float) and math.isnan(r[0]) else None if r[0] is None else int(r[0]), *r[1:])
                for r in duck(lines.sql(sites), docs)]
        assert got == sorted(want, key=str)
    assert lines.line_dedup(cases.empty(spark)).collect() == []


def test_spread_is_exact_around_the_threshold(spark):
    rows = [(f"s{s}", f"line {n}") for n in range(60) for s in range(n) for _ in range(2)]
    docs = spark.createDataFrame(rows, "source string, text string")
    flagged = lines.spread_lines(docs, "text", "source", 30, 0.25).count()
    assert flagged == 30                 # lines 30 to 59


def test_line_stage_keeps_rows_and_columns(spark):
    docs = cases.documents(spark)
    out = lines.dedup_stage(docs, min_sites=2)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert out.count() == docs.count()
    assert None in [r.text for r in out.collect()]
    # every spread line goes; a text of spread lines only stays where another row has it, too
    rows = [(i, f"own words of document {i} that nobody else has\n\nshared line\nend {i}", f"s{i % 3}", 0)
            for i in range(6)] + [(i, "shared line\nshared line", f"s{i}", 23) for i in (7, 8)] + [(9, "shared line", "s0", 11)]
    own = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: r for r in lines.dedup_stage(own, min_sites=3).collect()}
    for i in range(6):
        text = f"own words of document {i} that nobody else has\n\nend {i}"
        assert (got[i].text, got[i].n_chars) == (text, len(text))
    assert all((got[i].text, got[i].n_chars) == ("shared line\nshared line", 23) for i in (7, 8))
    assert (got[9].text, got[9].n_chars) == ("", 0)


def test_every_spread_line_goes_unless_a_copy_would_vanish(spark):
    spread = "a line that all the sites of this small corpus carry"
    rows = [(i, f"own {i}\n{spread}\n{spread}", f"s{i}") for i in range(4)]      # mostly boilerplate
    rows += [(4, spread, "s0"), (5, "told on\nevery site", "s1"), (6, "told on\nevery site", "s2"),
             (7, "told on\nevery site", "s3"), (8, "told on\nevery site\nend", "s3"), (9, None, "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.dedup_stage(docs, min_sites=3).collect()}
    copy = "told on\nevery site"
    assert got == {**{i: f"own {i}" for i in range(4)}, 4: "", 5: copy, 6: copy, 7: copy, 8: "end", 9: None}


# templates

ITEMS = [(1, "Anna buys 12 apples and 3 kg of sugar in the old market, then sells 5 apples to Tom for 2 dollars."),
         (2, "What is the name of the river that flows through the old capital of the northern kingdom"),
         (3, "two words"), (4, None), (5, "1 2 3 4 5 6 7 8 9"), (6, "short but whole item here")]


def leaks(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)],
                                 "doc_id long, text string, k1 string, row int").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = templates.decontaminate(docs, items, **options)
    assert no_python(frame)
    return {(r.doc_id, r.item_id) for r in frame.collect()}, docs, items


def test_templates(spark):
    same = ITEMS[0][1]
    other = ("Berta buys 40 apples and 7 miles of sugar in the old market, then sells 9 apples to Otto for 6 "
             "euros.")
    broken = ("Berta buys 40 apples and 7 kg of sugar in the old market, then sells 9 apples to Otto for 6 "
              "euros.").replace("in the old", "at a new").replace("sells", "keeps")
    texts = [same, "Intro words. " + other + " And more.", broken, None, "", ITEMS[1][1].upper() + " ?",
             "unrelated text with 1 2 3 4 5 6 7 8 9 numbers", "x short but whole item here y",
             "lorem ipsum " * 50 + ITEMS[1][1], same, "two words"]
    found, docs, items = leaks(spark, texts)
    assert found == {(0, 1), (1, 1), (5, 2), (7, 6), (8, 2), (9, 1)}
    clean = templates.clean_stage(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 6, 10]


def test_inconsistent_slots_are_no_evidence(spark):
    item = "Tom gave 4 pens to Tom and 4 books to Tom because Tom had 4 pens and 4 books left over."
    good = item.replace("Tom", "Eva").replace("4", "9")
    bad, k = "", 0
    for part in re.split("(Tom|4)", item):
        k += part in ("Tom", "4")
        bad += f"N{'abcdefghijkl'[k]}x" if part == "Tom" else str(k + 10) if part == "4" else part
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    assert [r.doc_id for r in templates.decontaminate(docs, items).collect()] == [1]


def test_verbatim_copies_are_found_whatever_their_tokens(spark):
    texts = ["What is 17 * 23 + 4?", "Evaluate 3/4 + 5/8 - 1/2.", "Der Hund, die Katze, der Vogel.",
             "If a car travels 60km in 2h, how far does it go in 5h?", "1 2 3 4 5 6 7 8 9", "two words"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = ["so: " + t for t in texts] + [t.upper() for t in texts] + [t.lower() for t in texts]
    docs += ["If a car travels 80km in 3h, how far does it go in 7h?", "What is 18 * 23 + 4?", "if a car stands"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = templates.decontaminate(frame, items, verbatim_all=True)
    assert no_python(found)
    pairs = sorted((r.doc_id, r.item_id) for r in found.collect())
    assert pairs == [(i, i % 6) for i in range(18)] + [(18, 3)]
    default = sorted((r.doc_id, r.item_id) for r in templates.decontaminate(frame, items).collect())
    assert default == [p for p in pairs if p[1] < 4]


def test_templates_on_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = cases.documents(spark)
    assert templates.decontaminate(cases.empty(spark), items).collect() == []
    assert templates.decontaminate(docs, items.limit(0)).collect() == []
    assert templates.clean_stage(docs, items.limit(0)).count() == docs.count()


def test_digest_of_kept_text(spark):
    docs = spark.createDataFrame([(1, None, "a")], "doc_id long, text string, source string")
    assert lines.line_dedup(docs).first().kept_sha256 == hashlib.sha256(b"").hexdigest()
