"""Decontamination against a plain version of the whole rule: all items, all windows, slots included."""

import math
import random

import pytest
from pyspark.sql import functions as F
import regex as R

import cases
from strata.llm import templates as T
from strata.llm.queries import op9_decontamination, table

from test_llm_native import no_python

NUM, UNIT, NAME = "<n>", "<u>", "<name>"
TOKEN = R.compile(r"[\p{L}\p{M}\p{N}_]+")


def tokens(text):
    """(words, template, wording) of a text, token by token."""
    text = R.sub("[\u0001-\u0003_]", " ", text or "")
    text = R.sub(r"(?<=\p{N})[.,:/](?=\p{N})|(?<=\p{L})['’](?=\p{L})", "_", text)
    units = "|".join(T.UNITS)
    text = R.sub(rf"(?i)(?<![\p{{L}}\p{{M}}\p{{N}}_])(\p{{N}}[\p{{N}}_]*)({units})(?![\p{{L}}\p{{M}}\p{{N}}_])",
                 r"\1 \2", text)
    words, template, wording, end = [], [], [], 0
    for m in TOKEN.finditer(text):
        word, gap = m[0], text[end:m.start()]
        after_number = wording and wording[-1] == NUM and 1 <= len(gap) <= 2
        if R.fullmatch(r"\p{N}[\p{N}_]*", word) or word.lower() in T.NUMBER_WORDS:
            plain = full = NUM
        elif after_number and word.lower() in T.UNITS:
            plain = full = UNIT
        else:
            plain = word.lower()
            full = NAME if R.fullmatch(r"\p{Lu}[\p{L}\p{M}_]+", word) else plain
        words.append(word)
        template.append(full)
        wording.append(plain)
        end = m.end()
    return words, template, wording


def literal(window):
    return 2 * sum(t not in (NUM, UNIT, NAME) for t in window) >= len(window)


def plain_pairs(docs, items, window=8, min_share=0.3, min_windows=3, min_consistency=0.75, min_tokens=4,
                verbatim_all=True):
    """{(doc, item): (n_windows, n_matched, consistency)}."""
    parsed = {d: tokens(t) for d, t in docs.items()}
    out = {}
    for item, text in items.items():
        words, template, wording = tokens(text)
        low = [w.lower() for w in words]
        if 0 < len(words) < min_tokens and verbatim_all:
            for d, t in docs.items():
                edges = r"[\r\n]+" if len(words) == 1 else r"[\r\n.,:;!?()\[\]{}<>|\"«»“-‟…]+"
                if any([w.lower() for w in tokens(part)[0]] == low for part in R.split(edges, t or "")):
                    out[d, item] = (1, 1, 1.0)
        if len(words) < min_tokens:
            continue
        size = min(window, len(words))
        for kind, forms in ((0, template), (1, wording)):
            ours = {}
            for at in range(len(words) - size + 1):
                part = forms[at:at + size]
                if kind == 0 and literal(part):
                    ours[at] = ("form", tuple(part))
                elif kind == 1 and (verbatim_all or any(R.search(r"\p{L}", w) for w in words[at:at + size])):
                    ours[at] = ("form", tuple(part)) if literal(part) else ("words", tuple(low[at:at + size]))
            enough = min(len(ours), max(min_windows, math.ceil(len(ours) * min_share)))
            for d, (dw, dt, dp) in parsed.items():
                if (d, item) in out and kind == 1 and out[d, item] is not None:
                    continue
                shifts = {}
                for i in range(len(dw) - size + 1):
                    have = {("form", tuple(dt[i:i + size])), ("form", tuple(dp[i:i + size])),
                            ("words", tuple(w.lower() for w in dw[i:i + size]))}
                    for at, key in ours.items():
                        if key in have:
                            shifts.setdefault(i - at, set()).add(at)
                matched, worst = set(), 1.0
                for shift, places in shifts.items():
                    maps = {}
                    for p in {p + k for p in places for k in range(size)}:
                        if forms[p] in (NUM, UNIT, NAME):
                            maps.setdefault((forms[p], words[p]), set()).add(dw[p + shift].lower())
                    good = sum(len(v) == 1 for v in maps.values()) / len(maps) if maps else 1.0
                    if good >= min_consistency:
                        matched |= places
                        worst = min(worst, good)
                if matched and len(matched) >= enough:
                    out[d, item] = (len(ours), len(matched), worst)
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(list(items.items()), "item_id long, text string")
    frame = T.decontaminate(d, i, **options)
    assert no_python(frame)
    return {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.consistency) for r in frame.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for k, (n, m, c) in want.items():
        assert got[k][:2] == (n, m) and got[k][2] == pytest.approx(c), k


def varied(rng, words):
    """A copy of an item with some of its slots exchanged, words changed or case turned."""
    swap = {"Anna": "McDonald", "Tom": "Eve", "USA": "France", "12": "3,500", "3": "nine", "kg": "miles", "seven": "40"}
    kind = rng.randrange(5)
    if kind == 0:
        return " ".join(swap.get(w, w) for w in words)
    if kind == 1:
        return " ".join(words).upper()
    if kind == 2:
        return " ".join(rng.choice(cases.WORDS) if rng.random() < 0.15 else w for w in words)
    if kind == 3:
        return " ".join(rng.choice(list(swap.values())) if w in swap else w for w in words)
    return " ".join(words[rng.randrange(len(words)):])


def test_random_texts_equal_the_plain_version(spark):
    rng = random.Random(12)
    slots = ["Anna", "Tom", "USA", "12", "3", "kg", "seven", "60km", "O'Brien", "1 2 3"]
    items = {n: " ".join(rng.choice(slots) if rng.random() < rng.choice([0.1, 0.35, 0.8]) else rng.choice(cases.WORDS)
                         for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 15, 30]))) for n in range(40)}
    items[90], items[91], items[92] = "", "Yes", "no way"
    docs = {}
    for n in range(120):
        parts = [cases.sentence(rng, rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            parts += [varied(rng, items[rng.randrange(40)].split()), cases.sentence(rng, rng.randint(1, 6))]
        docs[n] = rng.choice([" ", "\n", ". "]).join(parts)
    docs |= {200: "", 201: None, 202: docs[5], 203: "Yes", 204: "I said yes to it", 205: "oh, no way! never", 206: "no way out"}
    for options in ({"verbatim_all": True}, {}, {"verbatim_all": True, "window": 5, "min_windows": 1}):
        want = plain_pairs(docs, items, **({"verbatim_all": False} | options))
        assert len(want) > 40
        close(found(spark, docs, items, **options), want)


def test_reparameterised_questions(spark):
    items = {1: "Twelve apples cost three dollars. How much do seven more apples cost in that shop?",
             2: "McDonald sold USA bonds for 40 dollars and O'Brien bought 7 of them in the end of the week.",
             3: "Yes", 4: "two words"}
    docs = {1: "Nineteen apples cost eight dollars. How much do four more apples cost in that shop?",
            2: "Smith sold France bonds for 9 dollars and Miller bought 5 of them in the end of the week.",
            3: "I said yes to a long and honest proposal about rivers", 4: "First line\nYes\nlast line",
            5: "they gave us three words, not two words more", 6: "so: two words.", 7: "yes, and more"}
    assert found(spark, docs, items, verbatim_all=True).keys() == {(1, 1), (2, 2), (4, 3), (6, 4)}


def test_query_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, sf, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_matched, r.consistency)
           for r in op9_decontamination(spark, sf).collect()}
    close(got, plain_pairs(docs, items))


def test_very_long_text_and_bytes(spark):
    item = "What is the name of the river that flows through the old capital of the northern kingdom"
    docs = {1: "word other " * 200_000 + item + " end" * 1000}
    assert found(spark, docs, {1: item}, verbatim_all=True).keys() == {(1, 1)}
    bad = cases.not_utf8(spark)
    assert T.decontaminate(bad, spark.createDataFrame([(1, item)], "item_id long, text string")).count() == 0
    assert T.clean_stage(cases.documents(spark), spark.createDataFrame([(1, "ab ab ab ab ab")],
                                                                      "item_id long, text string")).columns[-1] == "__text"


def test_only_windows_that_begin_like_an_item_window_are_hashed(spark, monkeypatch):
    items = spark.createDataFrame([(1, "red fish swim under cold bridges near Dover at 5 km"),
                                   (2, "blue birds sing"), (3, "Red Fish rest")], "item_id int, text string")
    each = T.item_windows(items, "item_id", "text", 4, 2, True).cache()
    starts = {n: T.beginnings_of(each, n) for n in (3, 4)}
    text = "we saw that red fish swim under cold bridges near Paris at 9 km and blue birds sing, RED FISH REST"
    doc = (spark.createDataFrame([(text,)], "t string").select(T.numbered(T.tokens_text(F.col("t"))).alias("n"))
           .select(T.canonical_tokens(F.col("n")).alias("f")).select(T.token_hashes(F.col("f")).alias("h"))).cache()
    known = {r[0] for r in each.select("hash").collect()}
    for n in (3, 4):
        every = {tuple(r) for r in doc.select(F.explode(T.windows("h", n)).alias("w")).select("w.*").collect()}
        some = {tuple(r) for r in doc.select(F.explode(T.windows("h", n, starts[n])).alias("w")).select("w.*").collect()}
        assert some < every and len(some) < len(every) / 2 + 1
        assert {w for w in every if w[1] in known} == {w for w in some if w[1] in known} != set()
    # too many pairs to be told: all windows are hashed, and the pairs found are the same
    docs = spark.createDataFrame([(1, text), (2, "nothing of it"), (3, None)], "doc_id int, text string")
    pairs = lambda: sorted(map(tuple, T.decontaminate(docs, items, window=4, min_tokens=2,
                                                      verbatim_all=True).collect()))
    found = pairs()
    monkeypatch.setattr(T, "BEGINNINGS", 1)
    assert T.beginnings_of(each, 4) is None and pairs() == found and {p[1] for p in found} == {1, 2, 3}
