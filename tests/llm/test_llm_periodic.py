"""Periodic runs against a scan of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import cases
from pyspark.sql import functions as F
from strata.llm import periodic as P
from strata.llm.queries import op12_periodic_runs, table

from conftest import SF_SMALL


def every_run(words, exponent=4, length=6):
    """(start, length, period): each period in turn, smallest periods only."""
    found = {}
    for p in range(1, len(words)):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(length, exponent * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    out = []
    for (s, e), p in found.items():
        stretch = words[s:e]
        if not any(stretch[q:] == stretch[:-q] for q in range(1, p)):
            out.append((s, e - s, p))
    return sorted(out)


def random_words(rng, most=70):
    letters, words = rng.choice([1, 2, 2, 3, 5]), []
    for _ in range(rng.randint(0, 14)):
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        words += root * rng.choice([1, 1, 2, 3, 5, 7])
    return words[:most]


@pytest.mark.parametrize("exponent,length", [(4, 6), (2, 2), (2, 6), (3, 1), (7, 4)])
def test_runs_equal_a_scan_of_every_period(exponent, length):
    rng = random.Random(exponent * 100 + length)
    for _ in range(500):
        words = random_words(rng)
        want = every_run(words, exponent, length)
        # appended one by one, or in blocks, and asked in between: the same runs
        step = rng.choice([1, 2, 7, 1000])
        catcher = P.SquareCatcher(exponent, length)
        for i in range(0, len(words), step):
            catcher.append(np.array(words[i:i + step], np.int64), last=i + step >= len(words) and rng.random() < 0.5)
            if rng.random() < 0.1:
                catcher.runs()
        assert catcher.runs() == want, (words, step)
        assert P.periodic_runs(np.array(words, np.int64), exponent, length) == (want if len(words) >= 1 else [])


def test_long_runs_and_repetitive_words():
    assert P.periodic_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    three = np.array([0, 1, 2] * 50_000 + [9] + [4, 5] * 40_000, np.int64)
    assert P.periodic_runs(three) == [(0, 150_000, 3), (150_001, 80_000, 2)]
    overlap_free = np.array([bin(i).count("1") & 1 for i in range(1 << 14)], np.int64)
    assert P.periodic_runs(overlap_free, 3, 1) == []       # the Thue-Morse word has no cubes
    long_period = np.tile(np.arange(30_000), 5)
    assert P.periodic_runs(long_period) == [(0, 150_000, 30_000)]


def test_words_of_pieces(monkeypatch):
    monkeypatch.setattr(P, "PIECE", 5)
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice(["a", "bc", " ", "\n", "\x0b", "\x1c", "é", "\xa0", "\x85"])
                       for _ in range(rng.randint(0, 20))).encode()
        words, names = P.number_words(text)
        assert [names[i] for i in words] == text.split()


def plain(doc_id, text, plant=True):
    """The whole contract without the operator's code."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = every_run(words)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    rest = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_query_equals_the_plain_version(spark):
    got = op12_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    rows = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    short = {r[0]: r[1] for r in rows if len(r[1].split()) <= 800}        # the plain scan is quadratic
    assert len(short) > 100
    got = {r[0]: tuple(r) for r in got.collect()}
    assert len(got) == len(rows)
    for doc_id, text in short.items():
        assert got[doc_id] == plain(doc_id, text)
    assert sum(r[1] for r in got.values()) > 10


def test_awkward_rows(spark):
    df = cases.documents(spark)
    rows = df.select("doc_id", "text").collect()
    got = P.find_runs(df, plant=True)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain(r[0], r[1])) for r in rows)
    assert P.find_runs(cases.empty(spark)).count() == 0
    kept = {r["doc_id"]: r for r in P.find_runs(df, keep_runs=True).collect()}
    assert kept[21]["runs"][0].asDict() == {"start": 0, "length": 700, "period": 1}      # "ab " * 700
    assert bytes(kept[21]["collapsed"]) == b"ab"


def test_very_long_text_and_bytes(spark):
    text = "alpha beta gamma delta epsilon " * 100_000 + "end"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = P.find_runs(df).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 500_000, 5, 100_000_000)
    broken = spark.range(1).select(F.lit(2).alias("doc_id"),
                                   F.expr("cast(unhex('FF20FF20FF20FF20FF20FF') as string)").alias("text"))
    row = P.find_runs(broken).first()
    assert (row.n_runs, row.length, row.period) == (1, 6, 1)
    assert row.collapsed_sha256 == hashlib.sha256(b"\xff").hexdigest()
