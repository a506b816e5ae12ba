import hashlib
import random
from collections import Counter

import pytest

from strata.llm import repeats

import cases


def brute(texts, length):
    """Removed flags of every text, by counting all windows."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                flags[i:i + length] = b"\1" * length
        out.append(bytes(flags))
    return out


def expected(texts, length):
    rows = []
    for t, flags in zip(texts, brute(texts, length)):
        kept = bytes(c for c, f in zip(t, flags) if not f)
        spans = sum(1 for s in flags.split(b"\0") if s)
        rows.append((len(t), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return rows


def check(spark, texts, length, max_group=256):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in repeats.remove_repeats(docs, length=length, max_group=max_group).collect()}
    want = expected([(t or "").encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want


def pieces(seed, n, alphabet="ab"):
    rng = random.Random(seed)
    blocks = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 60))) for _ in range(8)]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(blocks) if rng.random() < 0.6 else
                       "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30)))
                       for _ in range(rng.randint(0, 9)))
        out.append(text)
    return out


@pytest.mark.parametrize("seed,alphabet,max_group", [(1, "abcdefgh", 256), (2, "ab", 256), (3, "abcdefgh", 2),
                                                     (4, "ab", 3), (5, "aé", 256)])
def test_against_all_windows(spark, seed, alphabet, max_group):
    check(spark, pieces(seed, 40, alphabet), 40, max_group)


def test_runs_and_periods(spark):
    check(spark, ["x" * 300, "x" * 41, "x" * 40, "x" * 39, "abc" * 60, "zz" + "abc" * 20, None, ""], 40)


def test_same_passage_in_many_contexts_is_cut_finer(spark):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcdefghijklmnop") for _ in range(37))
    some = [("".join(rng.choice("abcd") for _ in range(30)) + shared
             + "".join(rng.choice("abcd") for _ in range(30))) for _ in range(60)]
    check(spark, some, 40, max_group=4)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = docs.collect()
    out = repeats.remove_repeats(docs, length=100, keep_spans=True).collect()
    want = sorted((str(r.doc_id), *e) for r, e in
                  zip(rows, expected([(r.text or "").encode() for r in rows], 100)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == want
    assert all(sum(s["to"] - s["from"] for s in r.spans) == r.n_removed for r in out)
    assert repeats.remove_repeats(cases.empty(spark)).collect() == []


def test_suffix_array_intervals_hold_all_common_prefixes():
    rng = random.Random(4)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 7))).encode() for _ in range(30)]
    order, lcp = repeats.suffix_array(words)
    seen = {(d, tuple(sorted(order[a:b]))) for d, a, b in repeats.prefix_intervals(lcp)}
    for depth in range(8):
        groups = {}
        for i, w in enumerate(words):
            if len(w) >= depth:
                groups.setdefault(w[:depth], []).append(i)
        for prefix, members in groups.items():
            if len(members) > 1:
                ext = min(repeats.common_prefix(words[a], words[b]) for a in members for b in members)
                assert (ext, tuple(sorted(members))) in seen


def test_groups_are_left_maximal():
    left = [b"xa", b"xa", b"ya"]             # reversed bytes before the anchors
    right = [b"12345", b"12345", b"12399"]
    found = {(reach, depth, tuple(sorted(m))) for reach, depth, m in repeats.maximal_repeats(left, right, 3)}
    assert (2, 5, (0, 1)) in found and (0, 3, (0, 1, 2)) in found


def test_bad_length(spark):
    with pytest.raises(ValueError):
        repeats.remove_repeats(cases.empty(spark), length=8)


@pytest.mark.parametrize("m", [32, 64, 256])
def test_spans_grow_with_the_members_not_with_their_groups(spark, m):
    rng = random.Random(m)
    passage = "".join(rng.choice("abcdefgh") for _ in range(120))
    # one passage in m texts, cut at m different ends: its members lie in m nested repeat groups
    some = ["".join(rng.choice("xyz") for _ in range(30)) + passage[i % 40:120 - i % 37]
            + "".join(rng.choice("xyz") for _ in range(30)) for i in range(m)]
    check(spark, some, 40)
    left = [t[:60].encode()[::-1] for t in some]
    right = [t[60:].encode() for t in some]
    spans = repeats.repeated_offsets(left, right, 40)
    assert sum(map(len, spans)) <= 2 * m


def test_united_ranges():
    rng = random.Random(9)
    for _ in range(500):
        spans = {(a, a + rng.randint(0, 5)) for a in (rng.randint(0, 40) for _ in range(rng.randint(0, 8)))}
        held = {i for a, b in spans for i in range(a, b + 1)}
        out = repeats.united(spans)
        assert [i for a, b in out for i in range(a, b + 1)] == sorted(held)
        assert all(b + 1 < c for (_, b), (c, _) in zip(out, out[1:]))
