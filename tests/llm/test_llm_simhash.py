import random
import re

import pytest
from xxhash import xxh64_intdigest

from strata.llm import simhash
from strata.llm.components import components

import cases


def plain_print(text, n=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def clustered(seed, n=300):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    out = []
    for _ in range(n):
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            v ^= 1 << rng.randrange(64)
        out.append(v)
    return list(dict.fromkeys(out))


def test_tree_search_is_exact():
    rng = random.Random(5)
    values = clustered(6)
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for _ in range(50):
        q, r = rng.choice(values) ^ 1 << rng.randrange(64), rng.randint(0, 8)
        assert sorted(tree.values[i] for i in tree.within(q, r)) == sorted(
            v for v in values if (v ^ q).bit_count() <= r)


@pytest.mark.parametrize("max_shard", [2048, 5])
def test_links_connect_what_all_pairs_connect(spark, max_shard):
    values = clustered(7)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(frame, 4, max_shard)).collect()}
    mine = [roots.get(v, v) for v in signed]
    plain = plain_components(values, 4)
    pairs = {(a, b) for a, b in zip(mine, plain)}
    assert len(pairs) == len(set(mine)) == len(set(plain))


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((60, 50), (200, 190), (40, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        up = list(range(n))

        def root(i):
            while up[i] != i:
                i = up[i]
            return i

        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            up[y] = x
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {i: root(i) for e in edges for i in e if e[0] != e[1] or i in got}
    path = [(i, i + 1) for i in range(100)]
    rng.shuffle(path)
    got = components(spark.createDataFrame(path, "a long, b long")).collect()
    assert len(got) == 101 and {r.root for r in got} == {0}


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = docs.collect()
    prints = [plain_print(r.text) for r in rows]
    group = plain_components(prints, 4)
    label = {}
    for r, g in zip(rows, group):
        if r.doc_id is not None:
            label[g] = min(label.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f"{p:016x}", str(label.get(g))) for r, p, g in zip(rows, prints, group))
    out = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in out) == want

    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(group))
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(label.get(g)) for g in set(group))
    for f in (simhash.near_duplicates, simhash.one_of_each):
        assert f(cases.empty(spark)).collect() == []


def test_one_of_repeated_rows_is_the_least_by_its_other_columns(spark):
    rows = [(1, "some words of a text that repeats here", c, n) for c, n in (("b", 1), ("a", 2), ("a", 1), (None, 3))]
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string, __key string, __n int").repartition(parts)
        out = simhash.one_of_each(docs)
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.collect()] == [rows[3]]           # nulls are least
