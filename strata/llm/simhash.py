"""SimHash near-dedup with BK-trees over shards of fingerprints.

1. Fingerprint: words of the lower-cased text, shingles of ``shingle`` words
   (repeats counted), XXH64 of each, and the bitwise majority over all of them.
2. Shards: fingerprints at most ``radius`` bits apart agree on at least one of
   ``radius + 1`` bit pieces (pigeonhole), so each distinct fingerprint goes to one
   shard for each piece, keyed by (piece, its value). No pair is lost.
3. In a shard a BK-tree holds the fingerprints: a child hangs under its parent by
   their integer Hamming distance, and a search within the radius follows only
   the child edges d with |d - distance| <= radius. Searching while inserting finds
   every link of the shard; only links that join two parts are given out (a
   spanning forest), so a dense group of m fingerprints gives m - 1 rows, not m^2.
4. Components over those links, labelled by the smallest document id.

A tree of the whole corpus grows with it, so no tree is broadcast: each shard's
tree is built where the shard's fingerprints are. A shard above ``max_shard``
fingerprints is cut again by pieces of its remaining bits (again radius + 1 of
them), which keeps every link, until it fits or no bits remain.

Defined results: null or wordless texts have fingerprint zero and are linked like
any other; fewer words than a shingle are one shingle; equal fingerprints are one
component; rows with a null id get fingerprint and component like others (the
smallest id ignores nulls, null where no member has an id); an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ID, fresh, key_columns, ship, utf8, write_table
from strata.llm.components import components
from strata.operators.merge import tie_break_order

BITS = 64
BLOCK = 1 << 16             # shingles counted at once


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of a text in UTF-8."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()        # bytes: A-Z, and white space 20, 09-0D only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)
    ends -= 1
    n = len(words) - shingle + 1
    votes = np.zeros(BITS, np.int64)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        h = np.array([xxh64_intdigest(line[s:e], 42) for s, e in
                      zip(starts[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist())],
                     np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((votes * 2 > n).astype(np.uint8), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The id, the text's hash (k1, k2) and the fingerprint (a signed long) of every row."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(text: pa.Array) -> pa.Array:
        import numpy as np

        return pa.array(np.array([fingerprint(t, shingle) for t in utf8(text)], np.uint64).view(np.int64))

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    k1, k2 = key_columns(text)
    return docs.select(F.col(f"`{id_col}`").alias(ID), k1.alias("k1"), k2.alias("k2"),
                       prints(text).alias("fp"))


class BKTree:
    """Burkhard-Keller tree over 64-bit integers under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Places of all members at most ``radius`` bits from ``value``."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            edges = children[at]
            if len(edges) <= 2 * radius:
                todo += [c for e, c in edges.items() if -radius <= e - d <= radius]
            else:
                todo += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        return found

    def add(self, value: int) -> int:
        """The member's place, old or new."""
        values, children = self.values, self.children
        at, new = 0, len(values)
        while values:
            d = (values[at] ^ value).bit_count()
            if d == 0:
                return at
            if d not in children[at]:
                children[at][d] = new
                break
            at = children[at][d]
        values.append(value)
        children.append({})
        return new


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct ``values`` of one shard."""
    if len(values) == 2:
        a, b = values
        return [(a, b)] if (a ^ b).bit_count() <= radius else []
    tree, up, links = BKTree(), [], []

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for value in values:
        near = tree.within(value, radius)
        at = tree.add(value)
        up.append(at)
        for other in near:
            a, b = root(other), root(at)
            if a != b:
                up[a] = b
                links.append((tree.values[other], value))
    return links


def pieces(free: list[tuple[int, int]], parts: int) -> list[list[tuple[int, int]]]:
    """Split bit ranges (low, high) into ``parts`` pieces of nearly equal numbers of bits."""
    bits = [b for lo, hi in free for b in range(lo, hi)]
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        ranges: list[tuple[int, int]] = []
        for bit in bits[a:b]:
            if ranges and ranges[-1][1] == bit:
                ranges[-1] = (ranges[-1][0], bit + 1)
            else:
                ranges.append((bit, bit + 1))
        out.append(ranges)
    return out


def mask(ranges: list[tuple[int, int]]) -> int:
    m = 0
    for lo, hi in ranges:
        m |= ((1 << (hi - lo)) - 1) << lo
    return m - (1 << 64) if m >= 1 << 63 else m


@lru_cache(maxsize=100_000)
def cells(tag: str, parts: int) -> tuple[tuple[str, int], ...]:
    """(tag, mask) of the cells that a shard is cut into; the mask holds the shard's own bits
    and one piece of the others. None where too few bits are left. Tags are places of
    pieces: "" the whole, "2" its piece 2, "2.0" the first piece of what that leaves."""
    used, free = [], [(b, b + 1) for b in range(BITS)]
    for k in tag.split(".") if tag else []:
        used += pieces(free, parts)[int(k)]
        taken = mask(used)
        free = [(b, b + 1) for b in range(BITS) if not taken >> b & 1]
    if len(free) < parts:
        return ()
    return tuple((f"{tag}.{k}".lstrip("."), mask(used + p)) for k, p in enumerate(pieces(free, parts)))


def dealt(rows: DataFrame, parts: int) -> DataFrame:
    """(tag, key, fp): each (tag, fp) goes to every cell of its shard. A shard without bits
    to cut by stays as it is, with the tag "-"."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, keys, fps = [], [], []
            for tag, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                below = cells(tag, parts)
                for t, m in below:
                    tags.append(t)
                    keys.append(f"{t}/{signed(fp & m & (1 << 64) - 1)}")
                    fps.append(fp)
                if not below:
                    own = mask_of(tag, parts)
                    tags.append("-")
                    keys.append(f"{tag}/{signed(fp & own & (1 << 64) - 1)}")
                    fps.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(tags, pa.string()), pa.array(keys, pa.string()),
                                              pa.array(fps, pa.int64())], ["tag", "key", "fp"])

    return rows.select("tag", "fp").mapInArrow(run, "tag string, key string, fp long")


def mask_of(tag: str, parts: int) -> int:
    """The bits that a shard's members agree on."""
    above, _, last = tag.rpartition(".")
    return cells(above, parts)[int(last)][1]


def sharded(prints: DataFrame, radius: int, max_shard: int) -> DataFrame:
    """(key, fp): every pair within the radius shares a shard of at most ``max_shard``
    fingerprints, or one whose remaining bits are used up (at most 2^radius values)."""
    parts = radius + 1
    rows, done = prints.select(F.lit("").alias("tag"), "fp"), None
    while True:
        rows = write_table(dealt(rows, parts), "shards")
        big = rows.where("tag <> '-'").groupBy("key").count().where(F.col("count") > max_shard)
        big = write_table(big.select("key"), "big-shards")
        fits = rows.join(big, "key", "left_anti").select("key", "fp")
        done = fits if done is None else done.unionByName(fits)
        if big.isEmpty():
            return done
        rows = rows.join(big, "key", "left_semi").select("tag", "fp").distinct()


def links(prints: DataFrame, radius: int, max_shard: int) -> DataFrame:
    """(a, b) fingerprints at most ``radius`` bits apart, connecting whatever all such
    pairs connect."""
    # a shard of one has no link; the others come together by key, a bounded list each
    grouped = (sharded(prints, radius, max_shard).groupBy("key")
               .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1).select("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = (1 << 64) - 1
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            found = [(signed(a), signed(b)) for row in batch.column(0)
                     for a, b in shard_links([v & m for v in row.as_py()], radius)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def classes(rows: DataFrame, radius: int, max_shard: int) -> DataFrame:
    """(fp, first, first_id, root): a row for each fingerprint with its component's root
    fingerprint, its smallest id, and its first row (id null, id, k1, k2)."""
    # one row for each fingerprint from here on: copies, however many, are one
    first = F.min(F.struct(F.col(ID).isNull().alias("no_id"), F.col(ID).alias("id"), "k1", "k2"))
    distinct = write_table(rows.groupBy("fp").agg(F.min(ID).alias("first_id"), first.alias("first")),
                           "distinct")
    class_of = components(links(distinct.select("fp"), radius, max_shard)).withColumnRenamed("node", "fp")
    return write_table(distinct.join(class_of, "fp", "left")
                       .withColumn("root", F.coalesce("root", "fp")), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4, max_shard: int = 2048) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    rows = write_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    member = classes(rows, radius, max_shard)
    smallest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = member.join(smallest, "root").select("fp", "component_id")
    return (rows.join(label, "fp")
            .select(F.col(ID).alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 4, radius: int = 4, max_shard: int = 2048) -> DataFrame:
    """One row of each component of ``docs``, that of its smallest id, all columns as they are."""
    rows = write_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    member = classes(rows, radius, max_shard)
    chosen = member.groupBy("root").agg(F.min("first").alias("first"))
    # id and text hash in one key: a text with many copies spreads by their ids
    key = lambda i, k1, k2: F.concat_ws("/", k1, k2, F.coalesce(i.cast("string"), F.lit("null")))
    at, n = fresh(docs, "__key", "__n")
    chosen = chosen.select(key(F.col("first.id"), F.col("first.k1"), F.col("first.k2")).alias(at))
    k1, k2 = key_columns(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    kept = docs.withColumn(at, key(F.col(f"`{id_col}`"), k1, k2)).join(chosen, at)
    # rows repeated with id and text: the least by their other columns stays, also on a retry
    again = Window.partitionBy(at).orderBy(*tie_break_order(docs, [id_col, text_col]))
    return kept.withColumn(n, F.row_number().over(again)).where(F.col(n) == 1).drop(at, n)
