"""Removal of long repeated byte strings by a sparse enhanced suffix array.

Every string of ``length`` bytes (a *window*) that starts at two places of the
corpus is removed at both. Windows never cross documents; all are judged on the
input.

1. **Anchors.** In the first ``length // 2`` bytes of a window the k-gram with the
   smallest hash is its anchor (leftmost on ties). The choice depends on the
   window's bytes alone, so equal windows have their anchors at equal offsets, and
   one anchor serves a run of neighbouring windows. This samples about one suffix
   in a hundred bytes, and loses no window.
2. **Cells.** The windows of an anchor share its *core* (the bytes that all of them
   hold), and lie in its *context* (the bytes that any of them holds). Two counts
   by hash, both with partial sums, settle most anchors without moving text: a
   core that occurs once has no repeat; a context that occurs twice has only
   repeats.
3. **Enhanced suffix array.** What is left are the edges of repeats: one member for
   each distinct context travels with its bytes to the task of its core. There
   the suffixes from the anchors are sorted, with the common-prefix length of each
   neighbouring pair; a stack scan builds the tree of common-prefix intervals from
   them. Where the members of an interval of depth r differ to their left, it is
   split by their common left extension; each part with left + r >= length is a
   maximal repeat group, with all its occurrences. Bytes are compared, not hashes.
4. A core with more than ``max_group`` distinct contexts is cut in two by window
   offset, which makes the cores longer, until groups are small or a core is a
   whole window (then its members are equal and one count decides).

A text is known by a 128-bit hash of its bytes, not by its id or place: equal texts
have equal results, and a retry finds the same key. Texts travel compressed.

Defined results: a null or empty text and texts shorter than ``length`` lose nothing;
repeated rows are repeats of each other; a run of one character repeats itself;
very long texts are read in one piece by one task but send only anchors; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship, utf8, write_table
from strata.operators.joins import sized

GRAM = 8                     # bytes of an anchor's k-gram
MIX = 0x9E3779B97F4A7C15     # odd multiplier of the k-gram hash (2^64 / golden ratio)
SEGMENT = 1 << 20            # windows handled at once: bounds a task's arrays
CHUNK_ROWS = 50_000          # rows of a batch that a task gives out


def anchors(text: bytes, length: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, first window, last window) of every run of windows with one anchor."""
    windows = len(text) - length + 1
    for lo in range(0, windows, SEGMENT):
        hi = min(windows, lo + SEGMENT)
        at, first, last = anchor_runs(memoryview(text)[lo:hi - 1 + length], length)
        yield from zip((at + lo).tolist(), (first + lo).tolist(), (last + lo).tolist())


def anchor_runs(text, length: int):
    import numpy as np

    windows = len(text) - length + 1
    span = length // 2 - GRAM + 1              # k-grams that start in the first half
    count = windows + span - 1
    gram = np.frombuffer(text, np.uint8)[:count + GRAM - 1].astype(np.uint64)
    for k in (1, 2, 4):                        # k bytes, then 2k
        gram = gram[:-k] | gram[k:] << np.uint64(8 * k)
    gram *= np.uint64(MIX)
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(MIX)
    # the high half of the hash, the place below it: ties go to the left
    gram &= np.uint64(0xFFFFFFFF00000000)
    gram |= np.arange(count, dtype=np.uint64)
    # smallest of each span of k-grams, by running minima of blocks in both directions
    blocks = -(-count // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = gram
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:windows], ahead[span - 1:span - 1 + windows])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate(([0], edge))
    last = np.concatenate((edge, [windows])) - 1
    return at[first], first, last


def cells_of(anchor: int, first: int, last: int, level: int, length: int
             ) -> Iterator[tuple[int, int, int, int, int]]:
    """(cell, lowest offset, highest offset, first window, last window) of an anchor's
    windows: level 0 is one cell, each further level halves them. Cells lie on a fixed
    grid of window offsets (anchor minus window), the same for every anchor."""
    reach = length // 2 - GRAM
    width = max(1, -(-(reach + 1) >> level))
    lo, hi = anchor - last, anchor - first
    for cell in range(lo // width, hi // width + 1):
        low, high = cell * width, min(cell * width + width - 1, reach)
        yield cell, low, high, anchor - min(hi, high), anchor - max(lo, low)


def hashes(text, anchor: int, cell: tuple[int, int, int, int, int], level: int, length: int
           ) -> tuple[int, int]:
    """64-bit hashes (signed) of a cell's core and of its context."""
    from xxhash import xxh3_64_intdigest

    number, low, high, first, last = cell
    core = xxh3_64_intdigest(text[anchor - low:anchor - high + length], level << 32 | number)
    # the offset tells contexts of equal bytes around other anchors apart
    context = xxh3_64_intdigest(text[first:last + length], anchor - first + 1)
    return signed(core), signed(context)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def text_key(text: bytes) -> tuple[int, int]:
    from xxhash import xxh3_128_intdigest

    h = xxh3_128_intdigest(text)
    return signed(h >> 64), signed(h & (1 << 64) - 1)


def place_of(anchor: int, first: int, last: int) -> int:
    """Anchor and its offsets to the first and last window in one long."""
    return anchor << 32 | anchor - first << 16 | anchor - last


def windows_at(place: int) -> tuple[int, int, int]:
    anchor = place >> 32
    return anchor, anchor - (place >> 16 & 0xFFFF), anchor - (place & 0xFFFF)


def batches_of(columns: list[str], kinds: list[pa.DataType], rows: Iterator[tuple]
               ) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    out: list[list] = [[] for _ in columns]
    for row in rows:
        for column, value in zip(out, row):
            column.append(value)
        if len(out[0]) >= CHUNK_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], columns)
            out = [[] for _ in columns]
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], columns)


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """(core, context, k1, k2, place): one row for each anchor of each text."""
    names, kinds = ["core", "context", "k1", "k2", "place"], [pa.int64()] * 5

    def rows(batches):
        for batch in batches:
            for text in utf8(batch.column(0)):
                if len(text) < length:
                    continue
                k1, k2 = text_key(text)
                view = memoryview(text)
                for anchor, first, last in anchors(text, length):
                    cell = next(cells_of(anchor, first, last, 0, length))
                    core, context = hashes(view, anchor, cell, 0, length)
                    yield core, context, k1, k2, place_of(anchor, first, last)

    return texts.select(TEXT).mapInArrow(lambda b: batches_of(names, kinds, rows(b)),
                                         ", ".join(f"{n} long" for n in names))


def packed_texts(texts: DataFrame, with_id: bool) -> DataFrame:
    """(k1, k2, z[, id]) with the text compressed for the shuffle."""
    kind = texts.schema[ID].dataType.simpleString()
    names = ["k1", "k2", "z", *([ID] if with_id else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys, out = [], []
            for text in utf8(batch.column(0)):
                keys.append(text_key(text))
                out.append(pack.compress(text))
            arrays = [pa.array([k[0] for k in keys], pa.int64()),
                      pa.array([k[1] for k in keys], pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays + [batch.column(1)] * with_id, names)

    return texts.select(TEXT, ID).mapInArrow(
        run, "k1 long, k2 long, z binary" + f", {ID} {kind}" * with_id)


def unpack(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)


CELL_NAMES = ["core", "context", "copies", "k1", "k2", "place", "bytes"]
CELL_KINDS = [pa.int64()] * 6 + [pa.binary()]
CELL_TYPE = "core long, context long, copies long, k1 long, k2 long, place long, bytes binary"


def with_bytes(members: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The members with their context bytes, cut from their texts."""
    asked = write_table(members.groupBy("k1", "k2")
                        .agg(F.collect_list(F.struct("core", "context", "copies", "place")).alias("asked")),
                        "asked")

    def rows(batches):
        for batch in batches:
            for k1, k2, z, asked in zip(*(batch.column(i) for i in range(4))):
                text = unpack(z.as_py())
                for m in asked.as_py():
                    _, first, last = windows_at(m["place"])
                    yield (m["core"], m["context"], m["copies"], k1.as_py(), k2.as_py(), m["place"],
                           text[first:last + length])

    # one row for each text, however many copies it has; the join takes the same partitioning
    once = packed_texts(texts, False).dropDuplicates(["k1", "k2"])
    joined = once.join(asked, ["k1", "k2"]).select("k1", "k2", "z", "asked")
    return joined.mapInArrow(lambda b: batches_of(CELL_NAMES, CELL_KINDS, rows(b)), CELL_TYPE)


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n                       # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def suffix_array(suffixes: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the suffixes, and the common-prefix length of each with the one before."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    return order, [0, *(common_prefix(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:]))]


def prefix_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, from, to) of each common-prefix interval of an enhanced suffix array, the
    deep ones first: a scan that keeps the open intervals on a stack."""
    open_ = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        depth, start = (lcp[i] if i < len(lcp) else -1), i - 1
        while open_ and open_[-1][0] > depth:
            d, start = open_.pop()
            if i - start > 1:
                yield d, start, i
        if depth >= 0 and (not open_ or open_[-1][0] < depth):
            open_.append((depth, start))


def maximal_repeats(left: list[bytes], right: list[bytes], length: int
                    ) -> Iterator[tuple[int, int, list[int]]]:
    """(left extension, right length, members) of each maximal repeat group.

    ``left`` holds the reversed bytes before each anchor, ``right`` those from it on. A
    group is every member whose strings agree over both parts, left + right being
    ``length`` at least, and whose members differ (or end) beyond on both sides.
    """
    order, lcp = suffix_array(right)
    for depth, lo, hi in prefix_intervals(lcp):
        members = order[lo:hi]
        # an interval whose members all go on alike to the left is one class; else a
        # second scan, over the reversed left parts, gives the classes of left extension
        extension = common_prefix(min(left[m] for m in members), max(left[m] for m in members))
        if extension == max(len(left[m]) for m in members):
            if extension + depth >= length:
                yield extension, depth, members
            continue
        again, shared = suffix_array([left[m] for m in members])
        for reach, a, b in prefix_intervals(shared):
            if reach + depth >= length:
                yield reach, depth, [members[i] for i in again[a:b]]


def repeated_offsets(left: list[bytes], right: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each member the window offsets that repeat in the group, as ranges (lowest, highest)
    that neither meet nor adjoin: a member lies in many nested groups, whose ranges overlap."""
    found: list[set[tuple[int, int]]] = [set() for _ in left]
    for reach, depth, members in maximal_repeats(left, right, length):
        span = max(0, length - depth), reach
        for m in members:
            found[m].add(span)
    return [united(spans) for spans in found]


def united(spans: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of ranges of integers, as the fewest ranges."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], high)
        else:
            out.append((low, high))
    return out


SPAN_NAMES = ["k1", "k2", "first", "last"]
SPAN_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
SPAN_TYPE = "k1 long, k2 long, first int, last int"


def settle(cells: DataFrame, length: int) -> DataFrame:
    """Windows with a repeat among the distinct contexts of each core.

    A member with several copies takes part but has no row: all of its windows are
    repeats already.
    """
    groups = (cells.groupBy("core")
              .agg(F.collect_list(F.struct("copies", "k1", "k2", "place", "bytes")).alias("members"))
              .where(F.size("members") > 1).select("members"))

    def rows(batches):
        for batch in batches:
            for members in batch.column(0):
                members = members.as_py()
                at = [windows_at(m["place"]) for m in members]
                cut = [anchor - first for anchor, first, _ in at]
                left = [m["bytes"][:c][::-1] for m, c in zip(members, cut)]
                right = [m["bytes"][c:] for m, c in zip(members, cut)]
                for m, (anchor, first, last), spans in zip(
                        members, at, repeated_offsets(left, right, length)):
                    if m["copies"] > 1:
                        continue
                    for low, high in spans:
                        a, b = max(first, anchor - high), min(last, anchor - low)
                        if a <= b:
                            yield m["k1"], m["k2"], a, b

    return groups.mapInArrow(lambda b: batches_of(SPAN_NAMES, SPAN_KINDS, rows(b)), SPAN_TYPE)


def cut_finer(cells: DataFrame, level: int, length: int) -> DataFrame:
    """Members of oversize groups, dealt to the smaller cells of a level."""

    def rows(batches):
        for batch in batches:
            for m in batch.to_pylist():
                anchor, first, last = windows_at(m["place"])
                text, inner = m["bytes"], anchor - first       # the bytes start at the first window
                for cell in cells_of(inner, 0, last - first, level, length):
                    core, context = hashes(text, inner, cell, level, length)
                    a, b = cell[3], cell[4]
                    yield (core, context, m["copies"], m["k1"], m["k2"],
                           place_of(anchor, first + a, first + b), text[a:b + length])

    return cells.mapInArrow(lambda b: batches_of(CELL_NAMES, CELL_KINDS, rows(b)), CELL_TYPE)


def spans_of_place(frame: DataFrame) -> DataFrame:
    """All windows of each anchor as (k1, k2, first, last)."""
    anchor = F.shiftright("place", 32)
    return frame.select("k1", "k2",
                        (anchor - F.shiftright("place", 16).bitwiseAND(0xFFFF)).cast("int").alias("first"),
                        (anchor - F.col("place").bitwiseAND(0xFFFF)).cast("int").alias("last"))


def repeated_windows(texts: DataFrame, length: int, max_group: int) -> DataFrame:
    """(k1, k2, first, last): runs of windows of the text k1/k2 that occur elsewhere."""
    found = write_table(anchor_rows(texts, length), "anchors")
    cores = (found.groupBy("core")
             .agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
             .where("n > 1").select("core", (F.col("a") == F.col("b")).alias("whole")))
    # written first: a join of two plain tables can be split where a core is hot
    repeated = write_table(found.join(write_table(cores, "cores"), "core"), "repeated")
    spans = [spans_of_place(repeated.where("whole"))]

    # cores with several contexts: one member stands for each context
    mixed = repeated.where(~F.col("whole"))
    members = write_table(
        mixed.groupBy("core", "context")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("k1", "k2", "place")).alias("m"))
        .select("core", "context", "copies", "m.k1", "m.k2", "m.place"), "contexts")
    # the smaller side is measured: it is broadcast, or two plain tables meet, which a hot core can split
    copied = sized(members.where("copies > 1").select("core", "context")).frame
    spans.append(spans_of_place(mixed.join(copied, ["core", "context"], "left_semi")))

    cells = with_bytes(members, texts, length)
    level = 0
    while True:
        cells = write_table(cells, "cells")
        sizes = cells.groupBy("core").count()
        big = write_table(sizes.where(F.col("count") > max_group).select("core"), "big-groups")
        if big.isEmpty():
            spans.append(settle(cells, length))
            break
        spans.append(settle(cells.join(big, "core", "left_anti"), length))
        level += 1
        finer = write_table(cut_finer(cells.join(big, "core", "left_semi"), level, length), "finer")
        merged = (finer.groupBy("core", "context")
                  .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("members"),
                       F.min(F.struct("k1", "k2", "place", "bytes")).alias("m")))
        merged = write_table(merged, "merged")
        # contexts that became equal: every member's windows in the cell are repeats
        equal = sized(merged.where("members > 1").select("core", "context")).frame
        spans.append(spans_of_place(finer.join(equal, ["core", "context"], "left_semi")))
        cells = merged.select("core", "context", "copies", "m.k1", "m.k2", "m.place", "m.bytes")
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def union_of(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Runs of windows as maximal runs of bytes (from, to)."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 400, max_group: int = 256, keep_spans: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    ``keep_spans`` adds ``spans`` (array of from, to in bytes) and ``kept`` (binary).
    """
    ship(docs.sparkSession)
    if not 4 * GRAM <= length <= 1 << 15:
        raise ValueError("length must be from 32 to 32768 bytes")
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(TEXT),
                        F.col(f"`{id_col}`").alias(ID))
    # equal texts give equal runs, a set holds each once
    runs = write_table(repeated_windows(texts, length, max_group).groupBy("k1", "k2")
                       .agg(F.collect_set(F.struct("first", "last")).alias("runs")), "runs")
    joined = packed_texts(texts, True).join(runs, ["k1", "k2"], "left").select(ID, "z", "runs")
    kind = joined.schema[ID].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for z, runs in zip(batch.column(1), batch.column(2)):
                text = unpack(z.as_py())
                spans = union_of([(r["first"], r["last"]) for r in runs.as_py() or []], length)
                at, kept = 0, []
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                rest = b"".join([*kept, text[at:]])
                for column, value in zip(cols, (len(text), len(text) - len(rest), len(spans),
                                                hashlib.sha256(rest).hexdigest(),
                                                [{"from": a, "to": b} for a, b in spans], rest)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])), pa.binary()]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            n = 6 if keep_spans else 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, k) for v, k in zip(cols[:n], kinds))], [ID, *names[:n]])

    schema = f"{ID} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep_spans:
        schema += ", spans array<struct<from: long, to: long>>, kept binary"
    return joined.mapInArrow(run, schema).withColumnRenamed(ID, id_col)
