"""Periodic runs of words in a text, by online dyadic square catching.

A *run* is a stretch of words in which words ``q`` apart are identical, ``q`` being the smallest
such period, at least ``min_exponent`` periods and ``min_length`` words long, that no neighbouring
word extends.

1. **Catchers.** Words are appended to a ``SquareCatcher``. On level k every completed, aligned
   block of m = 2^k words has a catcher: it watches the words that come later for its next
   occurrence at a distance p that is the level's to catch. A run of ``e`` periods p has an aligned
   block of m words with its copy p words on if 2m <= (e - 1) p + 1, so each period belongs to
   one level (the largest m that holds), and no run is lost. Occurrences are found by a hash that
   doubles with the level and are verified word by word.
2. **Suffix comparisons.** A caught occurrence is a square's core: it is compared backwards from
   the block, and forwards up to the last word appended. If the comparison reaches that word it
   stays open, and each appended word goes on with it.
3. **Merging.** Occurrences inside a run that is known with the same period merge into it. Runs of
   the same stretch keep the smallest period.

Words may be appended one by one or in blocks: the result is the same. All levels together hold
a number of hashes linear in the words so far, and do O(n log n) work, in NumPy.

Defined results: a null or empty text, or one of white space only, has no word and no run;
repeated rows give equal results; ties for the longest run go to the smallest start, then period;
a very long text is one task's work, its words as numbers (four bytes each) and every distinct
word once; texts are bytes, so any bytes are allowed in words; a null id has no planted period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship, utf8

MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)     # odd multipliers of the block hash
SLAB = 1 << 20          # comparisons done at once: bounds a task's arrays
SPARSE = 3              # level at which a text is looked through for equal windows at all
APPEND = 1 << 16        # words appended at once
PIECE = 1 << 20         # bytes of a text split into words at once
SPACES = b" \t\n\x0b\x0c\r"


class SquareCatcher:
    """Catches the runs of a growing sequence of integers."""

    def __init__(self, min_exponent: int = 4, min_length: int = 6):
        import numpy as np

        if min_exponent < 2:
            raise ValueError("a run has at least two periods")
        self.np, self.exponent, self.length = np, min_exponent, min_length
        self.words = np.empty(0, np.int64)
        self.size = 0
        self.levels: list[tuple[int, object]] = []           # per level: first kept start, hashes from it on
        self.latest: dict[int, list[int]] = {}                # period -> [start, end] of its latest run
        self.found: set[tuple[int, int, int]] = set()         # (start, end, period)

    def periods(self, level: int) -> tuple[int, int]:
        """The periods p (from, below) whose largest block with 2m <= (e - 1) p + 1 is 2^level."""
        m, e = 1 << level, self.exponent - 1
        return max(1, -(-(2 * m - 1) // e)), max(1, -(-(4 * m - 1) // e))

    def append(self, words, last: bool = False) -> None:
        """Take the next words; open comparisons go on, new squares are caught. ``last`` says that
        no words follow: then levels above one without equal windows need not be looked at."""
        np = self.np
        old, self.size = self.size, self.size + len(words)
        if self.size > len(self.words):
            grown = np.empty(max(self.size, 2 * len(self.words) if old else 0), np.int64)
            grown[:old] = self.words[:old]
            self.words = grown
        self.words[old:self.size] = words
        for period, run in self.latest.items():
            if run[1] == old:
                run[1] += self.agree(old - period, old)
        level = 0
        while 1 << level <= self.size:
            first, hashed, done = self.hashes(level)
            if last and level == SPARSE and len(np.unique(hashed)) == len(hashed):
                break
            self.advance(level, first, hashed, done)
            level += 1
        for level, (first, hashed) in enumerate([] if last else self.levels):
            # what later windows of this level or the next can still ask for
            keep = self.size - (1 << level) - max(1 << level, self.periods(level)[1])
            if keep > first:
                self.levels[level] = (keep, hashed[keep - first:].copy())

    def hashes(self, level: int):
        """Hashes of the windows of 2^level words up to the newest: the first start that is kept,
        the hashes, and the start of the first new one."""
        np, m = self.np, 1 << level
        if level == len(self.levels):
            self.levels.append((0, np.empty(0, np.uint64)))
        first, kept = self.levels[level]
        done = first + len(kept)                       # windows that have their hash
        if level == 0:
            new = self.words[done:self.size].astype(np.uint64) + np.uint64(1)
            new *= np.uint64(MIX[0])
        else:
            at, half = self.levels[level - 1]
            end = self.size - m + 1
            new = half[done - at:end - at] * np.uint64(MIX[0])
            new += half[done - at + m // 2:end - at + m // 2] * np.uint64(MIX[1])
        new ^= new >> np.uint64(31)
        kept = np.concatenate((kept, new)) if len(kept) else new
        self.levels[level] = (first, kept)
        return first, kept, done

    def advance(self, level: int, first: int, hashed, done: int) -> None:
        """The level's catchers see the windows from ``done`` on, which the appended words complete."""
        np, m = self.np, 1 << level
        low, high = self.periods(level)
        end = first + len(hashed)                      # windows start below this
        # blocks whose watched distances meet the new windows
        from_block = max(0, -(-(done - high + 1) // m) * m)
        if low >= high or from_block + low >= end:
            return
        blocks = np.arange(from_block, end - low, m)
        step = max(1, SLAB // (high - low))
        for i in range(0, len(blocks), step):
            some = blocks[i:i + step]
            ahead = np.arange(low, high)
            starts = some[:, None] + ahead
            # the last blocks' copies may not be there yet: they are compared with themselves, and left out
            equal = hashed[np.minimum(starts, end - 1) - first] == hashed[some - first][:, None]
            if not equal.any():
                continue
            equal &= (starts >= done) & (starts < end)
            at, p = np.nonzero(equal)
            self.catch_all(some[at], ahead[p], m)

    def catch_all(self, blocks, periods, m: int) -> None:
        """Occurrences (block, distance) in order of blocks: each merges into a known run or makes
        a new one."""
        np = self.np
        left = np.ones(len(blocks), bool)

        def merge(start: int, end: int, period: int) -> None:
            # one at a multiple of the period inside a run is the run itself: a stretch of that
            # length has no longer run of the multiple around it
            a, b = np.searchsorted(blocks, (start, end - m))
            left[a:b] &= (blocks[a:b] + periods[a:b] + m > end) | (periods[a:b] % period != 0)

        for period, (start, end) in self.latest.items():
            if start + m < end:
                merge(start, end, period)
        for i, (block, period) in enumerate(zip(blocks.tolist(), periods.tolist())):
            if left[i]:
                run = self.catch(block, period, m)
                if run:
                    merge(*run, period)

    def catch(self, block: int, period: int, m: int) -> tuple[int, int] | None:
        """The run around an occurrence; None where equal hashes are of different words."""
        ahead = self.agree(block, block + period)
        if ahead < m:
            return None
        behind = self.agree_back(block, block + period)
        if period in self.latest:
            self.report(period, self.latest[period])
        self.latest[period] = [block - behind, block + period + ahead]
        return block - behind, block + period + ahead

    def agree(self, a: int, b: int) -> int:
        """How many words from ``a`` on equal those from ``b`` on (a < b), up to the newest."""
        np, step, n = self.np, 32, 0
        while b + n < self.size:
            stop = min(self.size, b + n + step)
            same = self.words[a + n:a + stop - b] == self.words[b + n:stop]
            k = int(np.argmin(same))
            if not same[k]:
                return n + k
            n, step = stop - b, step * 2
        return n

    def agree_back(self, a: int, b: int) -> int:
        """How many words before ``a`` equal those before ``b``, backwards."""
        np, step, n = self.np, 32, 0
        while a - n > 0:
            take = min(step, a - n)
            same = (self.words[a - n - take:a - n] == self.words[b - n - take:b - n])[::-1]
            k = int(np.argmin(same))
            if not same[k]:
                return n + k
            n, step = n + take, step * 2
        return n

    def report(self, period: int, run: list[int]) -> None:
        if run[1] - run[0] >= max(self.length, self.exponent * period):
            self.found.add((run[0], run[1], period))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs in the words so far, by start, then period."""
        for period, run in self.latest.items():
            self.report(period, run)
        smallest: dict[tuple[int, int], int] = {}
        for start, end, period in self.found:
            smallest[start, end] = min(period, smallest.get((start, end), period))
        # a run that was open has been reported shorter, too: the longest of a start and period stands
        longest: dict[tuple[int, int], int] = {}
        for (start, end), period in smallest.items():
            longest[start, period] = max(end, longest.get((start, period), 0))
        return sorted((start, end - start, period) for (start, period), end in longest.items())


def periodic_runs(words, min_exponent: int = 4, min_length: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of an array of integers."""
    if len(words) < max(min_length, min_exponent):
        return []
    catcher = SquareCatcher(min_exponent, min_length)
    for i in range(0, len(words), APPEND):
        catcher.append(words[i:i + APPEND], last=i + APPEND >= len(words))
    return catcher.runs()


def number_words(text: bytes):
    """The words of a text as numbers, and the distinct words by number."""
    import numpy as np

    known: dict[bytes, int] = {}
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end] not in SPACES:       # a piece ends between words
            end += 1
        words = (text[at:end] if at or end < len(text) else text).split()
        out.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
        at = end
    return (np.concatenate(out) if out else np.empty(0, np.int64)), list(known)


def plant_period(words, crc: int):
    """The words with a period made of their own, where the checksum of the document's id asks for it."""
    import numpy as np

    n, g = len(words), crc // 10
    if crc % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((words[:a], words[a + np.arange(n - a) % p]))


def collapsed(words, runs: list[tuple[int, int, int]]):
    """The words without those that a run repeats: of each run the first period stays,
    unless another run drops it."""
    import numpy as np

    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return words[np.cumsum(change[:-1]) == 0]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = 4,
              min_length: int = 6, plant: bool = False, keep_runs: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run and digests, for every row of ``docs``.

    ``plant`` first plants a period in a tenth of the texts, chosen by the checksum of the id (so
    that a corpus without runs can test the operator). ``keep_runs`` adds ``runs`` (array of start,
    length, period) and ``collapsed`` (the text with each run cut to its first period).
    """
    ship(docs.sparkSession)
    fields = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    if keep_runs:
        fields += ["runs", "collapsed"]
        kinds += [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.binary()]

    def row(crc: int | None, text: bytes) -> tuple:
        words, names = number_words(text)
        if plant and crc is not None:
            words = plant_period(words, crc)
        runs = periodic_runs(words, min_exponent, min_length)
        rest = collapsed(words, runs) if runs else words
        digest = hashlib.sha256()
        parts = []
        for i in range(0, len(rest), APPEND):
            part = b" " * bool(i) + b" ".join([names[k] for k in rest[i:i + APPEND].tolist()])
            digest.update(part)
            if keep_runs:
                parts.append(part)
        listed = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode())
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        out = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
               listed.hexdigest(), digest.hexdigest())
        if keep_runs:
            out += ([dict(zip(("start", "length", "period"), r)) for r in runs], b"".join(parts))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = [None if d is None else zlib.crc32(d) for d in batch.column(1).cast(pa.binary()).to_pylist()]
            rows = [row(c, t) for c, t in zip(crcs, utf8(batch.column(2)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * len(kinds), kinds))],
                [ID, *fields])

    rows = docs.select(F.col(f"`{id_col}`").alias(ID), F.col(f"`{id_col}`").cast("string").alias("__id_text"),
                       F.col(f"`{text_col}`").cast("string").alias(TEXT))
    kind = rows.schema[ID].dataType.simpleString()
    schema = (f"{ID} {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")
    if keep_runs:
        schema += ", runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return rows.mapInArrow(run, schema).withColumnRenamed(ID, id_col)
