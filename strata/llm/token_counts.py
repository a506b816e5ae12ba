"""Token counts by heap-and-linked-list byte-pair merging.

For each word the symbols form a linked list and every adjacent pair that the
merge table knows lies on a heap; the lowest-rank pair is merged again and again.
The count is the number of initial symbols minus the number of merges: no
identifiers leave the operator.

The split into words follows the vocabulary file: NFC, lower case character by
character, white space dropped, contractions / letter runs / single numbers /
other runs, bytes as symbols and an end-of-word mark on the last one. Strings of
the file's special tokens inside a text count as one token each, as the
library's default has it.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted each; very long texts and very long words are handled whole (a word of n
symbols costs n log n); an empty table gives an empty result.

Scale: a map-only job (no shuffle). A Python worker keeps a bounded memo of
white-space separated chunks, so memory does not grow with the corpus.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship, tokenizer_path, utf8, well_formed

MEMO_ENTRIES = 1 << 20       # chunks a worker remembers; emptied when full
MEMO_CHUNK_BYTES = 64        # longer chunks are not remembered

# White space of the vocabulary's own patterns (Unicode White_Space), fixed values.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    shifted = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + k) for k, b in enumerate(shifted)}


# Letters whose lower case is newer than Python's own tables, fixed values.
NEWER_LOWER = {0xA7CB: 0x264, 0xA7DC: 0x19B}


def lower_each(text: str) -> str:
    """Lower case without the word-final sigma rule (each character for itself)."""
    return text.replace("Σ", "σ").translate(NEWER_LOWER).lower()


class PairMerger:
    """Merge table of a byte-level vocabulary with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.rank.setdefault(vocab[a] << 20 | vocab[b], rank)
            self.made.append(vocab[a + b])
        names = byte_symbols()
        self.inner = [vocab[names[b]] for b in range(256)]
        self.final = [vocab[names[b] + suffix] for b in range(256)]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_bytes = [s.encode() for s in special]
        self.chunks = Memo(self)
        self.words: dict[str, int] = {}

    def tokens_of_word(self, word: str) -> int:
        """Symbols left after all merges of one word."""
        raw = word.encode()
        inner = self.inner
        ids = [inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        n = len(ids)
        rank, made = self.rank.get, self.made
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << 20 | ids[i + 1])) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            r, i = heappop(heap)
            a, j = ids[i], after[i]
            if a < 0 or j >= n or rank(a << 20 | ids[j]) != r:
                continue                       # one side was merged meanwhile
            ids[i] = new = made[r]
            ids[j] = -1
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (s := rank(new << 20 | ids[k])) is not None:
                    heappush(heap, (s, i))
            h = before[i]
            if h >= 0 and (s := rank(ids[h] << 20 | new)) is not None:
                heappush(heap, (s, h))
        return n - merges

    def tokens_of_chunk(self, chunk: bytes) -> int:
        """Tokens of a run without ASCII white space."""
        text = lower_each(unicodedata.normalize("NFC", chunk.decode()))
        words, total = self.words, 0
        for word in WORD.findall(text):
            n = words.get(word)
            if n is None:
                n = self.tokens_of_word(word)
                if len(word) <= MEMO_CHUNK_BYTES:
                    if len(words) >= MEMO_ENTRIES:
                        words.clear()
                    words[word] = n
            total += n
        return total

    def count(self, text: bytes) -> int:
        """Tokens of a whole text."""
        if any(s in text for s in self.special_bytes):
            parts = self.special.split(text.decode())
            return len(parts) - 1 + sum(self.count_plain(p.encode()) for p in parts)
        return self.count_plain(text)

    def count_plain(self, text: bytes) -> int:
        return sum(map(self.chunks.__getitem__, text.split()))


class Memo(dict):
    """Chunk -> tokens, filled on demand and emptied when it is full."""

    def __init__(self, merger: PairMerger):
        super().__init__()
        self.merger = merger

    def __missing__(self, chunk: bytes) -> int:
        n = self.merger.tokens_of_chunk(chunk)
        if len(chunk) <= MEMO_CHUNK_BYTES:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[chunk] = n
        return n


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    """One merge table for each worker process and vocabulary."""
    return PairMerger(path)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    ship(docs.sparkSession)
    path = vocabulary or tokenizer_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merger(path)
        for batch in batches:
            size, tokens = [], []
            for text in utf8(batch.column(1)):
                size.append(len(text))
                tokens.append(table.count(well_formed(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                [ID, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(f"`{id_col}`").alias(ID), F.col(f"`{text_col}`").alias(TEXT))
    kind = rows.schema[ID].dataType.simpleString()
    return (rows.mapInArrow(run, f"{ID} {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed(ID, id_col))
