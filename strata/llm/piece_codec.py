"""SentencePiece encoding and decoding with a merge-type prefix table.

For a byte-pair vocabulary the encoding of every prefix of a text ends in exactly
one token, the only one among the vocabulary matches ending there that is
*compatible* with the last token of the prefix before it. So one pass over the
text stores each prefix's last token (matches come from an Aho-Corasick
automaton, compatibility from the merge trees of the two tokens), and the ids are
read backwards from the end. Time is linear in the text, whatever its length.

Two tokens are compatible when merging the text they cover leaves exactly these
two: going back in time over the last merges along the touching edges, no pair of
edge nodes that stood side by side would have merged before either was used up.

Text model of the vocabulary file: identity normalisation, a space in front, each
space as U+2581, characters without a piece as their UTF-8 bytes' pieces.

Defined results: a null or empty text is begin and end only, and decodes to the
empty text; ties and repeated rows are encoded each; an empty table gives an
empty result.

Scale: a map-only job. A Python worker keeps a bounded memo of encoded chunks (a
run of spaces and the word after it: no piece crosses into a following space).
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship, tokenizer_path, utf8

MEMO_ENTRIES = 600_000       # chunks a worker remembers; emptied when full
MEMO_CHARS = 48              # longer chunks are not remembered
PAIR_ENTRIES = 2_000_000     # remembered compatibility tests
MARK = "▁"
BROKEN = "�".encode()
CHUNK = re.compile(f"{MARK}+[^{MARK}\\n\\t]*|[^{MARK}\\n\\t]+|[\\n\\t]")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bos, self.eos = model.bos_id(), model.eos_id()
        size = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = [0] * 256
        self.id_byte: dict[int, int] = {}
        self.silent = {i for i in range(size) if model.is_control(i)}
        normal: dict[str, int] = {}
        for i, p in enumerate(self.piece):
            if model.is_byte(i):
                b = int(BYTE_PIECE.fullmatch(p)[1], 16)
                self.byte_id[b], self.id_byte[i] = i, b
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal[p] = i
        self.unknown = {i for i in range(size) if model.is_unknown(i)}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece crosses into a following space: chunks would not be independent")
        # order of merging: higher score first
        self.order = {i: -model.get_score(i) for i in normal.values()}
        self.normal = normal
        self.split: dict[int, tuple[int, int] | None] = {}
        self.pair: dict[int, int] = {}           # (left id, right id) -> merged id
        # a piece is a possible token only if merging its own text makes it
        automaton = ahocorasick.Automaton()
        for p, i in normal.items():
            root = self._merge(p)
            if root == [i]:
                automaton.add_word(p, (i, len(p)))
        automaton.make_automaton()
        self.automaton = automaton
        self.compatible: dict[int, bool] = {}
        self.memo = Memo(self)

    def _merge(self, text: str) -> list[int]:
        """Heap merging of one piece's own text (at most a few dozen characters); keeps
        the last merge of every piece that it makes."""
        normal, order = self.normal, self.order
        part = list(text)
        ids = [normal.get(c, -1) for c in part]
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(order[m], i, m) for i in range(n - 1)
                if (m := normal.get(part[i] + part[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, m = heappop(heap)
            j = after[i]
            if not part[i] or j >= n or part[i] + part[j] != self.piece[m]:
                continue
            self.split.setdefault(m, (ids[i], ids[j]))
            part[i], ids[i] = self.piece[m], m
            part[j] = ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := normal.get(part[i] + part[k])) is not None:
                    heappush(heap, (order[x], i, x))
            h = before[i]
            if h >= 0 and (x := normal.get(part[h] + part[i])) is not None:
                heappush(heap, (order[x], h, x))
        return [ids[i] for i in range(n) if part[i]]

    def _test(self, left: int, right: int) -> bool:
        """Do the two tokens stay as they are side by side?"""
        order, split, piece, normal = self.order, self.split, self.piece, self.normal
        used_left = used_right = float("inf")    # when each edge node is merged away
        while True:
            both = normal.get(piece[left] + piece[right])
            if both is not None:
                r = order[both]
                # at equal rank the leftmost pair goes first
                if r < used_left and r <= used_right:
                    return False
            a, b = split.get(left), split.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and order[left] > order[right]):
                used_left, left = order[left], a[1]
            else:
                used_right, right = order[right], b[0]

    def encode_chunk(self, text: str) -> list[int]:
        """Prefix table forwards, ids backwards; a negative id is a character without a piece."""
        n = len(text)
        last, width = [0] * (n + 1), [0] * (n + 1)
        known, test = self.compatible, self._test
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if width[end]:
                continue
            start = end - size
            if start:
                w = width[start]
                if w:
                    left = last[start]
                    key = left << 16 | token
                    ok = known.get(key)
                    if ok is None:
                        if len(known) >= PAIR_ENTRIES:
                            known.clear()
                        ok = known[key] = test(left, token)
                    if not ok:
                        continue
                # no width: a character without a piece ends there, nothing merges with it
            last[end], width[end] = token, size
        ids, end = [], n
        while end:
            if w := width[end]:
                ids.append(last[end])
                end -= w
            else:
                end -= 1
                ids += [self.byte_id[b] for b in reversed(text[end].encode())]
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text without begin and end."""
        return [i for c in self.chunks(text) for i in self.encode_chunk(c)]

    @staticmethod
    def chunks(text: str) -> list[str]:
        return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def raw(self, ids: list[int]) -> bytes:
        """Ids to bytes, with every U+2581 as a space; the caller drops the one in front."""
        out, pending = [], []
        for i in ids:
            b = self.id_byte.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(whole_characters(bytes(pending)))
                pending = []
            if i in self.unknown:
                out.append(" ⁇ ".encode())
            elif i not in self.silent:
                out.append(self.piece[i].replace(MARK, " ").encode())
        if pending:
            out.append(whole_characters(bytes(pending)))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids (begin and end stand for nothing)."""
        raw = self.raw(ids)
        first = next((i for i in ids if i not in self.silent), None)
        if first is not None and self.piece[first].startswith(MARK):
            raw = raw[1:]
        return raw.decode()


def whole_characters(raw: bytes) -> bytes:
    """UTF-8 as it is; each byte that belongs to no character becomes U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                raw[i:i + n].decode()
            except UnicodeDecodeError:
                continue
            out.append(raw[i:i + n])
            i += n
            break
        else:
            out.append(BROKEN)
            i += 1
    return b"".join(out)


class Memo(dict):
    """Chunk -> (ids as little-endian words, decoded bytes)."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, chunk: str) -> tuple[bytes, bytes]:
        ids = self.codec.encode_chunk(chunk)
        value = struct.pack(f"<{len(ids)}I", *ids), self.codec.raw(ids)
        if len(chunk) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[chunk] = value
        return value


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec for each worker process and vocabulary."""
    return PieceCodec(path)


def encode_row(c: PieceCodec, text: bytes) -> tuple[bytes, bytes]:
    """Ids of a whole text as little-endian words, begin and end included, and the
    bytes that decoding them gives."""
    parts = list(map(c.memo.__getitem__, c.chunks(text.decode("utf-8", "replace"))))
    ids = b"".join([struct.pack("<I", c.bos), *[p[0] for p in parts], struct.pack("<I", c.eos)])
    decoded = b"".join([p[1] for p in parts])
    return ids, decoded[1:] if parts else decoded     # without the space put in front


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  model: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and the ids themselves if asked).

    ``keep_ids`` adds ``ids`` (array of int, begin and end included) and ``decoded``.
    """
    ship(docs.sparkSession)
    path = model or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        c = codec(path)
        for batch in batches:
            count, digest, back, ids_out, text_out = [], [], [], [], []
            for text in utf8(batch.column(1)):
                ids, decoded = encode_row(c, text)
                count.append(len(ids) // 4)
                digest.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    ids_out.append(np.frombuffer(ids, "<i4"))
                    text_out.append(decoded.decode())
            arrays = [batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                      pa.array(back, pa.string())]
            names = [ID, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(F.col(f"`{id_col}`").alias(ID), F.col(f"`{text_col}`").alias(TEXT))
    kind = rows.schema[ID].dataType.simpleString()
    schema = f"{ID} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"
    return rows.mapInArrow(run, schema).withColumnRenamed(ID, id_col)
