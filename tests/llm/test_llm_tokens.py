import hashlib
import random
import struct

import pytest
import public_tokenizers as P

from strata.llm import piece_codec, token_counts

import cases


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


POOL = [" ", "  ", "\n", "\t", "a", "e", "th", "the", "ing", "▁", "é", "1", "23", ".", "...", "İ", "ß", "Σ",
        "ΑΣ", "文字", "🙂", "👨‍👩", "\u0301", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "ﬁ", "'s", "'RE", "n't",
        "<|endoftext|>", "<s>", "<0x0A>", "</s>", "<|", "한", "½", "A", "Z", "\ua7cb"]


def random_texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        text = "".join(rng.choice(POOL) for _ in range(rng.randint(0, 16)))
        yield " " * rng.randint(0, 40) + text if rng.random() < 0.2 else text


def test_counts_equal_the_library_on_random_texts(bpe):
    merger = token_counts.merger(P.path("word_bpe_49k.json"))
    for text in random_texts(4000, 1):
        assert merger.count(text.encode()) == len(bpe.encode(text, add_special_tokens=False).ids), repr(text)


def test_ids_and_decoding_equal_the_library_on_random_texts(pieces):
    codec = piece_codec.codec(P.path("piece_bpe_32k.model"))
    for text in random_texts(4000, 2):
        assert codec.encode(text) == pieces.encode(text), repr(text)
        ids = [1, *pieces.encode(text), 2]
        assert codec.decode(ids) == pieces.decode(ids), repr(text)


def test_decoding_of_any_ids(pieces):
    rng = random.Random(3)
    codec = piece_codec.codec(P.path("piece_bpe_32k.model"))
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(1, 300), rng.randrange(1, 32000)]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids) == pieces.decode(ids), ids


def test_every_chunk_of_spaces(pieces):
    codec = piece_codec.codec(P.path("piece_bpe_32k.model"))
    for n in range(80):
        for tail in ("", "a", "\n", "the"):
            assert codec.encode(" " * n + tail) == pieces.encode(" " * n + tail)


def test_count_table(spark, bpe):
    docs = cases.documents(spark)
    got = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(docs, limit=100).collect()}
    rows = docs.collect()
    assert len(token_counts.count_tokens(docs).collect()) == len(rows)
    for r in rows:
        text = r.text or ""
        mine = got[r.doc_id, len(text.encode())]
        n = len(bpe.encode(text, add_special_tokens=False).ids)
        assert (mine.n_tokens, mine.over_limit) == (n, n > 100)
    assert token_counts.count_tokens(cases.empty(spark)).collect() == []


def test_codec_table(spark, pieces):
    docs = cases.documents(spark)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id or -1, r.text or ""))
    out = piece_codec.encode_decode(docs, keep_ids=True).collect()
    assert len(out) == len(rows)
    expected = sorted((str(r.doc_id), [1, *pieces.encode(r.text or ""), 2]) for r in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in out) == expected
    for r in out:
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()
        assert r.decoded == pieces.decode(list(r.ids)) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert piece_codec.encode_decode(cases.empty(spark)).collect() == []


def test_long_word_is_linear_enough():
    merger = token_counts.merger(P.path("word_bpe_49k.json"))
    codec = piece_codec.codec(P.path("piece_bpe_32k.model"))
    assert merger.count(b"ab" * 50_000) > 0
    assert codec.decode([1, *codec.encode("ab" * 50_000)]) == "ab" * 50_000


def test_bytes_that_are_no_utf8(spark, bpe, pieces):
    docs = cases.not_utf8(spark)
    read = cases.as_read(spark)
    counts = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs).collect()}
    assert counts == {1: (1, len(bpe.encode(read[1]).ids)), 2: (6, len(bpe.encode(read[2]).ids)),
                      3: (6, len(bpe.encode(read[3]).ids)), 4: (2, len(bpe.encode(read[4]).ids))}
    coded = {r.doc_id: r.ids_sha256 for r in piece_codec.encode_decode(docs).collect()}
    for i, text in read.items():
        ids = [1, *pieces.encode(text), 2]
        assert coded[i] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
