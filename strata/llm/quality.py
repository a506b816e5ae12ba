"""Quality rules: line labelling by a linear-chain conditional random field.

A document is a sequence of lines, each content or boilerplate. Numeric features of a
line (symbols, capitals, repetition, sentence ends, ...) give label scores, a 2 x 2
table scores neighbouring labels, and Viterbi decoding finds the best labelling of the
whole sequence. A document is kept when content lines hold at least ``min_share`` of
its words, unless one of the plain rules (too few words, too many repeated word
windows) has failed it.

Training: maximum likelihood on a bounded sample, at most ``max_train`` labelled
documents of at most ``max_train_bytes`` bytes, drawn by a hash of id and text. Lines
have weak labels of their own: in a document of good quality a line is boilerplate if
it repeats an earlier line, has no letter, or is *common*, in at least ``common_texts``
different texts of the sample from as many sites (a text that shares most of its lines
is a copy: its lines are not counted for that), and content otherwise; all lines of a
document of bad quality are boilerplate. So sequences change labels inside, and the
pair table is learned from such changes. The common lines' hashes (at most as many as
the sample has lines) go with the weights as a feature. The sample is the only data that
reaches the driver. Without both labels in the sample all lines count as content.

Defined results: a null or empty text has no words and fails the plain rules; lines
without a word have no label and no weight; repeated rows are judged each; very long
texts are labelled whole (time linear in the lines); an empty table gives an
empty result.

Scale: judging is map-only; the weights (a few numbers) travel with the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import TEXT, fresh, ship, smallest, utf8

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
CONTINUATION = bytes(range(0x80, 0xC0))     # UTF-8 bytes that start no character
NO_LETTERS = bytes(set(range(256)) - set(LETTERS))
N_FEATURES = 14


def line_hash(words: list[bytes]) -> int:
    """A line's identity, whatever its white space."""
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little")


def line_features(words: list[bytes], seen: bool, common: frozenset[int] = frozenset()) -> list[float]:
    """Numbers between about 0 and 1 for one line with at least one word."""
    line = b" ".join(words)
    n, size = len(words), len(line) - len(words) + 1
    without = lambda drop: size - (len(line.translate(None, drop)) - n + 1)
    symbols, upper, letters, digits = map(without, (SYMBOLS, UPPER, LETTERS, DIGITS))
    marks = sum(w[-1:] in b"!#*$%&|<>" for w in words)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return [1.0, min(n, 50) / 50, letters / size, upper / max(1, letters), digits / size,
            min(1.0, 4 * symbols / size), float(line[-1:] in b".?!"), len(set(words)) / n,
            float(seen), min(1.0, size / n / 20), marks / n, repeats / n, float(not letters),
            float(bool(common) and line_hash(words) in common)]


def lines_with_words(text: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """Words of each line that has one, and whether an equal line came before."""
    seen = set()
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            yield words, line in seen
            seen.add(line)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    import numpy as np

    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    vocabulary = len(ids)
    key = w[:n - window + 1]
    for k in range(1, window):
        # number the windows of k words anew, so that keys stay below n * vocabulary
        key = np.unique(key * vocabulary + w[k:n - window + 1 + k], return_inverse=True)[1]
    often = np.bincount(key)[key] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k:n - window + 1 + k] |= often
    return int(covered.sum())


@dataclass(frozen=True)
class LineField:
    """Weights of the field: features to content score, and the label pair scores."""

    weights: tuple[float, ...]
    pairs: tuple[float, float, float, float]      # bb, bc, cb, cc
    common: frozenset[int] = frozenset()          # hashes of lines that many texts of the sample have

    def label_lines(self, text: bytes) -> tuple[list[int], list[bool]]:
        """Words of each line that has one, and whether Viterbi decoding calls it content."""
        import numpy as np

        sizes, rows = [], []
        for words, seen in lines_with_words(text):
            sizes.append(len(words))
            rows.append(line_features(words, seen, self.common))
        if not rows:
            return [], []
        scores = (np.array(rows) @ np.array(self.weights)).tolist()
        bb, bc, cb, cc = self.pairs
        b, c, back = 0.0, scores[0], []
        for s in scores[1:]:
            from_b, from_c = b + bb >= c + cb, b + bc >= c + cc
            back.append((from_b, from_c))
            b, c = max(b + bb, c + cb), max(b + bc, c + cc) + s
        labels = [c >= b]
        for from_b, from_c in reversed(back):
            labels.append(not (from_c if labels[-1] else from_b))
        return sizes, labels[::-1]

    def content_share(self, text: bytes) -> float:
        """Share of the words that are in content lines."""
        sizes, labels = self.label_lines(text)
        return sum(n for n, content in zip(sizes, labels) if content) / sum(sizes) if sizes else 0.0


ALL_CONTENT = LineField((1.0, *(0.0,) * (N_FEATURES - 1)), (0.0, 0.0, 0.0, 0.0))


def common_lines(sample: list[tuple[bytes, object, int]], common_texts: int) -> frozenset[int]:
    """Hashes of the lines in at least ``common_texts`` different texts and sites of the sample."""
    texts = {text: site for text, site, _ in sample}
    lines = {text: {line_hash(w) for w, _ in lines_with_words(text)} for text in texts}
    where: dict[int, set[bytes]] = {}
    for text, hashes in lines.items():
        for h in hashes:
            where.setdefault(h, set()).add(text)
    shared = {h for h, of in where.items() if len(of) >= common_texts}
    # a text that mostly shares its lines is a copy of others: it says nothing about them
    copies = {text for text, hashes in lines.items() if 2 * len(hashes & shared) > len(hashes)}
    return frozenset(h for h in shared if len(of := where[h] - copies) >= common_texts
                     and len({texts[text] for text in of}) >= common_texts)


def weak_labels(text: bytes, quality: int, common: frozenset[int]) -> tuple[list[list[float]], list[int]]:
    """Features and labels (1 content) of a sample text's lines."""
    rows, labels = [], []
    for words, seen in lines_with_words(text):
        rows.append(line_features(words, seen, common))
        extra = seen or line_hash(words) in common or not b"".join(words).translate(None, NO_LETTERS)
        labels.append(int(quality == 1 and not extra))
    return rows, labels


def fit(sequences: list[tuple[list[list[float]], list[int], int]], common: frozenset[int] = frozenset(),
        steps: int = 150, decay: float = 1e-5) -> LineField:
    """Maximum likelihood weights of sequences (lines' features, lines' labels, document's label):
    forward-backward over padded sequences, Adam steps."""
    import numpy as np

    if {y for _, _, y in sequences} != {0, 1}:
        return ALL_CONTENT
    sequences = sorted(sequences, key=lambda s: len(s[0]))
    lengths = np.array([len(s[0]) for s in sequences])
    m, t = len(sequences), int(lengths.max())
    x = np.zeros((t, m, N_FEATURES))
    truth = np.zeros((t, m))
    same = np.zeros((m, 2, 2))                 # a sequence's neighbouring labels, counted
    for k, (rows, labels, _) in enumerate(sequences):
        x[:len(rows), k] = rows
        truth[:len(rows), k] = labels
        np.add.at(same[k], (labels[:-1], labels[1:]), 1)
    y = np.array([s[2] for s in sequences], float)
    on = np.arange(t)[:, None] < lengths[None, :]
    # each class has half of the total weight, each document the same within it
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) / lengths
    theta = np.zeros(N_FEATURES + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        unary = np.zeros((t, m, 2))
        unary[:, :, 1] = x @ theta[:N_FEATURES]
        pair = theta[N_FEATURES:].reshape(2, 2)
        ahead, back = np.zeros((t, m, 2)), np.zeros((t, m, 2))
        ahead[0] = unary[0]
        for i in range(1, t):
            new = np.logaddexp(ahead[i - 1][:, :1] + pair[0], ahead[i - 1][:, 1:] + pair[1]) + unary[i]
            ahead[i] = np.where(on[i][:, None], new, ahead[i - 1])
        for i in range(t - 2, -1, -1):
            nxt = unary[i + 1] + back[i + 1]
            new = np.logaddexp(pair[:, 0] + nxt[:, :1], pair[:, 1] + nxt[:, 1:])
            back[i] = np.where(on[i + 1][:, None], new, 0)
        log_z = np.logaddexp(ahead[-1][:, 0], ahead[-1][:, 1])
        content = np.exp(ahead[:, :, 1] + back[:, :, 1] - log_z) * on
        gap = (truth - content) * weight
        grad = np.zeros_like(theta)
        grad[:N_FEATURES] = np.einsum("tm,tmf->f", gap, x)
        if t > 1:
            joint = (ahead[:-1, :, :, None] + pair + (unary[1:] + back[1:])[:, :, None, :]
                     - log_z[None, :, None, None])
            expected = np.exp(joint) * on[1:, :, None, None]
            grad[N_FEATURES:] = (weight @ same.reshape(m, 4)
                                 - np.einsum("tmab,m->ab", expected, weight).ravel())
        grad -= decay * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta += 0.3 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    return LineField(tuple(theta[:N_FEATURES].tolist()), tuple(theta[N_FEATURES:].tolist()), common)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", site_col: str = "source", max_train: int = 2000,
          max_train_bytes: int = 16_384, common_texts: int = 3) -> LineField:
    """Fit the field on a bounded sample of the labelled documents."""
    ship(docs.sparkSession)
    # a bounded draw of ids first (so only they are broadcast), then of their rows
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where("id is not null and y in (0, 1)"))
    drawn = smallest(known, ["id", "y"], 2 * max_train)
    site = F.col(f"`{site_col}`") if site_col in docs.columns else F.col(f"`{id_col}`")
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias(TEXT),
                        site.cast("string").alias("site"))
            .where(F.octet_length(TEXT).between(1, max_train_bytes))
            .join(F.broadcast(drawn), "id")
            .orderBy(F.xxhash64("id", TEXT), "y", "site").limit(max_train)
            .select(F.col(TEXT).cast("binary"), "site", "y"))
    sample = [(bytes(text), site, y) for text, site, y in rows.toLocalIterator()]
    common = common_lines(sample, common_texts)
    sequences = [(*weak_labels(text, y, common), y) for text, _, y in sample]
    return fit([s for s in sequences if s[0]], common)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean")


def judge_text(field: LineField, text: bytes, min_share: float) -> tuple:
    """The values of COLUMNS for one text."""
    words = text.split()               # white space is 20 and 09-0D, as bytes
    n = len(words)
    joined = b"".join(words)
    chars = len(joined.translate(None, CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    duplicates = sum(seen for _, seen in lines_with_words(text))
    repeats = repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    kept = not failed and field.content_share(text) >= min_share
    return n, chars, symbols, duplicates, repeats, failed, kept


def judge(docs: DataFrame, field: LineField, text_col: str = "text", min_share: float = 0.5,
          into: str = "__quality") -> DataFrame:
    """``docs`` with a struct column of the counts, base_failed and kept."""
    ship(docs.sparkSession)

    @F.arrow_udf(f"struct<{SCHEMA.replace(' ', ': ').replace(',: ', ', ')}>")
    def verdict(text: pa.Array) -> pa.Array:
        rows = [judge_text(field, t, min_share) for t in utf8(text)]
        columns = list(zip(*rows)) if rows else [[] for _ in COLUMNS]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(COLUMNS))

    return docs.withColumn(into, verdict(F.col(f"`{text_col}`").cast("string")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_share: float = 0.5, **training) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    field = train(docs, labels, id_col, text_col, **training)
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias(TEXT))
    return judge(rows, field, TEXT, min_share).select(F.col(f"`{id_col}`"), "__quality.*")


def keep_stage(docs: DataFrame, labels: DataFrame, text_col: str = "text", min_share: float = 0.5,
               **training) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    field = train(docs, labels, text_col=text_col, **training)
    into, = fresh(docs, "__quality")
    return judge(docs, field, text_col, min_share, into).where(F.col(into)["kept"]).drop(into)
