"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

* Examples: a bounded draw of labelled rows, at most ``max_per_class`` of each label,
  never from held-out rows (CRC-32 of the id as text divisible by ``fold``).
* Terms: all words and their beginnings (4 to 6 characters). Document frequencies of
  all terms are counted over all documents. A term weighs more the more the examples'
  labels depend on it (chi-square); none is left out.
* Index: for each term of the examples a posting list over blocks of examples. The terms of
  most examples (``OFTEN`` of them) are stored as plain rows of each block as well, with the
  largest weight of the term there (block-max). A query adds up its other terms' postings,
  and on top of the largest such sum of a block the maxima of the frequent terms: the
  block's bound. It visits blocks from the largest bound down, adding the frequent terms'
  weights, and leaves those whose bound does not beat the k-th best. The k nearest are
  exact. Texts go through the index some at a time, so that array operations do the work.
* Norm: of the whole text. Terms that no example has do not change which examples are
  nearest, only the cosines: their share of the norm is summed by text and joined.
* Score: votes of the k nearest weighted by cosine, corrected for the draw's label
  shares, drawn towards the label rate, then calibrated by a logistic curve fitted on the
  examples themselves, each scored by the others. Ids and cosines of the neighbours
  are the evidence. An example never votes on its own text.

Defined results: a null or empty text, or one without a term of any example, has no
neighbours and gets the calibrated label rate; ties in cosine go to the earlier example;
repeated rows score alike; very long texts are read whole; an empty table gives
an empty result; without examples of both labels all scores are the label rate
(0 if there are none).

Scale: two passes over the texts (document frequencies, then neighbours). The index is
broadcast; its bound is 2 * max_per_class examples of at most max_bytes bytes. Only
terms that no example has are shuffled, and a row of neighbours for each document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, key_columns, ship, smallest, utf8, write_table
from strata.operators.joins import sized

BLOCK = 64                   # examples of a block
FIRST = 2                    # blocks that a query visits before it compares bounds with its k-th best
OFTEN = 1024                 # terms whose weights are rows: OFTEN * examples doubles in each worker
QUERIES = 64                 # texts that go through the index together,
POSTINGS = 1 << 22           # and what they add up there (some 50 bytes each)
PIECE_ROWS = 4096            # texts that are split into terms together,
PIECE_BYTES = 4 << 20        # and their bytes
EDGES = ".,;:!?\"'()[]{}<>#*$%&|-_"
UNIT = 1 << 24               # squared weights are summed as whole parts of 1/UNIT, in any order alike
PULL = 0.05                  # votes that the label rate has
BROADCAST_BYTES = 16 << 20   # frequencies and norms are broadcast below this measured size


def bare(word: bytes) -> str:
    """A white-space separated word as a term (may be empty)."""
    return word.decode("utf-8", "replace").lower().strip(EDGES)


def bare_words(words: pa.Array) -> pa.Array:
    """``bare`` of an Arrow array, which does ASCII words itself."""
    import pyarrow.compute as pc

    plain = pc.ascii_trim(pc.ascii_lower(words), characters=EDGES)
    other = pc.invert(pc.string_is_ascii(words))
    return pc.replace_with_mask(plain, other, pa.array([bare(w) for w in utf8(words.filter(other))], plain.type))


def groups(sizes, rows: int, total: int) -> Iterator[tuple[int, int]]:
    """Start and stop of runs of at most so many places and of such a total size (a larger place is one alone)."""
    import numpy as np

    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + total, "right"))))
        yield start, stop
        start = stop


def pieces(column: pa.Array) -> Iterator[pa.Array]:
    """An Arrow string column in pieces of few rows and bytes; null is empty."""
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.fill_null(column, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    for start, stop in groups(sizes, PIECE_ROWS, PIECE_BYTES):
        yield texts.slice(start, stop - start).cast(pa.string())


def word_terms(words: pa.Array) -> tuple[pa.DictionaryArray, object]:
    """The terms of distinct words one below the other (the word, its beginnings), and the word of each."""
    import numpy as np
    import pyarrow.compute as pc

    bare = bare_words(words)
    sizes = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    terms, places = [], []
    for n in (0, 4, 5, 6):
        at = np.flatnonzero(sizes > n)
        some = bare.take(pa.array(at))
        mark, none = pa.scalar("^", some.type), pa.scalar("", some.type)
        terms.append(pc.binary_join_element_wise(mark, pc.utf8_slice_codeunits(some, 0, n), none) if n else some)
        places.append(at)
    return pa.concat_arrays(terms).dictionary_encode(), np.concatenate(places)


def term_counts(texts: pa.Array, vocabulary: pa.Array, others: bool):
    """Place of the text, term and its occurrences there, for each term of each text, in this order;
    terms beyond the vocabulary (``others``) are numbered after it, and these are their names."""
    import numpy as np
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(texts)
    coded = pc.list_flatten(split).dictionary_encode()
    terms, word = word_terms(coded.dictionary)
    number = pc.fill_null(pc.index_in(terms.dictionary, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    names = terms.dictionary.filter(pa.array(number < 0))
    if others:
        number[number < 0] = len(vocabulary) + np.arange(len(names))
    term = number[terms.indices.to_numpy()]
    word, term = word[term >= 0], term[term >= 0]
    order = np.argsort(word, kind="stable")
    term, cuts = term[order], np.searchsorted(word[order], np.arange(len(coded.dictionary) + 1))
    codes = coded.indices.to_numpy()
    at, each = spans(cuts[codes], cuts[codes + 1])
    width = len(vocabulary) + len(names) + 1
    place = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    keys = np.repeat(place * width, each) + term[at]
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    place, term = np.divmod(keys[first], width)
    return place, term, np.diff(first, append=len(keys)), names


def tf_weights(times):
    """1 + ln(occurrences): the same double for the same number, whatever stands beside it."""
    import numpy as np

    table = np.array([0.0, *(1 + math.log(i) for i in range(1, 1024))])
    out = table[np.minimum(times, len(table) - 1)]
    for i in np.flatnonzero(times >= len(table)):
        out[i] = 1 + math.log(times[i])
    return out


def term_boosts(texts: list[bytes], labels: list[int]) -> dict[str, float]:
    """All terms of the examples with their factors: 1 + ln(1 + chi-square of presence and label)."""
    import numpy as np

    n1 = sum(labels)
    n0 = len(labels) - n1
    present, toxic, done = Counter(), Counter(), 0
    for piece in pieces(pa.array(texts, pa.binary()).view(pa.string())):
        place, term, _, names = term_counts(piece, pa.array([], pa.string()), True)
        marked = term[np.array(labels[done:done + len(piece)])[place] == 1]
        names = names.to_pylist()
        present.update(dict(zip(names, np.bincount(term, minlength=len(names)).tolist())))
        toxic.update(dict(zip(names, np.bincount(marked, minlength=len(names)).tolist())))
        done += len(piece)
    n, out = n0 + n1, {}
    for term, df in sorted(present.items()):
        a, b = toxic[term], df - toxic[term]
        bottom = df * (n - df) * n1 * n0
        out[term] = 1 + math.log1p(n * (a * (n0 - b) - b * (n1 - a)) ** 2 / bottom if bottom else 0.0)
    return out


def spans(starts, ends):
    """The places of all spans, one span after the other, and the length of each."""
    import numpy as np

    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


@dataclass
class BlockMaxIndex:
    """Inverted index of unit vectors; for the most frequent terms their weights in each block as
    rows, and the largest of them (made where they are first used).
    """

    starts: object           # (terms + 1) first posting of each term
    places: object           # example of each posting
    weights: object          # its weight
    n: int
    columns: object          # of each term: its column in the rows of frequent terms, or -1
    rows: object = None      # (examples, rounded up to blocks) x (frequent terms): weights
    maxima: object = None    # (frequent terms) x (blocks): the largest of them

    def __getstate__(self):
        return self.__dict__ | {"rows": None, "maxima": None}

    @staticmethod
    def build(vectors: Iterable[dict[int, float]], terms: int) -> BlockMaxIndex:
        import numpy as np

        return BlockMaxIndex.of([(np.fromiter(v, np.int64, len(v)), np.fromiter(v.values(), float, len(v)))
                                 for v in vectors], terms)

    @staticmethod
    def of(parts: list[tuple], terms: int) -> BlockMaxIndex:
        """``build`` of vectors given as two arrays."""
        import numpy as np

        term = np.concatenate([t for t, _ in parts])
        place = np.repeat(np.arange(len(parts), dtype=np.int32), [len(t) for t, _ in parts])
        order = np.lexsort((place, term))
        weight = np.concatenate([w for _, w in parts])[order]
        starts = np.searchsorted(term[order], np.arange(terms + 1))
        sizes = np.diff(starts)
        often = np.sort(np.argsort(-sizes, kind="stable")[:OFTEN])
        columns = np.full(terms, -1, np.int32)
        columns[often] = np.arange(len(often))
        return BlockMaxIndex(starts, place[order], weight, len(parts), columns)

    def postings(self, term):
        """How many postings a query adds up for each of some terms."""
        return (self.starts[term + 1] - self.starts[term]) * (self.columns[term] < 0)

    def prepare(self) -> None:
        """Rows and maxima of the frequent terms, from their postings."""
        import numpy as np

        often = np.flatnonzero(self.columns >= 0)
        at, sizes = spans(self.starts[often], self.starts[often + 1])
        rows = np.zeros((-(-self.n // BLOCK) * BLOCK, len(often)))
        rows[self.places[at], np.repeat(np.arange(len(often)), sizes)] = self.weights[at]
        self.maxima = np.ascontiguousarray(rows.reshape(-1, BLOCK, len(often)).max(1).T)
        self.rows = rows

    def nearest(self, query: dict[int, float], k: int, skip=()) -> list[tuple[float, int]]:
        """The k examples of largest product over zero, exact: (product, example)."""
        import numpy as np

        terms = np.array(sorted(query), np.int64)
        factors = np.array([query[t] for t in terms.tolist()], float)
        return self.best(np.zeros(len(terms), np.int64), terms, factors, [skip], k)[0]

    def best(self, place, term, factor, skips: list, k: int) -> list[list[tuple[float, int]]]:
        """``nearest`` of some queries, given as rows (query, term, factor) in order; what to skip of each.

        A query's products do not depend on the queries beside it.
        """
        import numpy as np

        if not self.n:
            return [[] for _ in skips]
        if self.rows is None:
            self.prepare()
        size, count = len(self.rows), len(skips)
        column = self.columns[term]
        often, rare = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        query = np.zeros((count, self.rows.shape[1]))
        query[place[often], column[often]] = factor[often]
        at, sizes = spans(self.starts[term[rare]], self.starts[term[rare] + 1])
        sums = np.bincount(np.repeat(place[rare] * size, sizes) + self.places[at],
                           np.repeat(factor[rare], sizes) * self.weights[at], count * size)
        sums = sums.reshape(count, -1, BLOCK)
        bounds = sums.max(2) + query @ self.maxima
        products, least = np.zeros(sums.shape), np.zeros(count)
        flat = products.reshape(count, -1)
        top = np.argsort(-bounds, 1, kind="stable")[:, :FIRST]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, top, True, 1)
        for visit in (first, ~first):
            # the margin is for sums in another order
            visit = visit & (bounds > 0) & (bounds >= least[:, None] * (1 - 1e-9))
            for block in np.flatnonzero(visit.any(0)):
                some = np.flatnonzero(visit[:, block])
                weights = self.rows[block * BLOCK:(block + 1) * BLOCK]
                products[some, block] = sums[some, block] + query[some] @ weights.T
            for i, skip in enumerate(skips):
                if skip:
                    flat[i, list(skip)] = 0.0
            found = np.take_along_axis(products, top[:, :, None], 1).reshape(count, -1)
            if found.shape[1] >= k:
                least = np.partition(found, found.shape[1] - k, 1)[:, found.shape[1] - k]
        out = []
        for i in range(count):
            near = np.flatnonzero((flat[i] > 0) & (flat[i] >= least[i] * (1 - 1e-9)))
            if len(near) > k:
                kth = np.partition(flat[i, near], len(near) - k)[len(near) - k]
                near = near[flat[i, near] >= kth * (1 - 1e-9)]
            # summed again in an order of its own: equal texts have equal products
            exact = sums[i].reshape(-1)[near] + (self.rows[near] * query[i]).sum(1)
            chosen = np.argsort(-exact, kind="stable")[:k]
            out.append(list(zip(exact[chosen].tolist(), near[chosen].tolist())))
        return out


@dataclass
class ToxicityModel:
    vocabulary: pa.Array
    factors: object                   # of each term: its inverse document frequency times its boost
    index: BlockMaxIndex | None
    ids: list[int | None]
    labels: list[int]
    texts: dict[bytes, set[int]]      # digest of an example's text -> its places
    rate: float                       # label rate of all labelled rows that may be learned from
    k: int
    curve: tuple[float, float] = (1.0, 0.0)
    shares: tuple[float, float] = (1.0, 1.0)
    norms: DataFrame | None = None    # k1, k2, rest: the other terms' share of each text's squared norm

    def __getstate__(self):
        return self.__dict__ | {"norms": None}

    def vectors(self, texts: pa.Array):
        """The examples' terms in the texts as rows (text, term, TF-IDF weight), and each text's square norm."""
        import numpy as np

        place, term, times, _ = term_counts(texts, self.vocabulary, False)
        weight = tf_weights(times) * self.factors[term]
        return place, term, weight, np.bincount(place, weight * weight, len(texts))

    def units(self, texts: list[bytes]) -> list[tuple]:
        """Unit vectors (terms, weights) of texts that have no other terms (examples)."""
        import numpy as np

        out = []
        for piece in pieces(pa.array(texts, pa.binary()).view(pa.string())):
            place, term, weight, square = self.vectors(piece)
            cuts = np.searchsorted(place, np.arange(len(piece) + 1))
            out += [(term[a:b], weight[a:b] / math.sqrt(s or 1))
                    for a, b, s in zip(cuts[:-1], cuts[1:], square.tolist())]
        return out

    def near(self, texts: pa.Array) -> tuple[list[list[tuple[float, int]]], list[float]]:
        """The nearest examples by product with each text's weights; the square of their norm."""
        import numpy as np

        place, term, weight, square = self.vectors(texts)
        skips = [self.texts.get(digest(text), ()) for text in utf8(texts)]
        cuts, found = np.searchsorted(place, np.arange(len(skips) + 1)), []
        work = np.bincount(place, self.index.postings(term), len(skips))
        for start, stop in groups(work, QUERIES, POSTINGS):
            a, b = cuts[start], cuts[stop]
            found += self.index.best(place[a:b] - start, term[a:b], weight[a:b], skips[start:stop], self.k)
        return found, square.tolist()

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Log odds of the weighted votes, drawn towards the label rate."""
        for_, against = PULL * self.rate, PULL * (1 - self.rate)
        for cosine, i in near:
            if self.labels[i]:
                for_ += cosine * cosine * self.shares[1]
            else:
                against += cosine * cosine * self.shares[0]
        return math.log(for_ / against)

    def score(self, votes_for: Column, votes_against: Column) -> Column:
        """``vote`` and the curve in an expression, from the sums of the squared cosines."""
        slope, offset = self.curve
        odds = F.log((F.lit(PULL * self.rate) + votes_for * self.shares[1])
                     / (F.lit(PULL * (1 - self.rate)) + votes_against * self.shares[0]))
        x = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), slope * odds + F.lit(offset)))
        return 1 / (1 + F.exp(-x))


def digest(text: bytes) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(text)


def logistic(x: list[float], y: list[int], weights: tuple[float, float]) -> tuple[float, float]:
    """Slope and offset of a logistic curve (Newton steps, smoothed targets, positive slope)."""
    import numpy as np

    x, y = np.array(x), np.array(y)
    w = np.where(y == 1, weights[1], weights[0])
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([(w * (p - target) * x).sum() + 1e-3 * (a - 1), (w * (p - target)).sum()])
        s = w * p * (1 - p) + 1e-9
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 and math.isfinite(a + b) else (1.0, 0.0)


def in_fold(id_col: Column, fold: int) -> Column:
    """Held out: CRC-32 of the id as text divisible by ``fold`` (null: of the empty text)."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % fold == 0


def draw(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fold: int,
         max_per_class: int, max_bytes: int) -> tuple[list, float]:
    """Bounded draw of examples (id, text, label), and the label rate of all rows to learn from."""
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").where(~in_fold(F.col("id"), fold)))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.0
    texts = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias(TEXT))
             .where(F.octet_length(TEXT).between(1, max_bytes)))
    drawn = None
    for y in (0, 1):
        part = smallest(known.where(F.col("y") == y), ["id"], max_per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = texts.join(F.broadcast(drawn), "id")
    picked = []
    for y in (0, 1):
        picked += (rows.where(F.col("y") == y).orderBy(F.xxhash64("id", TEXT)).limit(max_per_class)
                   .select("id", TEXT, "y").toLocalIterator())
    return picked, rate


def own_rows(docs: DataFrame, text_col: str) -> tuple[Column, Column, Column]:
    """The text and its key."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    k1, k2 = key_columns(text)
    return k1.alias("k1"), k2.alias("k2"), text.alias(TEXT)


def count_terms(docs: DataFrame, text_col: str, vocabulary: pa.Array) -> tuple[list[int], DataFrame, int]:
    """Over all rows: in how many each term of the vocabulary occurs, the other terms of each row
    that has some (row, k1, k2, words, times), and how many rows there are.

    The rows are written once, so their numbers (by task and place) stay what they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["row", "k1", "k2", "words", "times", "term", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        known = len(shared.value)
        seen, rows = np.zeros(known + 1, np.int64), 0
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            for piece in pieces(batch.column(2)):
                place, term, times, others = term_counts(piece, shared.value, True)
                own = term < known
                seen[:known] += np.bincount(term[own], minlength=known)
                place, times = place[~own], times[~own]
                at, starts = np.unique(place, return_index=True)
                offsets = pa.array(np.append(starts, len(place)), pa.int32())
                words = others.take(pa.array(term[~own] - known)).cast(pa.string())
                none = pa.nulls(len(at), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + rows + done + at, pa.int64()),
                     *(batch.column(c).take(pa.array(done + at, pa.int64())) for c in (0, 1)),
                     pa.ListArray.from_arrays(offsets, words),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                     none, none.cast(pa.int64())], names)
                done += len(piece)
            rows += batch.num_rows
        seen[known] = rows
        found = np.flatnonzero(seen)
        none = pa.nulls(len(found), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.nulls(len(found), pa.list_(pa.string())), pa.nulls(len(found), pa.list_(pa.int32())),
             pa.array(found, pa.int32()), pa.array(seen[found], pa.int64())], names)

    counted = write_table(docs.select(*own_rows(docs, text_col)).mapInArrow(
        run, "row long, k1 long, k2 long, words array<string>, times array<int>, term int, n long"), "terms")
    got = {r["term"]: r["n"] for r in counted.where("term is not null").groupBy("term").agg(
        F.sum("n").alias("n")).toLocalIterator()}
    return ([got.get(t, 0) for t in range(len(vocabulary))],
            counted.where("row is not null").select("row", "k1", "k2", "words", "times"),
            got.get(len(vocabulary), 0))


def other_norms(others: DataFrame, n: int) -> DataFrame:
    """(k1, k2, rest): the sum of the squared weights of a text's terms that no example has."""
    # written first: a join of two plain tables can be split where many documents have a word
    frequencies = sized(others.select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("df")), materialize=True, limit=BROADCAST_BYTES).frame
    weight = (1 + F.log("tf")) * (F.log((1 + n) / (1 + F.col("df"))) + 1)
    # rows meet by their number, which is half as long as the text's key
    whole = (others.select("row", F.explode(F.arrays_zip("words", "times")).alias("t"))
             .select("row", F.col("t.words").alias("word"), F.col("t.times").alias("tf"))
             .join(frequencies, "word")
             .select("row", F.round(weight * weight * UNIT).cast("decimal(20,0)").alias("w"))
             .groupBy("row").agg((F.sum("w").cast("double") / UNIT).alias("rest")))
    # copies of a text are one text: their sums are equal
    return others.select("row", "k1", "k2").join(whole, "row").groupBy("k1", "k2").agg(F.max("rest").alias("rest"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fold: int = 5, max_per_class: int = 1500, max_bytes: int = 16_384,
          k: int = 15) -> ToxicityModel:
    """Examples, terms, index and calibration."""
    import numpy as np

    ship(docs.sparkSession)
    picked, rate = draw(docs, labels, id_col, text_col, label_col, fold, max_per_class, max_bytes)
    texts = [r[1].encode() for r in picked]
    ys = [r[2] for r in picked]
    if len(set(ys)) < 2:
        return ToxicityModel(pa.array([], pa.string()), None, None, [], [], {}, rate, k)
    boosts = term_boosts(texts, ys)
    vocabulary = pa.array(list(boosts), pa.string())
    df, others, n = count_terms(docs, text_col, vocabulary)
    factors = np.array([(math.log((1 + n) / (1 + d)) + 1) * b for d, b in zip(df, boosts.values())])
    model = ToxicityModel(vocabulary, factors, None, [], [], {}, rate, k, norms=other_norms(others, n))
    # examples with the same strongest term share blocks, so block maxima are tight
    units = model.units(texts)
    strongest = [int(t[w.argmax()]) if len(t) else -1 for t, w in units]
    order = sorted(range(len(texts)), key=lambda i: (strongest[i], i))
    model.ids = [picked[i][0] for i in order]
    model.labels = [ys[i] for i in order]
    for place, i in enumerate(order):
        model.texts.setdefault(digest(texts[i]), set()).add(place)
    model.index = BlockMaxIndex.of([units[i] for i in order], len(vocabulary))
    # a drawn example stands for as many labelled rows as its label's share asks for
    n1 = sum(ys)
    model.shares = ((1 - rate) * len(ys) / (len(ys) - n1), rate * len(ys) / n1)
    votes = []
    for start in range(0, len(order), QUERIES):
        some = order[start:start + QUERIES]
        place = np.repeat(np.arange(len(some)), [len(units[i][0]) for i in some])
        term, weight = (np.concatenate([units[i][c] for i in some]) for c in (0, 1))
        votes += map(model.vote, model.index.best(place, term, weight,
                                                  [model.texts[digest(texts[i])] for i in some], k))
    model.curve = logistic(votes, model.labels, model.shares)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             fold: int = 5, **training) -> DataFrame:
    """doc_id, held_out, score, predicted, nearest (ids of examples), cosines for every row."""
    model = train(docs, labels, id_col, text_col, fold=fold, **training)
    kind = docs.schema[id_col].dataType.simpleString()
    id_kind = labels.schema[id_col].dataType.simpleString()
    own = [F.col(f"`{id_col}`").alias(ID), in_fold(F.col(f"`{id_col}`"), fold).alias("held_out")]
    if model.index is None:
        return docs.select(own[0].alias(id_col), own[1], F.lit(model.rate).alias("score"),
                           F.lit(int(model.rate >= 0.5)).alias("predicted"),
                           F.array().cast(f"array<{id_kind}>").alias("nearest"),
                           F.array().cast("array<double>").alias("cosines"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [ID, "held_out", "k1", "k2", "square", "nearest", "products", "toxic"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            squares, nearest, products, toxic = [], [], [], []
            for piece in pieces(batch.column(4)):
                found, square = m.near(piece)
                squares += square
                for near in found:
                    nearest.append([m.ids[i] for _, i in near])
                    products.append([p for p, _ in near])
                    toxic.append([m.labels[i] for _, i in near])
            # the neighbours' ids have the type of the labels' id column
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(4)), pa.array(squares, pa.float64()),
                 pa.array(nearest, pa.list_(ID_KINDS.get(id_kind, pa.string()))),
                 pa.array(products, pa.list_(pa.float64())), pa.array(toxic, pa.list_(pa.int32()))], names)

    rows = docs.select(*own, *own_rows(docs, text_col)).mapInArrow(
        run, f"{ID} {kind}, held_out boolean, k1 long, k2 long, square double, nearest array<{id_kind}>, "
             "products array<double>, toxic array<int>")
    # the side of unique keys is written first: a text with many copies can be split
    norms = sized(model.norms, materialize=True, limit=BROADCAST_BYTES).frame
    norm = F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0)))
    rows = rows.join(norms, ["k1", "k2"], "left").withColumn(
        "cosines", F.transform("products", lambda p: F.least(F.lit(1.0), p / norm)))
    votes = lambda y: F.aggregate(
        F.zip_with("cosines", "toxic", lambda c, t: F.when(t == y, c * c).otherwise(0.0)), F.lit(0.0),
        lambda acc, x: acc + x)
    rows = rows.withColumn("score", model.score(votes(1), votes(0)))
    return rows.select(F.col(ID).alias(id_col), "held_out", "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"), "nearest", "cosines")


ID_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
