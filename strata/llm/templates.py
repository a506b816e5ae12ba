"""Benchmark decontamination by template canonicalisation, in DataFrame expressions.

1. Tokens: runs of letters and digits (a number keeps its inner separators, a word its
   apostrophe). In the canonical form a number (in digits or as a word), a unit after a
   number and a name (a capitalised word) each become a typed placeholder; all else is
   lower-cased. So a question whose numbers, units or names were exchanged has the same
   template.
2. Hash join: each window of ``window`` canonical tokens (an item's whole template
   where it is shorter) is hashed; document windows meet item windows by hash.
   Windows of fewer than half literal tokens are not evidence and not counted.
   Beside its template an item has its wording: the same windows with lower-cased names
   instead of placeholders, and where under half of a window is literal its lower-cased
   words themselves. So a verbatim copy, in whatever case, is found by all its windows.
   Tokens are hashed once, windows from their tokens' hashes; all sizes in one scan. Where item
   windows begin with few enough pairs of tokens, only document windows that begin so are hashed.
3. Slot consistency: matched windows of one document and item with the same shift
   form an alignment. There each slot value of the item must stand for one value
   in the document; an alignment with less than ``min_consistency`` of its slot
   values consistent is no evidence.
4. A pair (document, item) is contaminated when consistent alignments cover at least
   ``min_share`` of the item's windows, and at least ``min_windows`` or all of them.
5. An item of under ``min_tokens`` tokens is ordinary words wherever it occurs inside a
   sentence. It counts where it stands alone: a single token as a whole line, more as a
   whole part between marks or line ends (``verbatim_all``).

Scale: documents are read for windows once and only matched windows leave a task; the
item windows are broadcast below a measured size and shuffled above it. Texts are
known by a 128-bit hash, and copies of a text are one text in every group, so a
text that a third of all rows hold makes no hot group.

Defined results: null and empty texts (and items) match nothing; an item of under
``min_tokens`` tokens is never found, and windows of bare numbers are no evidence, unless
``verbatim_all`` asks for the wording of all items, whatever they are; repeated
items are items each; repeated rows are contaminated each; a very long text is one row's
arrays, in time linear in its tokens; found both as template and as wording a pair
has the template's figures; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, key_columns, write_table
from strata.operators.joins import sized

BROADCAST_BYTES = 16 << 20   # item windows or texts in question are broadcast below this
BEGINNINGS = 1 << 15         # item windows begin with fewer pairs: others are not hashed
NUMBER, UNIT, NAME = "\u0001", "\u0002", "\u0003"

# Units of measure that count as such after a number: fixed values.
UNITS = ("mm", "cm", "m", "km", "in", "ft", "yd", "mi", "inch", "inches", "foot", "feet", "yard",
         "yards", "mile", "miles", "meter", "meters", "metre", "metres", "kilometer", "kilometers",
         "kilometre", "kilometres", "mg", "g", "kg", "t", "oz", "lb", "lbs", "gram", "grams", "kilogram",
         "kilograms", "ounce", "ounces", "pound", "pounds", "ton", "tons", "tonne", "tonnes", "ml", "l",
         "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups", "s", "sec", "second",
         "seconds", "min", "minute", "minutes", "h", "hr", "hour", "hours", "day", "days", "week",
         "weeks", "month", "months", "year", "years", "cent", "cents", "dollar", "dollars", "euro",
         "euros", "percent", "degree", "degrees", "celsius", "fahrenheit", "mph", "kmh", "watt",
         "watts", "volt", "volts", "joule", "joules", "newton", "newtons", "hz", "khz", "mhz", "ghz")

# Words that are numbers: fixed values.
NUMBER_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
                "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen",
                "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred",
                "thousand", "million", "billion")

WORD = "\\p{L}\\p{M}\\p{N}_"


def tokens_text(text: Column) -> Column:
    """Text in which a number's inner separators and a word's apostrophe are token characters and a
    unit joined to a number is a token of its own."""
    clean = F.regexp_replace(text, "[\\u0001-\\u0003_]", " ")
    # the character first, then what stands around it: a pattern that begins by looking back is slow
    clean = F.regexp_replace(clean, "[.,:/](?<=\\p{N}.)(?=\\p{N})|['\u2019](?<=\\p{L}.)(?=\\p{L})", "_")
    return F.regexp_replace(clean, f"(?i)(\\p{{N}}(?<![{WORD}].)[\\p{{N}}_]*)({'|'.join(UNITS)})(?![{WORD}])", "$1 $2")


def split_tokens(text: Column, extra: str = "") -> Column:
    return F.array_remove(F.split(text, f"[^{WORD}{extra}]+"), "")


def numbered(prepared: Column) -> Column:
    """The prepared text with placeholders for numbers and for units after them."""
    after = f"(?![{WORD}])"
    firsts = "".join(sorted({w[0] for w in NUMBER_WORDS}))
    words = f"(?=[{firsts}{firsts.upper()}])(?<![{WORD}])(?i:{'|'.join(NUMBER_WORDS)})"
    c = F.regexp_replace(prepared, f"(?:\\p{{N}}(?<![{WORD}].)[\\p{{N}}_]*|{words}){after}", NUMBER)
    units = "|".join(UNITS)
    return F.regexp_replace(c, f"(?i)({NUMBER}[^{WORD}{NUMBER}-{NAME}]{{1,2}})(?:{units}){after}", f"$1{UNIT}")


def named(text: Column) -> Column:
    """The text with placeholders for names."""
    return F.regexp_replace(text, f"\\p{{Lu}}(?<![{WORD}].)[\\p{{L}}\\p{{M}}_]+(?![{WORD}])", NAME)


def canonical_tokens(with_numbers: Column, names: bool = True) -> Column:
    """The tokens of a ``numbered`` text, lower-cased, with placeholders for names if asked."""
    return split_tokens(F.lower(named(with_numbers) if names else with_numbers), f"{NUMBER}-{NAME}")


def token_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def literal_enough(window: Column, size) -> Column:
    return 2 * F.size(F.filter(window, lambda t: ~is_slot(t))) >= size


def wording(window: Column, words: Column, size) -> Column:
    """A window of the wording: its placeholders where half of it is literal, else its words."""
    return F.when(literal_enough(window, size), window).otherwise(F.transform(words, F.lower))


def begins(hashes: Column) -> Column:
    """Hash of the first two tokens of a window of several."""
    return F.xxhash64(F.get(hashes, 0), F.get(hashes, 1))


def windows(hashes: str, size: int, beginnings: list[int] | None = None) -> Column:
    """(at, hash) of each window of ``size`` tokens; with ``beginnings``, of those that begin with one
    of these pairs. ``hashes`` is a column's name: an expression would be computed again for every
    window."""
    tokens = F.col(hashes)
    places = F.sequence(F.lit(1), F.size(tokens) - F.lit(size - 1))
    if beginnings is not None and size > 1:
        # as text: thousands of literals are one call
        pairs = ", ".join(f"{p}L" for p in beginnings)
        places = F.expr(f"filter(sequence(1, size({hashes}) - {size - 1}), i -> "
                        f"xxhash64(element_at({hashes}, i), element_at({hashes}, i + 1)) in ({pairs}))")
    return F.when(F.size(tokens) >= size, F.transform(
        places, lambda i: F.struct((i - 1).alias("at"), F.xxhash64(F.slice(tokens, i, size)).alias("hash")))
    ).otherwise(F.array().cast("array<struct<at: int, hash: bigint>>"))


def beginnings_of(each: DataFrame, size: int) -> list[int] | None:
    """The first two tokens, as ``begins`` has them, of all item windows of a size; None where they
    are too many to be told."""
    found = each.where(F.col("size") == size).select("begins").distinct().limit(BEGINNINGS + 1).collect()
    return None if not found or len(found) > BEGINNINGS else sorted(r[0] for r in found)


def is_slot(token: Column) -> Column:
    return token.isin(NUMBER, UNIT, NAME)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, min_tokens: int,
                 verbatim_all: bool) -> DataFrame:
    """(item, kind, size, original and canonical tokens, place, hash, begins), one row for each
    informative window of an item's template (kind 0) and each window of its wording (kind 1)."""
    prepared = items.select(F.col(f"`{id_col}`").alias("item"), tokens_text(F.col(f"`{text_col}`")).alias("p"))
    prepared = prepared.withColumn("n", numbered(F.col("p")))
    out = None
    for kind in (0, 1):
        rows = (prepared.select("item", F.lit(kind).alias("kind"), split_tokens(F.col("p")).alias("words"),
                                canonical_tokens(F.col("n"), kind == 0).alias("forms"))
                .where(F.size("forms") >= min_tokens)
                .withColumn("size", F.least(F.size("forms"), F.lit(window)))
                .withColumn("row", F.xxhash64("item", "words", "kind")))
        each = rows.select("*", F.explode(F.sequence(F.lit(0), F.size("forms") - F.col("size"))).alias("place"))
        part = F.slice("forms", F.col("place") + 1, F.col("size"))
        words = F.slice("words", F.col("place") + 1, F.col("size"))
        form = wording(part, words, F.col("size")) if kind else part
        each = each.withColumn("hashes", token_hashes(form))
        if kind:
            if not verbatim_all:
                each = each.where(F.exists(words, lambda w: w.rlike("\\p{L}")))
        else:
            each = each.where(literal_enough(part, F.col("size")))
        each = each.select("*", F.xxhash64("hashes").alias("hash"), begins(F.col("hashes")).alias("begins")).drop("hashes")
        out = each if out is None else out.unionByName(each)
    return out


def alone(rows: DataFrame, items: DataFrame, id_col: str, text_col: str, min_tokens: int) -> DataFrame | None:
    """(k1, k2, item): texts (t) in which an item of under ``min_tokens`` tokens stands alone; None
    where there is no such item."""
    short = (items.select(F.col(f"`{id_col}`").alias("item"), split_tokens(F.lower(tokens_text(
        F.col(f"`{text_col}`")))).alias("tokens")).where(F.size("tokens").between(1, min_tokens - 1)))
    short = sized(short, materialize=True, limit=BROADCAST_BYTES)
    if short.rows == 0:
        return None
    out = None
    for edges, least, most in (("[\r\n]+", 1, 1), ("[\r\n.,:;!?()\\[\\]{}<>|\"\u00ab\u00bb\u201c-\u201f\u2026]+", 2, min_tokens - 1)):
        parts = (rows.select("k1", "k2", F.explode(F.split("t", edges)).alias("part"))
                 .select("k1", "k2", split_tokens(F.lower(tokens_text(F.col("part")))).alias("tokens"))
                 .where(F.size("tokens").between(least, most)))
        found = parts.join(short.frame, "tokens").select("k1", "k2", "item")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def contaminated_pairs(docs: DataFrame, items: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = 8,
                       min_share: float = 0.3, min_windows: int = 3, min_consistency: float = 0.75,
                       min_tokens: int = 4, verbatim_all: bool = False) -> DataFrame:
    """(k1, k2, item, n_windows, n_matched, consistency): contaminated texts by their hash."""
    each = write_table(item_windows(items, item_id_col, item_text_col, window, min_tokens,
                                    verbatim_all), "items")
    known = each.select("row", "item", "place", "hash", "size")
    totals = each.groupBy("row").agg(F.countDistinct("place").alias("n_windows"))
    sizes = sorted(r[0] for r in each.select("size").distinct().collect())     # at most ``window`` values

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    k1, k2 = key_columns(text)
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), text.alias("t"))
    # windows of few literals, if an item has such, are compared by their words
    by_words = not each.where((F.col("kind") == 1) & ~literal_enough(
        F.slice("forms", F.col("place") + 1, F.col("size")), F.col("size"))).isEmpty()
    kinds = ["template", "wording", *["words"] * by_words]
    prepared = rows.select("k1", "k2", tokens_text(F.col("t")).alias("p"))
    tokens = (prepared.select("*", numbered(F.col("p")).alias("n"))
              .select("k1", "k2", canonical_tokens(F.col("n")).alias("template"),
                      canonical_tokens(F.col("n"), False).alias("wording"),
                      split_tokens(F.lower("p")).alias("words")))
    hashed = tokens.select("k1", "k2", *[token_hashes(F.col(k)).alias(k) for k in kinds])
    # all windows in one list; a window that begins as no item window does cannot match
    starts = {size: beginnings_of(each, size) for size in sizes}
    asked = [(k, size) for size in sizes or [window] for k in kinds]
    found = hashed.select("k1", "k2", F.explode(F.concat(*[
        windows(k, size, starts.get(size)) for k, size in asked])).alias("w")).select("k1", "k2", "w.at", "w.hash")
    side = sized(known.select("row", "place", "hash"), limit=BROADCAST_BYTES).frame
    matched = (found.join(side, "hash")
               .select("k1", "k2", "row", "place", (F.col("at") - F.col("place")).alias("shift")))
    # copies of a text are one text: sets merge before the shuffle
    aligned = matched.groupBy("k1", "k2", "row", "shift").agg(F.collect_set("place").alias("places"))
    aligned = write_table(aligned, "aligned")
    enough = F.least(F.col("n_windows"), F.greatest(F.lit(min_windows), F.ceil(F.col("n_windows") * min_share)))
    merged = lambda a: F.size(F.array_distinct(F.flatten(F.collect_list(a))))
    totals = sized(totals, limit=BROADCAST_BYTES).frame
    likely = (aligned.groupBy("k1", "k2", "row").agg(merged("places").alias("n")).join(totals, "row")
              .where(F.col("n") >= enough).select("k1", "k2", "row", "n_windows"))
    likely = write_table(aligned.join(likely, ["k1", "k2", "row"]), "likely")

    # the words of the texts in question, once for each text
    asked = sized(likely.select("k1", "k2").distinct(), materialize=True, limit=BROADCAST_BYTES).frame
    texts = (rows.join(asked, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("t").alias("t"))
             .select("k1", "k2", split_tokens(tokens_text(F.col("t"))).alias("theirs")))
    ours = sized(each.select("row", "item", "kind", "size", "words", "forms").dropDuplicates(["row"]),
                 materialize=True, limit=BROADCAST_BYTES).frame
    pairs = likely.join(texts, ["k1", "k2"]).join(ours, "row")
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p, p + F.col("size") - 1)))))
    slots = F.filter(covered, lambda p: is_slot(F.element_at("forms", p + 1)))
    value = lambda p: F.struct(F.element_at("forms", p + 1).alias("kind"),
                               F.element_at("words", p + 1).alias("ours"))
    both = lambda p: F.struct(value(p).alias("slot"),
                              F.lower(F.element_at("theirs", p + F.col("shift") + 1)).alias("theirs"))
    pairs = (pairs.withColumn("slots", slots)
             .withColumn("values", F.array_distinct(F.transform("slots", value)))
             .withColumn("maps", F.array_distinct(F.transform("slots", both))))
    good = F.size(F.filter("values", lambda v: F.size(F.filter("maps", lambda m: m["slot"] == v)) == 1))
    pairs = (pairs.withColumn("consistency", F.when(F.size("values") == 0, F.lit(1.0))
                              .otherwise(good / F.size("values")))
             .where(F.col("consistency") >= min_consistency))
    result = (pairs.groupBy("k1", "k2", "row", "item", "words", "kind", "n_windows")
              .agg(merged("places").cast("long").alias("n_matched"), F.min("consistency").alias("consistency"))
              .where(F.col("n_matched") >= enough))
    # found as template and as wording: one pair, with the template's figures
    one = result.groupBy("k1", "k2", "item", F.xxhash64("words").alias("base")).agg(
        F.min(F.struct("kind", "n_windows", "n_matched", "consistency")).alias("r"))
    one = one.select("k1", "k2", "item", "r.n_windows", "r.n_matched", "r.consistency")
    short = alone(rows, items, item_id_col, item_text_col, min_tokens) if verbatim_all else None
    if short is not None:
        whole = F.lit(1).cast("long")
        one = one.unionByName(short.select("k1", "k2", "item", whole.alias("n_windows"), whole.alias("n_matched"),
                                           F.lit(1.0).alias("consistency")))
    return write_table(one, "leaks")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", **options) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, consistency of each contaminated pair."""
    found = contaminated_pairs(docs, items, text_col, item_id_col, **options)
    side = sized(found, limit=BROADCAST_BYTES).frame
    k1, k2 = key_columns(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    keys = docs.select(F.col(f"`{id_col}`").alias("__id"), k1.alias("k1"), k2.alias("k2"))
    return (keys.join(side, ["k1", "k2"])
            .select(F.col("__id").alias(id_col), F.col("item").alias(item_id_col), "n_windows",
                    "n_matched", "consistency"))


def clean_stage(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    at1, at2 = fresh(docs, "__k1", "__k2")
    found = contaminated_pairs(docs, items, text_col, **options).select(
        F.col("k1").alias(at1), F.col("k2").alias(at2)).distinct()
    side = sized(found, materialize=True, limit=BROADCAST_BYTES).frame
    k1, k2 = key_columns(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return (docs.withColumn(at1, k1).withColumn(at2, k2)
            .join(side, [at1, at2], "left_anti").drop(at1, at2))
