"""Per-row expressions of the trusted and refined layers.

All of them return ``Column`` expressions built from Spark SQL functions, so they
stay inside whole-stage codegen; nothing here runs Python per row.

Strict casts raise on bad text whatever ``spark.sql.ansi.enabled`` says: the
value is parsed once with ``try_cast`` and a non-null input that gives null
raises an error that names the column and the value. Coerce mode returns the
``try_cast`` result (null on bad text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import specs as S

# The timestamp text layout of the feeds ("%Y-%m-%d %H:%M:%S" in
# strptime terms; unpadded month, day and time fields are accepted) and the
# text values that stand for a missing value.
DATE_PATTERN = "yyyy-M-d H:m:s"
NULL_TOKENS = ("", "None")

# What counts as a number's text (fixed grammar, that of the feeds' own parser): sign,
# digits with an optional point and exponent, or a word for infinity or no number,
# with white space around. Spark's own cast would also take "4d" and "4f".
NUMBER_TEXT = (r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$")

PLAIN_NUMBER = "0123456789+-.eE "

STRICT = "strict"
COERCE = "coerce"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guard(src: Column, parsed: Column, what: str) -> Column:
    """The parsed value; raise when a non-null input did not parse.

    ``coalesce`` evaluates the parse once and reaches the error branch only for
    a null result.
    """
    failure = F.when(src.isNotNull(), F.raise_error(
        F.concat(F.lit(f"cannot convert to {what}: '"), src.cast("string"), F.lit("'"))))
    return F.coalesce(parsed, failure)


def cast_text(c, to: str, mode: str = STRICT) -> Column:
    """Text -> bigint / double / string, strict or coercing."""
    src = _col(c)
    if to in ("string", "text"):
        return src.cast("string")
    spark_type = {"long": "bigint", "bigint": "bigint", "double": "double",
                  "int": "int"}[to]
    parsed = number(src) if spark_type == "double" else src.try_cast(spark_type)
    return parsed if mode == COERCE else _guard(src, parsed, spark_type)


def number(c) -> Column:
    """Text that is a number as a double, other text as null."""
    text = _col(c).cast("string")
    # of these characters alone Spark takes what the grammar takes: no pattern to match
    plain = F.btrim(text, F.lit(PLAIN_NUMBER)) == ""
    return F.when(plain | text.rlike(NUMBER_TEXT), F.trim(text).try_cast("double"))


def coerce_long(c) -> Column:
    """Number if the text parses, else 0; truncated toward zero to bigint.

    NaN counts as missing (it becomes 0); an infinite value raises, as an
    integer has no infinity.
    """
    as_double = F.coalesce(number(c), F.lit(0.0))
    return F.nanvl(as_double, F.lit(0.0)).cast("bigint")


def null_token(c) -> Column:
    """P10: null, '' and 'None' -> null; any other text unchanged."""
    src = _col(c)
    return F.when(~src.isin(*NULL_TOKENS), src)


def parse_date(c, policy: str = S.STRICT) -> Column:
    """P11/P12: 'yyyy-m-d h:m:s' text -> date (time of day dropped).

    Null tokens give null under both policies. ``strict`` raises on other bad
    text; ``tolerant`` gives null.
    """
    token = null_token(c)
    parsed = F.try_to_date(token, DATE_PATTERN)
    if policy == S.TOLERANT:
        return parsed
    return _guard(token, parsed, "date")


def fill_zero(df: DataFrame, exclude=()) -> DataFrame:
    """Nulls -> 0 in numeric columns and '0' in text columns.

    Columns in ``exclude`` (keys, dates) are left alone.
    """
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            out.append(c)
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(c, F.lit("0")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def replace_blank(df: DataFrame, columns, value: str = "0") -> DataFrame:
    """P9: '' -> ``value`` in the given text columns.

    A CSV reader returns null for an empty field, so null is treated as blank.
    """
    cols = set(columns)
    return df.select(*[
        (F.when(F.col(f.name).isNull() | (F.col(f.name) == ""), F.lit(value))
         .otherwise(F.col(f.name)).alias(f.name)) if f.name in cols else F.col(f.name)
        for f in df.schema.fields])


def trusted_columns(df: DataFrame, spec: S.TableSpec, mode: str = STRICT,
                    keep: dict[str, Column] | None = None) -> DataFrame:
    """J2 casts for one table: blanks, fills, then the per-column casts.

    ``keep`` names further columns to take along from the rows as they come in.
    """
    keep = keep or {}
    df = df.select(*spec.columns, *[c.alias(name) for name, c in keep.items()])
    if spec.blank_zero:
        df = replace_blank(df, spec.blank_zero)
    if spec.fill_zero:
        df = fill_zero(df, exclude=list(spec.natural_key) + list(spec.dates) + list(keep))
    out = [F.col(name) for name in keep]
    for name in spec.columns:
        kind = spec.trusted.get(name, S.TEXT)
        c = F.col(name)
        if kind == S.LONG:
            c = cast_text(c, "long", mode)
        elif kind == S.DOUBLE:
            c = cast_text(c, "double", mode)
        elif kind == S.COERCE_LONG:
            c = coerce_long(c)
        elif kind == S.COERCE_LONG_DOUBLE:
            c = coerce_long(c).cast("double")
        else:
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out[len(keep):], *out[:len(keep)])


def typed_projection(df: DataFrame, spec: S.TableSpec, mode: str = STRICT) -> DataFrame:
    """Named, typed refined columns from a trusted (or raw) frame.

    Text columns pass through, numbers are cast (a no-op on trusted input),
    date columns are parsed with the table's date policy.
    """
    out = []
    for name in spec.columns:
        kind = spec.refined[name]
        c = F.col(name)
        if kind == "date":
            c = parse_date(c.cast("string"), spec.dates.get(name, S.STRICT))
        elif kind == "string":
            c = c.cast("string")
        elif isinstance(df.schema[name].dataType, T.StringType):
            c = cast_text(c, kind, mode)
        else:
            c = c.cast({"long": "bigint", "double": "double"}[kind])
        out.append(c.alias(name))
    return df.select(*out)
