"""Rendering rows as delimited text and taking such text apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# CSV dialect of the feeds: comma, double quote, a quote inside a value doubled.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def render_csv(*cols, quote_all: bool = False) -> Column:
    """P13 (quoted form): one CSV record per row, values quoted where needed.

    A quote inside a value is doubled; null renders as an empty field.
    """
    opts = dict(CSV_OPTIONS)
    if quote_all:
        opts["quoteAll"] = "true"
    return F.to_csv(F.struct(*_cols(cols)), opts)


def render_bare(*cols, null_text: str = "None") -> Column:
    """P13 (bare form): values joined by ',' with no quoting, null as 'None'.

    This is the lossy text of a plain ``','.join(str(v) ...)``: a comma inside
    a value shifts every later field when the text is split again.
    """
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit(null_text))
                              for c in _cols(cols)])


def parse_csv(line, ddl: str) -> Column:
    """Parse a CSV record held in a text column into a struct."""
    line = F.col(line) if isinstance(line, str) else line
    return F.from_csv(line, ddl, CSV_OPTIONS)


def split_key(line) -> tuple[Column, Column]:
    """Split on bare commas; the first field is the key, the rest a list."""
    line = F.col(line) if isinstance(line, str) else line
    parts = F.split(line, ",", -1)
    return parts.getItem(0), F.slice(parts, F.lit(2), F.size(parts) - F.lit(1))


def expand_lists(df: DataFrame, key: str, joins: str) -> DataFrame:
    """(key, [[...], [...]]) -> one row (key, [...]) per inner list.

    An empty or null outer list emits nothing, like iterating an empty list.
    """
    return df.select(F.col(key), F.explode(F.col(joins)).alias(joins))


def render_joins(key, joins) -> Column:
    """Key and the values of one inner list as one comma-joined line."""
    key = F.col(key) if isinstance(key, str) else key
    joins = F.col(joins) if isinstance(joins, str) else joins
    return F.concat_ws(",", key.cast("string"), joins)
