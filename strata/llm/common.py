"""Helpers shared by the operators: shared tables, texts as bytes, tokenizer files.

Every operator first projects the two columns it needs under private names, so
extra columns of the input (whatever they are called) never clash with its own.
A null text counts as an empty one.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import temp_dir

ID = "__id"
TEXT = "__text"


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file (a parameter of every caller)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there.

    A caller that consumes the result inside ``session.temporary`` has it deleted then.
    """
    spark = df.sparkSession
    path = temp_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_columns(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text: its identity wherever rows meet again.

    Made from content, so a retry or another read of the input finds the same key.
    """
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """Texts of an Arrow string column as bytes, without decoding; null is empty."""
    for chunk in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]):
        binary = chunk.cast(pa.large_binary())
        for value in binary:
            yield value.as_py() or b""


def well_formed(text: bytes) -> bytes:
    """The text, with what is no UTF-8 (which Spark's strings may hold) as U+FFFD."""
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()


def fresh(docs: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that none of the table's columns has, in any case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def smallest(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of the first key (ties by the keys): a draw that is the same
    for the same rows. Only rows whose hash is below a bound from their count are sorted, so that
    not every task sends ``n`` rows to the one that merges them."""
    hashed = F.xxhash64(keys[0])
    total = rows.count()
    part = (n + 6 * n ** 0.5 + 10) / total if total else 1.0
    if part < 1:
        low = rows.where(hashed < F.lit(int(-(1 << 63) + part * (1 << 64))))
        if low.count() >= n:                  # many rows of one key may leave too few below the bound
            rows = low
    return rows.orderBy(hashed, *keys).limit(n)


def ship(spark: SparkSession) -> None:
    """Make the package importable for the executors' Python workers (once a context).

    Spark serves the archive from the driver, also to executors that join later.
    """
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(strata.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), "strata_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("strata", os.path.relpath(path, root)))
    context.addPyFile(archive)
    context._strata_shipped = True
