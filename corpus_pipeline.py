"""Corpus pipeline: five stages over the documents table, each one of the operators.

Every stage works on all rows that the stage before it kept; its result is written as
Parquet to the shared folder and read again. All but the last return the columns of
the documents table, other columns too, whatever their names.

Defined results, in every stage: an empty table stays empty; a null text counts as an empty
one, and stays null where it is kept; very long texts are read whole; a result does not depend
on how rows are dealt to tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import lines, piece_codec, quality, simhash, templates
from strata.llm.queries import table
from strata.session import temporary, work_dir
from strata.sources.layers import delete_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and the line labels keep. Null and empty texts have no
    words and go; repeated rows are judged each."""
    return quality.keep_stage(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites carry. A text of such lines only that
    other rows hold too stays, for near-dedup: else none of its copies would be left."""
    return lines.dedup_stage(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id (a null id last); of
    rows that repeat id and text the least by their other columns. Texts without a word are one
    group."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null, empty and repeated rows are judged each."""
    return templates.clean_stage(docs, table(spark, sf_dir, "benchmark"), verbatim_all=True)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids (as a digest) and the decoded text's digest of what is left; a row for every row."""
    return piece_codec.encode_decode(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

# stages 1, 3, 4 and 5 cannot be put in SQL: tests compare run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. A stage's helper tables go when its result is
    written, and a result goes when the next one is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
