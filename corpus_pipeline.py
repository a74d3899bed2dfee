"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

``quality`` drops documents that the classifier rejects, ``near_dedup`` keeps one document of each
group of near-duplicates, ``decontaminate`` drops documents that hold passages of the benchmark,
``secrets`` replaces secrets in the texts, and ``pack`` returns the pieces of all documents in
token sequences. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm.common import read_table, stored
from feedlens.llm.decontaminate import clean_rows
from feedlens.llm.near_dedup import near_duplicates
from feedlens.llm.packing import pack
from feedlens.llm.quality import keep_good
from feedlens.llm.secrets import mask_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good; the labels of the data set train the classifier."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id. Rows without an id stay; rows
    that repeat an id are one document and stay or go together."""
    found = near_duplicates(docs, threshold=85)
    gone = stored(found.filter("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark text."""
    return clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("secrets", secrets), ("packing", packing)]

# Training, components and suffix arrays have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
