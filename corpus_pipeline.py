"""The corpus pipeline: documents through the stages in order, each written as
Parquet and read again as the next one's ``docs``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import op1_mixing, op2_lines, op3_toxicity, op6_minhash, op8_packing
from barforge.llm.common import stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not reject."""
    return op3_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document with a smaller id holds."""
    return op2_lines.without_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return op6_minhash.keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row for each epoch."""
    return op1_mixing.mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of every piece; a document's epochs never share a bin."""
    return op8_packing.pack(docs, cluster=F.xxhash64("doc_id"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can't express the classifier or the mix; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
