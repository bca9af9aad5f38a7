"""A corpus pipeline of the operators in ``millrace.llm``: what is left of ``documents``, packed for training.

Every stage works on all rows that the stage before kept; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, ngram_join, packing, secrets, toxicity
from millrace.llm.common import documents, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on the labels, calls toxic.

    Null and empty texts are judged as texts without a word, repeated rows alike; without labels of both kinds
    nothing goes, unless all labels are toxic. An empty table stays one.
    """
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingle sets connect: that of the smallest id.

    Null ids count only where a group has no other; of repeated rows one stays, of one id's different texts in a group
    that of the smallest hash. Texts without words, null ones too, belong to no group and stay.
    """
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that repeat passages of the benchmark in a twentieth of their words or more.

    Null and empty texts stay; repeated rows are judged alike; an empty benchmark takes nothing away.
    """
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret, and ``n_chars`` as the text is then.

    A null text stays null; repeated rows are treated alike.
    """
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of binary lengths.

    A null or empty text is one piece with the end id alone; repeated rows are documents of their own.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Training, compression and tokenising cannot be said in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES:
        rows = saved(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows
