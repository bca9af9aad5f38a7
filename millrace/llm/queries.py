"""One registered query for each operator of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import archives, decontam, extraction, fingerprints, langid, lines, ngram_join, packing, search, secrets, suffixes, toxicity, tries
from millrace.llm.common import documents


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(documents(spark, sf_dir).select("doc_id", "text")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.digests(decontam.contamination(documents(spark, sf_dir), benchmark))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.deduplicated(documents(spark, sf_dir)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.digests(archives.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(documents(spark, sf_dir)))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated_digests(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_language": op2_language,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontamination": op4_decontamination,
    "op5_lines": op5_lines,
    "op6_warc": op6_warc,
    "op7_fingerprints": op7_fingerprints,
    "op8_packing": op8_packing,
    "op9_suffixes": op9_suffixes,
    "op10_toxicity": op10_toxicity,
    "op11_search": op11_search,
    "op12_extraction": op12_extraction,
    "op13_trie": op13_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_join": ngram_join.SQL,
    "op4_decontamination": decontam.SQL,
    "op5_lines": lines.SQL,
    "op6_warc": archives.SQL,
    "op9_suffixes": suffixes.SQL,
    "op11_search": search.SQL,
    "op13_trie": tries.SQL,
}
