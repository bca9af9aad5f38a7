"""Routing of checked rows and the tables that report on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators.repair import CHANGED, CHANGES, ORIGINAL
from millrace.operators.rules import is_text_flag
from millrace.operators.validate import ERRORS, IS_VALID, RESULT_COLUMNS


def record_columns(df: DataFrame) -> list[str]:
    """The columns of the record itself, without verdicts, logs and helpers."""
    flags = {is_text_flag(c) for c in df.columns}
    extra = {*RESULT_COLUMNS, CHANGES, CHANGED, ORIGINAL, *flags}
    return [c for c in df.columns if c not in extra]


def split_quality(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, as records, and failing rows with their errors."""
    record = record_columns(df)
    clean = df.where(IS_VALID).select(*record)
    failing = df.where(~F.col(IS_VALID)).select(*record, ERRORS)
    return clean, failing


def _key(table: C.Table) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in table.primary_key])


def quarantine_rows(df: DataFrame, table: C.Table) -> DataFrame:
    """Failing rows of a checked frame in one shape for all tables."""
    record = F.to_json(F.struct(*record_columns(df)))
    return df.where(~F.col(IS_VALID)).select(
        F.lit(table.name).alias("table_name"),
        _key(table).alias("record_key"),
        record.alias("record"),
        F.col(ERRORS).alias("errors"),
    )


def audit_rows(df: DataFrame, table: C.Table) -> DataFrame:
    """Changed rows of a repaired frame: before, after and the log, in one shape for all tables."""
    before = df.schema[ORIGINAL].dataType.fieldNames()
    record = [c for c in record_columns(df)]
    originals = [F.col(f"{ORIGINAL}.{c}").alias(c) if c in before else F.col(c) for c in record]
    return df.where(CHANGED).select(
        F.lit(table.name).alias("table_name"),
        _key(table).alias("record_key"),
        F.to_json(F.struct(*originals)).alias("original"),
        F.to_json(F.struct(*record)).alias("transformed"),
        F.col(CHANGES).alias("changes"),
    )


def long_counts(counts: DataFrame, phase: str, table: str) -> DataFrame:
    """One row per metric from a one-row frame of counts."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in counts.columns]
    )
    return counts.select(F.lit(phase).alias("phase"), F.lit(table).alias("table_name"), F.inline(pairs))


def run_report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def metrics_frame(spark: SparkSession, metrics: Mapping[tuple[str, str], Mapping[str, int]]) -> DataFrame:
    """The report of a run from the counts its own writes observed."""
    rows = [
        (phase, table, metric, int(value))
        for (phase, table), values in metrics.items()
        for metric, value in values.items()
    ]
    return spark.createDataFrame(rows, "phase string, table_name string, metric string, value bigint")
