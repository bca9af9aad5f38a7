"""Publishing of tables as JSON envelopes, one text line each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.staging import MAX_CHUNK
from millrace.session import for_each
from millrace.sources.tables import number_rows

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("records", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("timestamp", T.StringType()),
        T.StructField("recordCount", T.LongType()),
        T.StructField("batch", T.LongType()),
        T.StructField("totalBatches", T.LongType()),
    ]
)


def chunk_records(
    df: DataFrame, order_by: Sequence[str | Column], size: int = 1000, drop: Sequence[str] = ()
) -> DataFrame:
    """Cut a frame into chunks of ``size`` rows in a total order: ``(batch, totalBatches, records)``.

    Only the last chunk is shorter. A chunk is the largest list any task holds.
    """
    if not 0 < size <= MAX_CHUNK:
        raise ValueError(f"a chunk has 1 to {MAX_CHUNK} rows")
    numbered = number_rows(df, order_by, "__row", total="__rows")
    fields = [c for c in df.columns if c not in drop]
    return (
        numbered.select(
            (F.floor(F.col("__row") / size) + 1).cast("bigint").alias("batch"),
            F.ceil(F.col("__rows") / size).cast("bigint").alias("totalBatches"),
            F.struct(F.col("__row").alias("row"), F.struct(*fields).alias("record")).alias("item"),
        )
        .groupBy("batch", "totalBatches")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
        .select("batch", "totalBatches", F.transform("items", lambda i: i["record"]).alias("records"))
    )


def envelopes(
    df: DataFrame,
    table: str,
    source: str,
    order_by: Sequence[str | Column],
    size: int = 1000,
    drop: Sequence[str] = (),
) -> DataFrame:
    """One envelope per chunk as JSON text in ``value``, with source and record count throughout."""
    chunks = chunk_records(df, order_by, size, drop)
    envelope = F.struct(
        F.lit(source).alias("source"),
        F.lit(table).alias("table"),
        "records",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.size("records").alias("recordCount"),
        "batch",
        "totalBatches",
    )
    return chunks.select("batch", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def write_envelopes(
    df: DataFrame,
    table: str,
    source: str,
    landing: str,
    order_by: Sequence[str | Column],
    size: int = 1000,
    drop: Sequence[str] = (),
) -> None:
    """Publish a table to ``landing/<source>/<table>``, one envelope per line."""
    target = f"{landing.rstrip('/')}/{source}/{table}"
    envelopes(df, table, source, order_by, size, drop).select("value").write.mode("overwrite").text(target)


def publish(
    tables: Mapping[str, DataFrame],
    source: str,
    landing: str,
    order_by: Mapping[str, Sequence[str | Column]],
    size: int = 1000,
    drop: Sequence[str] = (),
) -> None:
    """Publish all tables of one source."""
    for_each(
        lambda name: write_envelopes(tables[name], name, source, landing, order_by[name], size, drop), tables
    )
