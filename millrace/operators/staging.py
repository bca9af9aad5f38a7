"""Typed staging tables with lineage columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.session import hadoop_path

UNCASTABLE = "_uncastable"

# An arrival position is one long: the rank of the source, the ingested batch, the message in the
# batch, the place in the message.
PLACE_BITS, MESSAGE_BITS, BATCH_BITS, RANK_BITS = 20, 20, 16, 5
CHUNK_BITS = MESSAGE_BITS + BATCH_BITS
MAX_CHUNK = 1 << PLACE_BITS


def arrival_position(rank: Column, batch: Column, message: Column, place: Column) -> Column:
    """One number that orders records as they arrived; a part that is too large fails the job."""
    parts = ((rank, RANK_BITS), (batch, BATCH_BITS), (message, MESSAGE_BITS), (place, PLACE_BITS))
    position = F.lit(0).cast("bigint")
    fits = F.lit(True)
    for part, bits in parts:
        position = F.shiftleft(position, bits) + part.cast("bigint")
        fits = fits & part.between(0, (1 << bits) - 1)
    too_large = F.raise_error(F.lit("a batch, message or record number is too large for an arrival position"))
    return F.when(fits, position).otherwise(too_large.cast("bigint"))


def inserted_at() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def staging_length(c: C.Column) -> int | None:
    """The longest text that a column takes in staging."""
    if not isinstance(c.dtype, T.StringType) or c.max_length is None:
        return None
    return C.STAGING_ID_LENGTH if c.name in C.ID_COLUMNS else c.max_length


def typed_columns(
    columns: Sequence[C.Column],
    value: Callable[[str], Column],
    longest: Callable[[C.Column], Column | int | None] | None = None,
) -> tuple[dict[str, Column], Column]:
    """Casts of values by column, and the list of columns whose value does not fit its type.

    ``longest`` gives the limit of a text column, by default that of the column itself.
    """
    casts, failed = {}, []
    for c in columns:
        raw = value(c.name)
        casts[c.name] = raw.cast("string") if isinstance(c.dtype, T.StringType) else raw.try_cast(c.dtype)
        if not isinstance(c.dtype, T.StringType):
            failed.append(F.when(raw.isNotNull() & casts[c.name].isNull(), F.lit(c.name)))
        else:
            limit = staging_length(c) if longest is None else longest(c)
            if limit is not None:
                failed.append(F.when(F.length(casts[c.name]) > limit, F.lit(c.name)))
    uncastable = (
        F.filter(F.array(*failed), lambda name: name.isNotNull()) if failed else F.array().cast("array<string>")
    )
    return casts, uncastable


def stage(
    df: DataFrame, table: C.Table, source: str, rank: int, order: str | None = C.ORDER_COLUMN
) -> DataFrame:
    """Bring source rows into the staging form of a table.

    Columns the source lacks are null; a column the table does not know is an error. Values are cast
    to the types of the table; ``_uncastable`` lists the columns where that failed, see
    :func:`split_castable`. ``order`` names the column with the row's place in its source.
    """
    lineage = {C.SOURCE_COLUMN, C.INSERTED_AT_COLUMN, order}
    unknown = [c for c in df.columns if c not in table.column_names and c not in lineage]
    if unknown:
        raise ValueError(f"{table.name} has no column {', '.join(unknown)}")

    def value(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    casts, uncastable = typed_columns(table.columns, value)
    position = (
        F.shiftleft(F.lit(rank).cast("bigint"), PLACE_BITS + CHUNK_BITS) + F.col(order).cast("bigint")
        if order is not None and order in df.columns
        else F.lit(None).cast("bigint")
    )
    return df.select(
        *[casts[c.name].alias(c.name) for c in table.columns],
        F.lit(source).alias(C.SOURCE_COLUMN),
        inserted_at().alias(C.INSERTED_AT_COLUMN),
        position.alias(C.ORDER_COLUMN),
        uncastable.alias(UNCASTABLE),
    )


def split_castable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the types, and the others with the list of columns that did not."""
    failed = F.size(UNCASTABLE) > 0
    return df.where(~failed).drop(UNCASTABLE), df.where(failed)


def union_sources(*staged: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), staged)


def write_staging(df: DataFrame, table: C.Table, root: str) -> None:
    """Replace one staging table, partitioned by source."""
    df.write.mode("overwrite").partitionBy(C.SOURCE_COLUMN).parquet(f"{root.rstrip('/')}/stg_{table.name}")


def empty_staging(spark: SparkSession, table: C.Table) -> DataFrame:
    return spark.createDataFrame([], staged_schema(table))


def staged_schema(table: C.Table) -> T.StructType:
    lineage = [
        T.StructField(C.SOURCE_COLUMN, T.StringType()),
        T.StructField(C.INSERTED_AT_COLUMN, T.StringType()),
        T.StructField(C.ORDER_COLUMN, T.LongType()),
    ]
    return T.StructType([*table.staging_schema.fields, *lineage])


def read_staging(spark: SparkSession, root: str, catalog: C.Catalog = C.DEFAULT_CATALOG) -> dict[str, DataFrame]:
    """All staging tables; one that was never written is empty."""
    tables = {}
    for table in catalog:
        path = f"{root.rstrip('/')}/stg_{table.name}"
        fs, handle = hadoop_path(spark, path)
        schema = staged_schema(table)
        tables[table.name] = (
            spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
            if fs.exists(handle)
            else empty_staging(spark, table)
        )
    return tables


def table_counts(tables: Mapping[str, DataFrame], total: bool = True) -> DataFrame:
    """Row counts of all tables, in one job, and their total."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, parts)
    if not total:
        return counts
    return counts.rollup("table_name").agg(F.sum("n").alias("n")).withColumn(
        "table_name", F.coalesce("table_name", F.lit("total"))
    )
