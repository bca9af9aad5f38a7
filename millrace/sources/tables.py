"""Relational sources: JDBC tables, parquet folders and catalogue tables behind one reader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

LINE = "_line"

# A page that ends within this many rows is cut by a bounded top-n; a later one by row numbers. Both
# tell tied rows apart in the same way, so the rows of a page do not depend on which of them ran.
TOP_N_LIMIT = 100_000


@dataclass(frozen=True)
class Relational:
    """Where the tables of a relational source are.

    ``kind`` is ``jdbc``, ``parquet`` (``root/<table>.parquet``) or ``table`` (catalogue tables or
    views). For JDBC, ``options`` holds url and credentials, and ``partitions`` gives for each table the
    reader options partitionColumn, lowerBound, upperBound and numPartitions of a parallel read, or an
    empty mapping for a table that one connection may read.
    """

    kind: str
    root: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, Mapping[str, str]] = field(default_factory=dict)


# Without it some drivers hold a whole result in memory.
FETCH_SIZE = 10_000
_PARALLEL = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(source: Relational, name: str) -> dict[str, str]:
    """The reader options of a table; a parallel read must be described, or a single one asked for."""
    if name not in source.partitions:
        raise ValueError(f"say in partitions how {name} is read in parallel, or give it an empty mapping")
    parallel = {k: str(v) for k, v in source.partitions[name].items()}
    missing = [k for k in _PARALLEL if parallel and k not in parallel]
    if missing:
        raise ValueError(f"partitions of {name} lack {', '.join(missing)}")
    return {"fetchsize": str(FETCH_SIZE), **source.options, "dbtable": name, **parallel}


def read_table(
    spark: SparkSession,
    source: Relational,
    name: str,
    where: str | Column | None = None,
    args: Mapping[str, object] | None = None,
    position: bool = False,
) -> DataFrame:
    """All rows of a table, or those of a condition; the condition reaches the source.

    A text condition may name parameters as ``:name``, bound from ``args``. ``position`` adds
    ``_line``, which orders rows as they stand in their files, where the source has files.
    """
    if source.kind == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_options(source, name)).load()
    elif source.kind == "parquet":
        df = spark.read.parquet(f"{source.root.rstrip('/')}/{name}.parquet")
        if position:
            place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
            df = df.select("*", place.alias(LINE))
    elif source.kind == "table":
        df = spark.table(f"{source.root}.{name}" if source.root else name)
    else:
        raise ValueError(f"unknown kind of source {source.kind}")
    if where is None:
        return df
    if isinstance(where, Column):
        return df.where(where)
    return spark.sql(f"SELECT * FROM {{df}} WHERE {where}", args=dict(args or {}), df=df)


def read_tables(
    spark: SparkSession, source: Relational, names: Sequence[str], position: bool = False
) -> dict[str, DataFrame]:
    return {name: read_table(spark, source, name, position=position) for name in names}


def arrival_order(df: DataFrame, key: Sequence[str]) -> list[Column]:
    """What a frame is published in the order of: its lines, else its key and, for ties, all columns."""
    if LINE in df.columns:
        return [F.col(LINE)]
    return [F.col(c) for c in dict.fromkeys([*key, *df.columns])]


def read_page(
    df: DataFrame, order_by: Sequence[str | Column], limit: int = 1000, offset: int = 0, top_n: int | None = None
) -> DataFrame:
    """``limit`` rows after the first ``offset`` ones, in order.

    Rows the order leaves equal follow a hash of their content, so that pages of any offset fit together.
    ``top_n`` lowers the number of rows up to which a top-n cuts the page; that one ends in a single task, so a page
    that ends beyond ``TOP_N_LIMIT`` is cut by row numbers whatever it says.
    """
    if not order_by:
        raise ValueError("paging needs an order")
    if offset + limit <= min(TOP_N_LIMIT, TOP_N_LIMIT if top_n is None else top_n):
        tied = df.withColumn("__content", F.xxhash64(*df.columns))
        return tied.orderBy(*order_by, "__content").offset(offset).limit(limit).drop("__content")
    numbered = number_rows(df, order_by, "__row")
    return numbered.where(F.col("__row").between(offset, offset + limit - 1)).orderBy("__row").drop("__row")


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str, total: str | None = None
) -> DataFrame:
    """Consecutive numbers from 0 in a total order, without sorting in one task.

    ``total`` names a column for the number of all rows.

    Rows are ranged over tasks and sorted there; the numbers before each range come from the sizes of
    the ranges, one row per task. Rows the order leaves equal are told apart by their content, and
    copies of one row by their place, so that any number of them can be cut into ranges.
    """
    tied = df.withColumn("__content", F.xxhash64(*df.columns)).withColumn("__place", F.monotonically_increasing_id())
    full_order = [*order_by, "__content", "__place"]
    ranged = tied.repartitionByRange(*full_order).sortWithinPartitions(*full_order).drop("__content", "__place")
    # The id counts up within a partition, and its upper bits name the partition.
    placed = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    # A window without keys runs in one task; it sees one row per task of the range shuffle, and so
    # few rows are also fit to be broadcast.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "__part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"),
        *([F.sum("n").over(everything).alias(total)] if total is not None else []),
    )
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1))
        .drop("__part", "__before", "__id")
    )


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def read_sql(
    spark: SparkSession, query: str, tables: Mapping[str, DataFrame] | None = None, args: Mapping[str, object] | None = None
) -> DataFrame:
    """Any query, over given frames named in braces or over catalogue tables."""
    return spark.sql(query, args=dict(args or {}), **dict(tables or {}))


def read_jdbc_query(spark: SparkSession, source: Relational, query: str) -> DataFrame:
    """Any query, run by the database."""
    options = {"fetchsize": str(FETCH_SIZE), **source.options, "query": query}
    return spark.read.format("jdbc").options(**options).load()


def extract_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts by table, one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
