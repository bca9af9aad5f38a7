"""Pages of a table that is sorted once: a page opens only the ranges of rows it lies in.

:func:`millrace.sources.tables.read_page` sorts for every page. Where a table is paged through, or many readers page
in it, one sorted copy in ranges of equal size pays: the place of a row says its range, and a small directory of
boundaries says where a key stands.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.load import read_pointer, swap_pointer
from millrace.sources.tables import number_rows

ROW, RANGE = "_row", "_range"
#: Ranges lie in this many folders at most, several of them in one if need be: small ranges of a large table would be
#: a file each otherwise.
MAX_FOLDERS = 256


class PageDirectory:
    """A sorted copy below ``root``: rows by range, and one line for each range with its first and last key."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        state = read_pointer(spark, self.root)
        if state is None:
            raise FileNotFoundError(f"no page directory below {root}")
        self.order: list[str] = state["order"]
        self.rows_per_range: int = state["rows_per_range"]
        self.total: int = state["total"]
        self.rows_per_folder: int = state.get("rows_per_folder", self.rows_per_range)
        self.schema = T.StructType.fromJson(json.loads(state["schema"]))

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[str], root: str, rows_per_range: int = 1 << 20) -> PageDirectory:
        """Sort a frame by columns, ties by content, and write it in ranges of ``rows_per_range`` rows.

        A range holds the same rows however many tasks wrote it, and copies of one row may fill any number of ranges.
        Ranges beyond ``MAX_FOLDERS`` share folders; within one, rows are sorted, so that their places prune the reads.
        """
        if not order:
            raise ValueError("paging needs an order")
        spark, root = df.sparkSession, root.rstrip("/")
        numbered = number_rows(df, list(order), ROW)
        # The rows are materialised by now; counting them again is a read of no column.
        total = numbered.count()
        ranges = -(-total // rows_per_range)
        rows_per_folder = rows_per_range * max(1, -(-ranges // MAX_FOLDERS))
        # Tasks hold consecutive rows, so only folders at their borders are written by two of them.
        numbered.withColumn(RANGE, F.floor(F.col(ROW) / rows_per_folder)).write.partitionBy(RANGE).parquet(f"{root}/rows")
        key = F.struct(*order)
        rows = spark.read.schema(numbered.schema.add(RANGE, T.LongType())).parquet(f"{root}/rows")
        place = F.floor(F.col(ROW) / rows_per_range).alias(RANGE)
        borders = rows.groupBy(place).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
        borders.write.parquet(f"{root}/directory")
        state = {"order": list(order), "rows_per_range": rows_per_range, "rows_per_folder": rows_per_folder, "total": total}
        swap_pointer(spark, root, {**state, "schema": df.schema.json()})
        return cls(spark, root)

    @staticmethod
    def _directory(spark: SparkSession, root: str) -> DataFrame:
        return spark.read.parquet(f"{root}/directory")

    def directory(self) -> DataFrame:
        """(range, n, first, last): how many rows each range has, and its first and last key."""
        return self._directory(self.spark, self.root).select(F.col(RANGE).alias("range"), "n", "first", "last")

    def _rows(self, first: int, last: int) -> DataFrame:
        """The rows from one place to another; the filter on folders keeps all others closed."""
        schema = T.StructType([*self.schema.fields, T.StructField(ROW, T.LongType()), T.StructField(RANGE, T.LongType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/rows")
        size = self.rows_per_folder
        return rows.where(F.col(RANGE).between(first // size, last // size) & F.col(ROW).between(first, last)).drop(RANGE)

    def page(self, limit: int, offset: int = 0, row: str | None = None) -> DataFrame:
        """``limit`` rows after the first ``offset`` ones, in order; ``row`` names a column for their places."""
        if limit <= 0 or offset >= self.total:
            return self._rows(0, 0).where(F.lit(False)).drop(ROW) if row is None else self._rows(0, 0).where(F.lit(False)).withColumnRenamed(ROW, row)
        rows = self._rows(offset, min(offset + limit, self.total) - 1).orderBy(ROW)
        return rows.drop(ROW) if row is None else rows.withColumnRenamed(ROW, row)

    def place_after(self, key: Sequence[object]) -> int:
        """How many rows have a key up to and including the given one: the offset of the page after it."""
        if len(key) != len(self.order):
            raise ValueError(f"a key has the columns {self.order}")
        if not self.total:
            return 0
        fields = {f.name: f.dataType for f in self.schema}
        given = [F.lit(value).cast(fields[c]) for c, value in zip(self.order, key, strict=True)]
        whole = self.directory().where(_not_after([F.col(f"last.`{c}`") for c in self.order], given)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if whole >= self.total:
            return whole
        # Ranges before this one lie within the key as a whole; of this one its rows are looked at.
        size = self.rows_per_range
        part = self._rows(whole, min(whole + size, self.total) - 1)
        return whole + part.where(_not_after([F.col(f"`{c}`") for c in self.order], given)).count()

    def page_after(self, key: Sequence[object], limit: int) -> DataFrame:
        """The page of the rows behind a key, as readers ask who remember the last key they saw."""
        return self.page(limit, self.place_after(key))


def _not_after(columns: Sequence[Column], key: Sequence[Column]) -> Column:
    """Columns stand before a key or at it, nulls first, column by column."""
    before, same = [], F.lit(True)
    for c, k in zip(columns, key, strict=True):
        smaller = F.coalesce(c < k, c.isNull() & k.isNotNull())
        before.append(same & smaller)
        same = same & c.eqNullSafe(k)
    return reduce(lambda a, b: a | b, before, same)
