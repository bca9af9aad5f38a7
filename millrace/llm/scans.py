"""Running totals in a global order, without a task that sees more than its own range."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import small_batches
from millrace.session import cut_lineage


class _Totals:
    """Totals since the key of the rows last changed, over the batches of one task."""

    def __init__(self, key: str | None, sums: Sequence[str], xors: Sequence[str]):
        self.key, self.columns = key, [*[(c, np.add) for c in sums], *[(c, np.bitwise_xor) for c in xors]]
        self.now: tuple | None = None
        self.totals = [0] * len(self.columns)
        self.first: tuple | None = None
        self.single = True

    def before(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        """For each column, the total of the earlier rows of a row's key."""
        n = batch.num_rows
        new = np.zeros(n, bool)
        new[0] = True
        if self.key is None:
            keys, nulls = np.zeros(n, np.int64), np.zeros(n, bool)
        else:
            column = batch.column(self.key)
            keys, nulls = column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
        new[1:] = (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        head, last = (bool(nulls[0]), int(keys[0])), (bool(nulls[-1]), int(keys[-1]))
        if self.first is None:
            self.first = head
        carried = self.totals if head == self.now else [0] * len(self.columns)
        self.single &= last == self.first and len(starts) == 1
        out, totals = [], []
        for (name, add), carry in zip(self.columns, carried, strict=True):
            values = batch.column(name).to_numpy().astype(np.int64)
            through = add.accumulate(values)
            earlier = np.concatenate([[0], through[:-1]])
            base = earlier[starts]
            base = base.copy()
            if add is np.add:
                within = earlier - base[run]
                within[run == 0] += carry
                totals.append(int(within[-1] + values[-1]))
            else:
                within = earlier ^ base[run]
                within[run == 0] ^= carry
                totals.append(int(within[-1] ^ values[-1]))
            out.append(within)
        self.now, self.totals = last, totals
        return out


def running(
    df: DataFrame, order: Sequence[str], sums: Sequence[str] = (), xors: Sequence[str] = (), key: str | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """The frame with ``NAME_before`` for each column of longs: its sum, or exclusive or, over the earlier rows.

    Rows follow the order within each value of ``key``, a column of longs that may hold nulls; without a key all rows
    are one run. Rows that the order leaves equal stand in any order. ``drop`` names columns that only the order
    needs. The rows are ranged over the tasks by key, order and place, so that one key, and also copies of one row,
    may spread over any number of tasks; one row of each task goes through the driver.
    """
    spark = df.sparkSession
    small_batches(spark)
    full = [*([key] if key else []), *order, "_place"]
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*full).sortWithinPartitions(*full).drop("_place", *drop)
    placed = cut_lineage(placed.withColumn("_part", F.spark_partition_id()))
    values = [*sums, *xors]

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, part = _Totals(key, sums, xors), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column("_part")[0].as_py()
                totals.before(batch)
        if part is not None:
            row = {"part": part, "first": [int(x) for x in totals.first], "last": [int(x) for x in totals.now], "single": totals.single, "totals": totals.totals}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("single", pa.bool_()), ("totals", pa.list_(pa.int64()))]))

    needed = placed.select("_part", *([key] if key else []), *values)
    carried: dict[int, tuple[tuple, list[int]]] = {}
    now, totals = None, [0] * len(values)
    for row in sorted(needed.mapInArrow(ends, "part int, first array<long>, last array<long>, single boolean, totals array<long>").collect(), key=lambda r: r["part"]):
        first, last = (bool(row["first"][0]), row["first"][1]), (bool(row["last"][0]), row["last"][1])
        carry = totals if first == now else [0] * len(values)
        carried[row["part"]] = (first, carry)
        both = zip(row["totals"], carry, range(len(values)), strict=True)
        totals = [(t + c if k < len(sums) else t ^ c) for t, c, k in both] if row["single"] else row["totals"]
        now = last
    shared = spark.sparkContext.broadcast(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            if batch.num_rows:
                if totals is None:
                    totals = _Totals(key, sums, xors)
                    totals.now, totals.totals = shared.value[batch.column("_part")[0].as_py()]
                before = totals.before(batch)
                kept = [batch.schema.get_field_index(c) for c in names]
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], *[pa.array(b) for b in before]], names=[*names, *[f"{c}_before" for c in values]])

    names = [c for c in placed.columns if c != "_part"]
    schema = T.StructType([*[placed.schema[c] for c in names], *[T.StructField(f"{c}_before", T.LongType()) for c in values]])
    return placed.mapInArrow(run, schema)
