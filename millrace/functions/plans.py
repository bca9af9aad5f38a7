"""Help for the optimizer with deep projections."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    """Keep later filters and projections from being copied into the projections below.

    A filter on a verdict would otherwise be pushed down by writing out, once per mention, every
    expression the verdict is made of, and a few layers of that no longer fit into memory. A row
    count observed on the way stops this; unused columns are still pruned through it.
    """
    return df.observe(f"fence-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def spread(df: DataFrame, by: str) -> DataFrame:
    """Deal rows out to all tasks by a column that tells them apart.

    A file of one row group is read by one task, however many rows it holds, and judging or repairing a row costs
    far more than moving it.
    """
    return df.repartition(F.col(by))


def zero_of(*columns: str) -> Column:
    """Zero, computed from columns so that the planner takes it for a value like any other.

    As a further join key on a side that an aggregation has already partitioned, it makes the planner
    exchange that side for the join itself. Adaptive execution splits hot keys only of a join that
    reads straight from exchanges.
    """
    return F.pmod(F.hash(*[F.col(c) for c in columns]), F.lit(1))
