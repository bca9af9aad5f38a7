"""Predicates that cut a table into parts of about the same size, whatever its key looks like.

Equal ranges of a skewed key give unequal reads. The bounds here are quantiles of the key, from one aggregation with a
sketch in every task; null keys and values that fill whole parts on their own are apart, and are cut by a second column
where one is given.
"""

from __future__ import annotations

import datetime
import decimal
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(value: object) -> str:
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    kind = "TIMESTAMP" if isinstance(value, datetime.datetime) else "DATE"
    return f"{kind} '{value}'"


def split_predicates(df: DataFrame, column: str, splits: int, spread: str | None = None, accuracy: int = 10_000) -> list[str]:
    """Conditions on a column of numbers, dates or timestamps, about ``splits`` of them, each true for about as many rows, and every row in exactly one.

    ``spread`` names a column of whole numbers, such as a row id, that cuts a value which would fill several parts; a
    null in it counts as 0. Without it such a value is one part. The conditions fit ``predicates`` of a JDBC read, or
    a filter of any other. An empty table has the single condition ``1 = 1``.
    """
    if splits < 1:
        raise ValueError("a table has one part at least")
    if not isinstance(df.schema[column].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{column} has no quantiles: numbers, dates and timestamps have")
    key = F.col(column)
    shares = [k / splits for k in range(splits)]
    bounds = F.percentile_approx(key, shares, accuracy)
    seen = df.agg(bounds.alias("bounds"), F.count(F.lit(1)).alias("n"), F.count(key).alias("known")).first()
    if not seen["n"]:
        return ["1 = 1"]
    each = max(1, math.ceil(seen["n"] / splits))

    def cut(condition: str, rows: float) -> list[str]:
        parts = min(splits, round(rows / each)) if spread else 1
        if parts < 2:
            return [condition]
        number = f"MOD(ABS(COALESCE({spread}, 0)), {parts})"
        return [f"{condition} AND {number} = {k}" for k in range(parts)]

    out = []
    if seen["n"] > seen["known"]:
        out += cut(f"{column} IS NULL", seen["n"] - seen["known"])
    found = list(seen["bounds"] or [])
    places = list(dict.fromkeys(found))
    # A value that is the bound of several parts fills them.
    per_bound = seen["known"] / splits
    hot = {v for v in places if found.count(v) > 1}
    edges: list[tuple[str, str]] = []
    for value in places[0 if places and places[0] in hot else 1 :]:
        text = _literal(value)
        if value in hot:
            out += cut(f"{column} = {text}", found.count(value) * per_bound)
            edges.append((f"{column} < {text}", f"{column} > {text}"))
        else:
            edges.append((f"{column} < {text}", f"{column} >= {text}"))
    if places:
        lower = ["", *(above for _, above in edges)]
        upper = [*(below for below, _ in edges), ""]
        for a, b in zip(lower, upper, strict=True):
            out.append(" AND ".join(x for x in (a, b) if x) or f"{column} IS NOT NULL")
    return out
