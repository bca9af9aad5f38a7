"""Rules and repairs written as plain Python, where no column expression says what they do.

Only the column in question goes to Python, in Arrow batches, and what comes back is held against the type and the
number of values that were promised. Everything around stays as it is, so one such function costs one exchange of
batches with the Python workers and no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.operators.rules import ColumnRule, Finding, RuleContext

Batch = Callable[[list[Any]], Sequence[Any]]


def for_each_value(function: Callable[[Any], Any]) -> Batch:
    """A function of one value as one of a batch; nulls are passed on as they are."""

    def batch(values: list[Any]) -> list[Any]:
        return [function(v) for v in values]

    return batch


def python_column(function: Batch, returns: T.DataType) -> Callable[[Column], Column]:
    """A function of a list of values as a function of a column.

    The list that comes back must have as many values, of the given type or null; anything else fails the job and
    names the function.
    """
    name = getattr(function, "__qualname__", repr(function))
    kind = to_arrow_type(returns)

    @F.arrow_udf(returns)
    def run(values: pa.Array) -> pa.Array:
        found = list(function(values.to_pylist()))
        if len(found) != len(values):
            raise ValueError(f"{name} returned {len(found)} values for {len(values)}")
        try:
            return pa.array(found, kind)
        except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError) as error:
            raise TypeError(f"{name} returned what is no {returns.simpleString()}: {error}") from error

    return run


def python_rule(
    field: str, is_broken: Callable[[Any], bool], rule: str, code: str, message: str, can_fix: bool = False
) -> ColumnRule:
    """A rule that fires where a plain function of the value says so; a null answer does not fire."""
    broken = python_column(for_each_value(is_broken), T.BooleanType())

    def check(value: Column, context: RuleContext) -> Sequence[Finding]:
        return [Finding(rule, code, F.coalesce(broken(value), F.lit(False)), value.cast("string"), can_fix, message=message)]

    return ColumnRule(field, check)


def python_repair(function: Callable[[Any], Any], returns: T.DataType = T.StringType()) -> Callable[[Column], Column]:
    """A repair that is a plain function of the value, for :meth:`RepairRegistry.add`."""
    return python_column(for_each_value(function), returns)
