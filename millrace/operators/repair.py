"""Repair of validated rows, with a log of every change."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates, text
from millrace.functions.plans import fence
from millrace.operators.repairs import RepairContext, RepairRegistry, Repairer, default_repairs
from millrace.operators.rules import is_text_flag
from millrace.operators.validate import ERRORS

CHANGES = "_changes"
CHANGED = "_changed"
ORIGINAL = "_original"
CHANGE_TYPE = "struct<field:string,original:string,transformed:string,action:string,note:string>"

# A row that has this column always gets its customer type settled, errors or not.
_TYPE_FIELD, _TYPE_MARKER = "loai_khach_hang", "ngay_dang_ky"


def _is_dated(df: DataFrame, field: str) -> bool:
    return isinstance(df.schema[field].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _has_fixable(errors: Column, field: str) -> Column:
    return F.exists(errors, lambda e: (e["field"] == field) & e["rule_can_fix"])


def _change(repairer: Repairer, original: Column, repaired: Column) -> Column:
    return F.struct(
        F.lit(repairer.field).alias("field"),
        repairer.shown(original).alias("original"),
        repaired.alias("transformed"),
        repairer.action(original).alias("action"),
        repairer.note(original).alias("note"),
    )


def repair(df: DataFrame, registry: RepairRegistry | None = None, as_of=None) -> DataFrame:
    """Repair every column that has a fixable error and a repairer, in each row on its own.

    A column is repaired even where another column of the row is beyond repair. Adds the log
    ``_changes``, the flag ``_changed`` and ``_original`` with the repaired columns as they were.
    A date column comes back as text, with a flag column telling which rows hold a repaired text.
    """
    registry = registry or default_repairs()
    context = RepairContext(dates.as_of_column(as_of))
    errors = F.col(ERRORS)
    fields = [f for f in registry.fields() if f in df.columns]
    fields = [f for f in df.columns if f in fields]

    # First which columns to repair, then the repaired texts, then what has changed.
    needs, repaired, flags = {}, {}, {}
    for f in fields:
        if f == _TYPE_FIELD and _TYPE_MARKER in df.columns:
            needs[f"__need_{f}"] = F.lit(True)
        else:
            needs[f"__need_{f}"] = _has_fixable(errors, f)
        original = F.col(f).cast("string")
        repaired[f"__new_{f}"] = F.when(
            F.col(f"__need_{f}"), registry.get(f)(F.col(f), errors, context)
        ).otherwise(original)
    for f in fields:
        before, after = F.col(f).cast("string"), F.col(f"__new_{f}")
        # A date that became text has changed even where it reads the same.
        flags[f"__diff_{f}"] = F.col(f"__need_{f}") if _is_dated(df, f) else ~before.eqNullSafe(after)
    out = df.withColumns(needs).withColumns(repaired).withColumns(flags) if fields else df

    # The customer type comes first in the log, then the columns in the order of their errors.
    logged = sorted(fields, key=lambda f: f != _TYPE_FIELD or _TYPE_MARKER not in df.columns)
    entries = [
        F.when(
            F.col(f"__diff_{f}"),
            _change(registry.get(f), F.col(f).cast("string"), F.col(f"__new_{f}")),
        )
        for f in logged
    ]
    changed = F.lit(False)
    for f in fields:
        changed = changed | F.col(f"__diff_{f}")
    none = F.array().cast(f"array<{CHANGE_TYPE}>")
    log = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else none

    columns: list[Column] = []
    for c in df.columns:
        columns.append(F.col(f"__new_{c}").alias(c) if c in fields else F.col(c))
        if c in fields and _is_dated(df, c):
            columns.append(F.col(f"__need_{c}").alias(is_text_flag(c)))
    # A struct without fields could not be written, hence the placeholder.
    kept = [F.col(f).cast("string").alias(f) for f in fields] or [F.lit(None).cast("string").alias("_none")]
    original = F.struct(*kept)
    return fence(
        out.select(
            *columns,
            F.when(changed, log).otherwise(none).alias(CHANGES),
            changed.alias(CHANGED),
            original.alias(ORIGINAL),
        )
    )


def repair_summary(df: DataFrame) -> DataFrame:
    """One row of counts over a repaired frame."""
    return df.agg(*repair_counts())


def repair_counts() -> list[Column]:
    changed = F.col(CHANGED)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(changed).alias("transformed"),
        F.count_if(~changed).alias("skipped"),
    ]


def apply_strategy(df: DataFrame, field: str, function: Callable[[Column], Column]) -> DataFrame:
    """Replace one column by a function of itself and flag the rows where that made a difference."""
    value = function(F.col(field))
    return (
        df.withColumn("__new", value)
        .withColumn(CHANGED, ~F.col(field).eqNullSafe(F.col("__new")))
        .withColumn(field, F.col("__new"))
        .drop("__new")
    )


def apply_sequence(
    df: DataFrame, fields: Sequence[str], registry: RepairRegistry | None = None, as_of=None
) -> DataFrame:
    """Run the repairers of the named columns in order, on all rows; names without one are skipped."""
    registry = registry or default_repairs()
    context = RepairContext(dates.as_of_column(as_of))
    for f in fields:
        if registry.has(f):
            value = F.col(f) if f in df.columns else F.lit(None).cast("string")
            df = df.withColumn(f, registry.get(f)(value, None, context))
    return df


def apply_conditional(
    df: DataFrame,
    conditions: Mapping[str, Column],
    registry: RepairRegistry | None = None,
    as_of=None,
) -> DataFrame:
    """Repair each named column in the rows where its condition holds, all judged on the input row."""
    registry = registry or default_repairs()
    context = RepairContext(dates.as_of_column(as_of))
    replaced = {
        f: F.when(condition, registry.get(f)(F.col(f), None, context)).otherwise(F.col(f).cast("string"))
        for f, condition in conditions.items()
        if registry.has(f)
    }
    return df.withColumns(replaced) if replaced else df


def repair_column(
    df: DataFrame,
    field: str,
    registry: RepairRegistry | None = None,
    errors: str | None = None,
    as_of=None,
) -> DataFrame:
    """Run one repairer over a whole column, whatever validation said.

    Names and mail addresses are only touched where present; the customer type only in tables that
    have a customer id. ``errors`` names the error column to hand to the repairer.
    """
    registry = registry or default_repairs()
    if field not in df.columns or (field == _TYPE_FIELD and "ma_khach_hang" not in df.columns):
        return df
    context = RepairContext(dates.as_of_column(as_of))
    value = F.col(field).cast("string")
    repaired = registry.get(field)(value, F.col(errors) if errors else None, context)
    if field in ("ho_ten", "email"):
        repaired = F.when(text.is_blank(value), value).otherwise(repaired)
    return df.withColumn(field, repaired)
