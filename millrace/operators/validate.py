"""Row validation: errors travel as columns of the row they belong to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.functions.plans import fence
from millrace.operators.rules import Finding, RuleContext, RuleRegistry, default_rules

ERRORS = "_errors"
FIXABLE_ERRORS = "_fixable_errors"
UNFIXABLE_ERRORS = "_unfixable_errors"
IS_VALID = "_is_valid"
CAN_FIX = "_can_fix"
FIELDS_VALIDATED = "_fields_validated"
RESULT_COLUMNS = (ERRORS, FIXABLE_ERRORS, UNFIXABLE_ERRORS, IS_VALID, CAN_FIX, FIELDS_VALIDATED)

ERROR_TYPE = (
    "struct<code:string,field:string,rule:string,message:string,value:string,"
    "can_fix:boolean,rule_can_fix:boolean,suggestion:string,suggested_value:string>"
)
_HELPER = "__v"


def _name(field: str, part: str) -> str:
    return f"{_HELPER}_{field}_{part}"


def _text(value: str | None) -> str:
    """A string literal; whole layers are written as one SQL text, which keeps plan building quick."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class _Check:
    """One rule whose conditions and values are already columns of the frame."""

    field: str
    findings: tuple[Finding, ...]
    # For each finding the SQL of its value, can_fix, suggestion and suggested value.
    parts: tuple[tuple[str, str, str, str], ...]

    @property
    def fails(self) -> str:
        return f"`{_name(self.field, 'fails')}`"

    @property
    def fixable(self) -> str:
        return f"`{_name(self.field, 'fixable')}`"

    def fires(self, i: int) -> str:
        return f"`{_name(self.field, f'fires{i}')}`"

    def fails_sql(self) -> str:
        return " OR ".join(self.fires(i) for i in range(len(self.findings))) or "false"

    def fixable_sql(self) -> str:
        blocking = [
            f"({self.fires(i)} AND NOT {can_fix})" for i, (_, can_fix, _, _) in enumerate(self.parts) if can_fix != "true"
        ]
        return f"NOT ({' OR '.join(blocking)})" if blocking else "true"

    def errors(self, unless: str | None = None) -> list[str]:
        built = []
        for i, (finding, (value, can_fix, suggestion, suggested)) in enumerate(zip(self.findings, self.parts)):
            condition = self.fires(i) if unless is None else f"{self.fires(i)} AND NOT {unless}"
            built.append(
                f"CASE WHEN {condition} THEN named_struct('code', {_text(finding.code)}, 'field', {_text(self.field)}, "
                f"'rule', {_text(finding.rule)}, 'message', {_text(finding.text())}, 'value', {value}, "
                f"'can_fix', {can_fix}, 'rule_can_fix', {self.fixable}, 'suggestion', {suggestion}, "
                f"'suggested_value', {suggested}) END"
            )
        return built


def _prepare(
    df: DataFrame, fields: Sequence[str], registry: RuleRegistry, context: RuleContext
) -> tuple[DataFrame, list[_Check]]:
    """Add helper values, then one flag per finding, then one verdict per rule.

    Each layer is a projection over the one before, so nothing is computed twice and no layer needs
    a shuffle.
    """
    rules = {f: registry.get(f) for f in fields}
    helpers: dict[str, dict[str, Column]] = {f: {} for f in fields}
    steps = {f: rule.prepare(F.col(f), context) for f, rule in rules.items()}
    for depth in range(max((len(s) for s in steps.values()), default=0)):
        added = {}
        for f in fields:
            if depth >= len(steps[f]):
                continue
            names = {}
            for name, expression in steps[f][depth].items():
                added[_name(f, name)] = expression(helpers[f]) if callable(expression) else expression
                names[name] = F.col(_name(f, name))
            helpers[f].update(names)
        df = df.withColumns(added)

    flags: dict[str, Column] = {}
    checks: list[_Check] = []
    never = F.lit(False)
    for f, rule in rules.items():
        findings = tuple(rule.findings(F.col(f), helpers[f], context))
        slots: dict[int, str] = {}

        def slot(part: Column | str | bool | None, cast: bool = True, f=f, slots=slots) -> str:
            """The SQL of one part of an error: a literal, or the helper column that holds it."""
            if isinstance(part, bool):
                return str(part).lower()
            if part is None or isinstance(part, str):
                return _text(part)
            if id(part) not in slots:
                slots[id(part)] = _name(f, f"part{len(slots)}")
                flags[slots[id(part)]] = part.cast("string") if cast else F.coalesce(part, never)
            return f"`{slots[id(part)]}`"

        parts = tuple(
            (slot(x.value), slot(x.can_fix, cast=False), slot(x.suggestion), slot(x.suggested_value)) for x in findings
        )
        for i, finding in enumerate(findings):
            flags[_name(f, f"fires{i}")] = F.coalesce(finding.fires, never)
        checks.append(_Check(f, findings, parts))
    verdicts = {}
    for check in checks:
        verdicts[_name(check.field, "fails")] = F.expr(check.fails_sql())
        verdicts[_name(check.field, "fixable")] = F.expr(check.fixable_sql())
    return (df.withColumns(flags).withColumns(verdicts) if checks else df), checks


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_HELPER + "_")])


def _context(df: DataFrame, as_of, status_context: str, table: str | None) -> RuleContext:
    if status_context not in ("record", "table"):
        raise ValueError("status_context is 'record' or 'table'")
    return RuleContext(df.schema, dates.as_of_column(as_of), status_context, table)


def _error_list(built: Sequence[str], passes: str) -> Column:
    empty = f"CAST(array() AS array<{ERROR_TYPE}>)"
    if not built:
        return F.expr(empty)
    # Rows without a failure, which are most, skip building the list.
    return F.expr(
        f"CASE WHEN `{passes}` THEN {empty} ELSE filter(array({', '.join(built)}), e -> e IS NOT NULL) END"
    )


def validate(
    df: DataFrame,
    registry: RuleRegistry | None = None,
    fields: Sequence[str] | None = None,
    as_of=None,
    status_context: str = "record",
    table: str | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Check every row against the rules of its columns, in column order.

    Adds the errors of the row, those errors split by whether their rule is fixable, the verdicts
    ``_is_valid`` and ``_can_fix``, and the checked columns. A row without errors "can be fixed".
    ``where`` picks the rows to check; other than a later filter it reaches the source.
    """
    if where is not None:
        df = df.where(where)
    registry = registry or default_rules()
    df = df.drop(*[c for c in RESULT_COLUMNS if c in df.columns])
    wanted = list(fields) if fields is not None else df.columns
    checked = [f for f in wanted if registry.has(f) and f in df.columns]
    out, checks = _prepare(df, checked, registry, _context(df, as_of, status_context, table))

    fails = " OR ".join(c.fails for c in checks) or "false"
    blocked = " OR ".join(f"({c.fails} AND NOT {c.fixable})" for c in checks) or "false"
    out = out.withColumns({IS_VALID: F.expr(f"NOT ({fails})"), CAN_FIX: F.expr(f"NOT ({blocked})")})
    out = out.withColumn(ERRORS, _error_list([e for c in checks for e in c.errors()], IS_VALID))
    return _drop_helpers(
        fence(out).withColumns(
            {
                FIXABLE_ERRORS: F.filter(ERRORS, lambda e: e["rule_can_fix"]),
                UNFIXABLE_ERRORS: F.filter(ERRORS, lambda e: ~e["rule_can_fix"]),
                FIELDS_VALIDATED: F.array(*[F.lit(f) for f in checked]).cast("array<string>"),
            }
        )
    ).select(*df.columns, *RESULT_COLUMNS)


def validation_summary(df: DataFrame) -> DataFrame:
    """One row of counts over a validated frame."""
    return df.agg(*summary_counts())


def summary_counts() -> list[Column]:
    """The counts of a validation run, also usable in ``observe``."""
    valid, fixable = F.col(IS_VALID), F.col(CAN_FIX)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        F.count_if(~valid & fixable).alias("fixable"),
        F.count_if(~valid & ~fixable).alias("unfixable"),
    ]


def validate_chain(
    df: DataFrame,
    chain: Sequence[str],
    registry: RuleRegistry | None = None,
    as_of=None,
    status_context: str = "record",
    table: str | None = None,
) -> DataFrame:
    """Check columns in a given order and stop at the first rule that fails beyond repair.

    Adds ``_chain_errors``, ``_chain_valid`` and ``_stopped_at``. Columns without a rule are skipped.
    """
    registry = registry or default_rules()
    order = [f for f in chain if registry.has(f)]
    missing = {f: F.lit(None).cast("string") for f in order if f not in df.columns}
    base = df.withColumns(missing) if missing else df
    context = _context(base, as_of, status_context, table)
    out, checks = _prepare(base, list(dict.fromkeys(order)), registry, context)
    by_field = {c.field: c for c in checks}

    stops = " ".join(
        f"WHEN {by_field[f].fails} AND NOT {by_field[f].fixable} THEN {_text(f)}" for f in dict.fromkeys(order)
    )
    out = out.withColumn("_stopped_at", F.expr(f"CASE {stops} END" if stops else _text(None)))
    errors: list[str] = []
    for i, f in enumerate(order):
        before = ", ".join(_text(x) for x in order[:i])
        stopped = f"coalesce(`_stopped_at` IN ({before}), false)" if before else None
        errors += by_field[f].errors(unless=stopped)
    fails = " OR ".join(c.fails for c in checks) or "false"
    out = out.withColumn("_chain_valid", F.expr(f"NOT ({fails})"))
    out = out.withColumn("_chain_errors", _error_list(errors, "_chain_valid"))
    return _drop_helpers(fence(out)).select(*df.columns, "_chain_errors", "_chain_valid", "_stopped_at")
