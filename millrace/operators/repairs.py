"""Repairers: each turns one column into its repaired text.

A repairer sees the value and, when it runs after validation, the error list of the row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.functions import dates, text


@dataclass(frozen=True)
class RepairContext:
    as_of: Column


def _fixed(label: str) -> Callable[[Column], Column]:
    return lambda original: F.lit(label)


def _no_note(original: Column) -> Column:
    return F.lit(None).cast("string")


def _as_is(original: Column) -> Column:
    return original


def _null_as_text(original: Column) -> Column:
    return F.coalesce(F.nullif(original, F.lit("")), F.lit("null"))


@dataclass(frozen=True)
class Repairer:
    """``function(value, errors, context)`` gives the repaired text; the rest describes the log entry."""

    field: str
    function: Callable[[Column, Column | None, RepairContext], Column]
    action: Callable[[Column], Column]
    shown: Callable[[Column], Column] = _as_is
    note: Callable[[Column], Column] = _no_note

    def __call__(self, value: Column, errors: Column | None, context: RepairContext) -> Column:
        return self.function(value.cast("string"), errors, context)


def has_error(errors: Column | None, field: str, rule: str) -> Column:
    if errors is None:
        return F.lit(False)
    return F.exists(errors, lambda e: (e["field"] == field) & (e["rule"] == rule))


def first_suggestion(errors: Column | None, field: str) -> Column:
    """The value the first error with a suggestion proposes for a column."""
    if errors is None:
        return F.lit(None).cast("string")
    offered = F.filter(errors, lambda e: (e["field"] == field) & e["suggested_value"].isNotNull())
    return F.get(offered, F.lit(0))["suggested_value"]


def repair_name(value: Column, errors: Column | None = None, context: RepairContext | None = None) -> Column:
    """Tidy spaces and capitals, spell out one-letter words, undo wrong decoding, add a surname."""
    longer = F.create_map(*[F.lit(x) for pair in C.NAME_ABBREVIATIONS.items() for x in pair])

    def word(w: Column, position: Column) -> Column:
        spelled_out = F.when((position > 0) & (F.length(w) == 1), F.try_element_at(longer, F.lower(w)))
        return F.coalesce(spelled_out, text.capitalize_word(w))

    name = F.array_join(F.transform(F.split(text.collapse_spaces(value), " "), word), " ")
    for wrong, right in C.NAME_MOJIBAKE.items():
        name = F.replace(name, F.lit(wrong), F.lit(right))
    if errors is not None:
        lonely = (F.instr(name, " ") == 0) & has_error(errors, "ho_ten", "name_min_words")
        name = F.when(lonely, F.concat(F.lit(C.DEFAULT_SURNAME + " "), name)).otherwise(name)
    return F.when(~text.is_blank(value), name)


def repair_email(value: Column, errors: Column | None = None, context: RepairContext | None = None) -> Column:
    """Drop whitespace, lower the case and correct known wrong domains."""
    email = F.lower(text.remove_spaces(value))
    for wrong, right in C.EMAIL_TYPOS.items():
        email = text.replace_first(email, wrong, right)
    return F.when(~text.is_blank(value), email)


def repair_birth_date(value: Column, errors: Column | None = None, context: RepairContext | None = None) -> Column:
    """The day in ISO form; the default day where the value is missing or no date."""
    day = F.date_format(dates.parse_any_date(value), "yyyy-MM-dd")
    return F.coalesce(day, F.lit(C.DEFAULT_BIRTH_DATE))


def repair_birth_date_by_age(value: Column, errors: Column | None, context: RepairContext) -> Column:
    """As :func:`repair_birth_date`, and the default day also where the age is implausible."""
    day = dates.parse_any_date(value)
    plausible = dates.age_in_years(day, context.as_of).between(C.MIN_AGE, C.MAX_AGE) & (
        F.year(day) >= C.MIN_BIRTH_YEAR
    )
    return F.coalesce(F.when(plausible, F.date_format(day, "yyyy-MM-dd")), F.lit(C.DEFAULT_BIRTH_DATE))


def repair_customer_type(value: Column, errors: Column | None = None, context: RepairContext | None = None) -> Column:
    """The listed spelling of a known type; the default for all else."""
    spelled = F.create_map(*[F.lit(x) for v in C.CUSTOMER_TYPES for x in (v.lower(), v)])
    known = F.try_element_at(spelled, F.lower(text.trim(value)))
    return F.coalesce(known, F.lit(C.DEFAULT_CUSTOMER_TYPE))


def repair_status(value: Column, errors: Column | None = None, context: RepairContext | None = None) -> Column:
    """The value validation proposed, otherwise a capital first letter."""
    proposed = first_suggestion(errors, "trang_thai")
    return F.when(text.is_blank(value), value).otherwise(F.coalesce(proposed, text.capitalize_first(value)))


def _missing(original: Column, missing: str, present: str) -> Column:
    return F.when(text.is_blank(original), F.lit(missing)).otherwise(F.lit(present))


NAME = Repairer("ho_ten", repair_name, _fixed("capitalize_and_normalize"))
EMAIL = Repairer("email", repair_email, _fixed("lowercase_and_normalize"))
STATUS = Repairer("trang_thai", repair_status, _fixed("normalize_status"))
CUSTOMER_TYPE = Repairer(
    "loai_khach_hang",
    repair_customer_type,
    lambda o: _missing(o, "set_default_value", "normalize"),
    _null_as_text,
)
BIRTH_DATE = Repairer(
    "ngay_sinh",
    repair_birth_date,
    lambda o: _missing(o, "set_default_date", "format_date_to_yyyy_mm_dd"),
    _null_as_text,
)
BIRTH_DATE_BY_AGE = Repairer(
    "ngay_sinh",
    repair_birth_date_by_age,
    lambda o: _missing(o, "set_default_date", "format_and_validate_date"),
    _null_as_text,
    lambda o: _missing(o, f"Default date: {C.DEFAULT_BIRTH_DATE}", "Parsed and formatted"),
)


class RepairRegistry:
    """One repairer per column; a later one replaces an earlier one."""

    def __init__(self, repairers: Sequence[Repairer] = ()):
        self._repairers: dict[str, Repairer] = {}
        for repairer in repairers:
            self.add(repairer.field, repairer)

    def add(self, field: str, repairer: Repairer | Callable[[Column], Column]) -> None:
        """Register a repairer, or a plain function of the value."""
        if not isinstance(repairer, Repairer):
            plain = repairer
            repairer = Repairer(field, lambda value, errors, context: plain(value), _fixed("custom"))
        self._repairers[field] = repairer

    def get(self, field: str) -> Repairer | None:
        return self._repairers.get(field)

    def has(self, field: str) -> bool:
        return field in self._repairers

    def fields(self) -> list[str]:
        return list(self._repairers)


def default_repairs(by_age: bool = False) -> RepairRegistry:
    """Five columns can be repaired; ``by_age`` selects the birth-date repair that checks the age."""
    birth_date = BIRTH_DATE_BY_AGE if by_age else BIRTH_DATE
    return RepairRegistry([EMAIL, NAME, CUSTOMER_TYPE, birth_date, STATUS])
