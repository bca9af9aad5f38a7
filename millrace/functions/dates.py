"""Strict date parsing and age in whole years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"

# The accepted layouts in order of preference, each with the shape that keeps the
# parser strict about the number of digits.
DATE_LAYOUTS = (
    ("yyyy-MM-dd", ISO_DAY),
    ("dd/MM/yyyy", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"),
    ("MM/dd/yyyy", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"),
    ("dd-MM-yyyy", r"^[0-9]{2}-[0-9]{2}-[0-9]{4}\z"),
    ("yyyy/MM/dd", r"^[0-9]{4}/[0-9]{2}/[0-9]{2}\z"),
)
# Other ISO 8601 forms of a day: basic, ordinal and month.
ISO_LAYOUTS = (
    ("yyyyMMdd", r"^[0-9]{8}\z"),
    ("yyyy-DDD", r"^[0-9]{4}-[0-9]{3}\z"),
    ("yyyy-MM", r"^[0-9]{4}-[0-9]{2}\z"),
)
ISO_DATE_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?Z?\z"


def _parse(c: Column, layouts) -> list[Column]:
    return [F.when(c.rlike(shape), F.try_to_date(c, layout)) for layout, shape in layouts]


def parse_iso_date(c: Column) -> Column:
    """The day of an ISO 8601 text, with or without a time; null where it is none."""
    return F.coalesce(
        F.when(c.rlike(ISO_DAY), F.try_to_date(c, "yyyy-MM-dd")),
        *_parse(c, ISO_LAYOUTS),
        F.when(c.rlike(ISO_DATE_TIME), F.to_date(F.replace(c, F.lit(","), F.lit(".")).try_cast("timestamp_ntz"))),
    )


def parse_any_date(c: Column) -> Column:
    """The first accepted layout that fits; day before month where both would."""
    return F.coalesce(*_parse(c, DATE_LAYOUTS), parse_iso_date(c))


def age_in_years(birth_date: Column, as_of: Column) -> Column:
    """Whole years between two days, cut toward zero."""
    return (F.months_between(as_of, birth_date) / 12).cast("int")


def as_of_column(as_of) -> Column:
    """The reference day of age rules: a given date, ISO text or column; today by default."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")
