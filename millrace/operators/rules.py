"""Validation rules: each turns one column into a list of findings.

A rule describes its work in two steps. ``prepare`` names the values it needs more than once, so
that the plan computes them once per row; ``findings`` lists what can be wrong, as conditions over
them. A finding is one error of a row; a rule as a whole is fixable when all its fired findings are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.functions import dates, text
from millrace.functions.text import WS


@dataclass(frozen=True)
class RuleContext:
    """What a rule may know besides its own column."""

    schema: T.StructType
    as_of: Column
    status_context: str = "record"
    table: str | None = None

    def has(self, name: str) -> bool:
        return name in self.schema.fieldNames()

    def dtype(self, name: str) -> T.DataType:
        return self.schema[name].dataType


@dataclass(frozen=True)
class Finding:
    rule: str
    code: str
    fires: Column
    value: Column
    can_fix: Column | bool = False
    suggestion: Column | str | None = None
    suggested_value: Column | None = None
    message: str | None = None

    def text(self) -> str:
        return self.message if self.message is not None else C.MESSAGES[self.rule]


class Rule:
    field: str

    def prepare(self, value: Column, context: RuleContext) -> list[dict[str, Column | Callable]]:
        """Named helper values, in steps; a later step may use the names of an earlier one."""
        return []

    def findings(
        self, value: Column, helper: Mapping[str, Column], context: RuleContext
    ) -> Sequence[Finding]:
        raise NotImplementedError


@dataclass(frozen=True)
class ColumnRule(Rule):
    """A rule given as one function of the column and its context."""

    field: str
    function: Callable[[Column, RuleContext], Sequence[Finding]] = dataclass_field(repr=False)

    def findings(self, value, helper, context):
        return self.function(value, context)


def _suggest(rule: str, value: Column | None = None) -> Column | str:
    """What an error proposes to do, followed by the value it proposes, if any."""
    words = C.SUGGESTIONS[rule]
    return words if value is None else F.concat(F.lit(words), value)


# Characters no name may have, as they stand inside a character class.
NAME_SPECIAL = r"""!@#$%^&*()_+=\[\]{};':"\\|,.<>?"""
# A word that starts with a character of a kind some of which have a capital form of their own.
_UNCAPITAL_WORD = rf"(?:^|[{WS}])[\p{{Ll}}\p{{Lt}}\p{{Nl}}\p{{So}}\p{{Mn}}]"


class NameRule(Rule):
    def __init__(self, field: str = "ho_ten"):
        self.field = field

    def prepare(self, value, context):
        # Most names pass, so one test each tells whether the finer ones are needed at all.
        return [
            {"t": text.trim_to_null(value.cast("string"))},
            {
                "odd": lambda h: h["t"].rlike(rf"[0-9{NAME_SPECIAL}]"),
                "initials": lambda h: F.when(h["t"].rlike(_UNCAPITAL_WORD), text.word_initials(h["t"])),
            },
        ]

    def findings(self, value, helper, context):
        t, odd, initials = helper["t"], helper["odd"], helper["initials"]
        one_letter_word = f"(?:^|[{WS}])[^{WS}\\x{{10000}}-\\x{{10FFFF}}](?:[{WS}]|\\z)"
        return [
            Finding("name_blank", C.NULL_VALUE, t.isNull(), value),
            Finding("name_digits", C.INVALID_FORMAT, odd & t.rlike("[0-9]"), t),
            Finding("name_special", C.INVALID_FORMAT, odd & t.rlike(f"[{NAME_SPECIAL}]"), t),
            Finding("name_length", C.OUT_OF_RANGE, F.length(t) > C.MAX_NAME_LENGTH, t),
            Finding(
                "name_min_words", C.INVALID_FORMAT, ~t.rlike(f"[{WS}]"), t, True, _suggest("name_min_words")
            ),
            Finding(
                "name_abbreviated", C.INVALID_FORMAT, (F.length(t) > 20) & t.rlike(one_letter_word), t
            ),
            Finding(
                "name_capitals",
                C.INVALID_FORMAT,
                initials != F.upper(initials),
                t,
                True,
                _suggest("name_capitals"),
            ),
        ]


class EmailRule(Rule):
    def __init__(self, field: str = "email"):
        self.field = field

    def prepare(self, value, context):
        return [
            {"t": F.lower(text.trim_to_null(value.cast("string")))},
            {"wrong": lambda h: ~h["t"].rlike(C.EMAIL_PATTERN)},
        ]

    def findings(self, value, helper, context):
        # What the pattern admits has no space, one @ between two sides, a dot and no odd character.
        t, wrong = helper["t"], helper["wrong"]
        return [
            Finding("email_blank", C.NULL_VALUE, t.isNull(), value),
            Finding("email_pattern", C.INVALID_FORMAT, wrong, t),
            Finding("email_length", C.OUT_OF_RANGE, F.length(t) > C.MAX_EMAIL_LENGTH, t),
            Finding("email_space", C.INVALID_FORMAT, wrong & t.rlike(f"[{WS}]"), t, True, _suggest("email_space")),
            Finding("email_sides", C.INVALID_FORMAT, wrong & t.rlike(r"(?s)\A@|@\z|@.*@"), t),
            Finding("email_domain", C.INVALID_FORMAT, wrong & t.rlike(r"\A[^@]*@[^@.]+(?:@|\z)"), t),
            Finding("email_chars", C.INVALID_FORMAT, wrong & t.rlike(r'[<>()\[\]\\,;:"]'), t),
        ]


class PhoneRule(Rule):
    def __init__(self, field: str = "so_dien_thoai"):
        self.field = field

    def findings(self, value, helper, context):
        phone = value.cast("string")
        wrong = (phone != "") & ~phone.rlike(C.PHONE_PATTERN)
        return [
            Finding("phone_pattern", C.INVALID_FORMAT, wrong, phone, True, _suggest("phone_pattern")),
        ]


class PriceRule(Rule):
    def __init__(self, field: str = "don_gia"):
        self.field = field

    def prepare(self, value, context):
        if isinstance(context.dtype(self.field), T.StringType):
            return [{"number": text.parse_float(value)}]
        return []

    def findings(self, value, helper, context):
        shown = value.cast("string")
        dtype = context.dtype(self.field)
        if isinstance(dtype, T.StringType):
            number = helper["number"]
            missing = value.isNotNull() & number.isNull()
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            number = F.nanvl(value, F.lit(None).cast("double"))
            missing = F.isnan(value)
        else:
            number, missing = value, F.lit(False)
        outside = (number < C.MIN_PRICE) | (number > C.MAX_PRICE)
        return [
            Finding("price_number", C.INVALID_FORMAT, missing, shown),
            Finding("price_range", C.OUT_OF_RANGE, outside, shown),
        ]


def is_text_flag(field: str) -> str:
    """The column that tells whether a date held as text was text all along."""
    return f"_{field}_is_text"


class BirthDateRule(Rule):
    """A date column is always in the wrong format until its repair has turned it into text."""

    def __init__(self, field: str = "ngay_sinh"):
        self.field = field

    def _is_text(self, context: RuleContext) -> bool:
        return isinstance(context.dtype(self.field), T.StringType)

    def prepare(self, value, context):
        day = dates.parse_iso_date(value) if self._is_text(context) else value.cast("date")
        return [
            {"day": day},
            {
                "age": lambda h: dates.age_in_years(h["day"], context.as_of),
                "standard": lambda h: F.date_format(h["day"], "yyyy-MM-dd"),
            },
        ]

    def findings(self, value, helper, context):
        day, age, standard = helper["day"], helper["age"], helper["standard"]
        shown = value.cast("string")
        if self._is_text(context):
            missing = text.is_blank(value)
            nonstandard = value != standard
            flag = is_text_flag(self.field)
            if context.has(flag):
                nonstandard = nonstandard | ~F.col(flag)
        else:
            missing = value.isNull()
            nonstandard = value.isNotNull()
        return [
            Finding("dob_null", C.NULL_VALUE, missing, shown, True, _suggest("dob_null")),
            Finding("dob_parse", C.INVALID_DATE, ~missing & day.isNull(), shown, True, _suggest("dob_parse")),
            Finding("dob_future", C.INVALID_DATE, day > context.as_of, shown),
            Finding("dob_too_young", C.OUT_OF_RANGE, age < C.MIN_AGE, shown),
            Finding("dob_too_old", C.OUT_OF_RANGE, age > C.MAX_AGE, shown),
            Finding("dob_year", C.INVALID_DATE, F.year(day) < C.MIN_BIRTH_YEAR, shown),
            Finding(
                "dob_format",
                C.INVALID_FORMAT,
                day.isNotNull() & nonstandard,
                shown,
                True,
                _suggest("dob_format", standard),
                standard,
            ),
        ]


def closest_value(folded: Column, domain: Sequence[str], similarity: float = C.STATUS_SIMILARITY) -> Column:
    """The domain value with the smallest edit distance to an already folded text.

    Distances above ``similarity`` times the length of the value do not count; the first value of
    the domain wins a tie. Distance and position share one number, so one ``least`` decides both. A larger
    domain than fits into that number, 1,024 values, takes :class:`millrace.operators.domains.DomainIndex`.
    """
    step, mask = 1024, (1 << 30) - 1
    if len(domain) > step:
        raise ValueError(f"a domain of {len(domain)} values: an expression compares {step} at most, use DomainIndex")
    candidates = [v.lower().translate({ord(ch): None for ch in text.WHITESPACE}) for v in domain]
    ranked = [
        # A distance over its limit is -1, which the mask turns into a very large number.
        (F.levenshtein(folded, F.lit(candidate), int(len(candidate) * similarity)) * step + i).bitwiseAND(mask)
        for i, candidate in enumerate(candidates)
    ]
    best = F.least(*ranked) if len(ranked) > 1 else ranked[0]
    values = F.array(*[F.lit(v) for v in domain])
    return F.when(best < mask - step, F.get(values, best % step))


class StatusRule(Rule):
    """Status values are judged by a domain that the row itself or its table selects."""

    def __init__(self, field: str = "trang_thai", domains: Mapping[str, Sequence[str]] | None = None):
        self.field = field
        self.domains = dict(domains if domains is not None else C.STATUS_DOMAINS)

    def _choices(self, context: RuleContext) -> list[tuple[Column | None, Sequence[str]]]:
        """Conditions in order of preference, each with its domain; the last has no condition."""
        if context.status_context == "table" and context.table in self.domains:
            return [(None, self.domains[context.table])]
        choices: list[tuple[Column | None, Sequence[str]]] = []
        for column, name in C.STATUS_CONTEXT_COLUMNS.items():
            if context.has(column) and name in self.domains:
                choices.append((~text.is_blank(F.col(column).cast("string")), self.domains[name]))
        everything = [v for domain in self.domains.values() for v in domain]
        return [*choices, (None, everything)]

    @staticmethod
    def _by_choice(choice: Column | None, results: list[Column]) -> Column:
        if choice is None:
            return results[0]
        selected = F.when(choice == 0, results[0])
        for i, result in enumerate(results[1:], start=1):
            selected = selected.when(choice == i, result)
        return selected

    def prepare(self, value, context):
        choices = self._choices(context)
        domains = [domain for _, domain in choices]
        first = {"t": text.trim_to_null(value.cast("string"))}
        if len(choices) > 1:
            number = F.when(choices[0][0], F.lit(0))
            for i, (condition, _) in enumerate(choices[1:-1], start=1):
                number = number.when(condition, F.lit(i))
            first["choice"] = number.otherwise(F.lit(len(choices) - 1))

        def canonical(domain: Sequence[str], t: Column) -> Column:
            spelled: dict[str, str] = {}
            for v in domain:
                spelled.setdefault(v.lower(), v)
            pairs = F.create_map(*[F.lit(x) for pair in spelled.items() for x in pair])
            return F.try_element_at(pairs, F.lower(t))

        def known(h):
            return self._by_choice(h.get("choice"), [canonical(d, h["t"]) for d in domains])

        def guess(h):
            folded = h["folded"]
            return self._by_choice(h.get("choice"), [closest_value(folded, d) for d in domains])

        return [
            first,
            {"known": known},
            # Only texts outside the domain are compared letter by letter.
            {"folded": lambda h: F.when(h["known"].isNull(), text.remove_spaces(F.lower(h["t"])))},
            {"guess": lambda h: F.when(h["folded"].isNotNull(), guess(h))},
        ]

    def findings(self, value, helper, context):
        t, known, guess = helper["t"], helper["known"], helper["guess"]
        return [
            Finding("status_blank", C.NULL_VALUE, t.isNull(), value),
            Finding(
                "status_unknown",
                C.INVALID_STATUS,
                t.isNotNull() & known.isNull(),
                t,
                guess.isNotNull(),
                _suggest("status_unknown", guess),
                guess,
            ),
            Finding(
                "status_case",
                C.INVALID_FORMAT,
                known != t,
                t,
                True,
                _suggest("status_case", known),
                known,
            ),
        ]


def domain_rule(field: str, domain: Sequence[str], required: bool = False) -> Rule:
    """The value is one of a list; missing values pass unless required."""

    def check(value, context):
        t = text.trim_to_null(value.cast("string"))
        found = [Finding(f"{field}_domain", C.INVALID_FORMAT, ~t.isin(*domain), t, message="value outside domain")]
        return [*_required(field, t, value, required), *found]

    return ColumnRule(field, check)


def pattern_rule(field: str, pattern: str, required: bool = False) -> Rule:
    def check(value, context):
        t = text.trim_to_null(value.cast("string"))
        found = [Finding(f"{field}_pattern", C.INVALID_FORMAT, ~t.rlike(pattern), t, message="value not of pattern")]
        return [*_required(field, t, value, required), *found]

    return ColumnRule(field, check)


def range_rule(field: str, minimum: float, maximum: float, required: bool = False) -> Rule:
    def check(value, context):
        shown = value.cast("string")
        number = text.parse_float(shown) if isinstance(context.dtype(field), T.StringType) else value
        not_number = shown.isNotNull() & (shown != "") & number.isNull()
        return [
            *_required(field, F.nullif(shown, F.lit("")), shown, required),
            Finding(f"{field}_number", C.INVALID_FORMAT, not_number, shown, message="value is not a number"),
            Finding(f"{field}_range", C.OUT_OF_RANGE, ~number.between(minimum, maximum), shown, message="value out of range"),
        ]

    return ColumnRule(field, check)


def length_rule(field: str, maximum: int, required: bool = False) -> Rule:
    def check(value, context):
        shown = value.cast("string")
        found = [Finding(f"{field}_length", C.OUT_OF_RANGE, F.length(shown) > maximum, shown, message="value too long")]
        return [*_required(field, F.nullif(shown, F.lit("")), shown, required), *found]

    return ColumnRule(field, check)


def _required(field: str, present: Column, value: Column, required: bool) -> list[Finding]:
    if not required:
        return []
    return [Finding(f"{field}_required", C.NULL_VALUE, present.isNull(), value.cast("string"), message="value missing")]


class RuleRegistry:
    """One rule per column; a later rule replaces an earlier one."""

    def __init__(self, rules: Sequence[Rule] = ()):
        self._rules: dict[str, Rule] = {}
        for rule in rules:
            self.add(rule.field, rule)

    def add(self, field: str, rule: Rule | Callable) -> None:
        self._rules[field] = rule if isinstance(rule, Rule) else ColumnRule(field, rule)

    def remove(self, field: str) -> None:
        self._rules.pop(field, None)

    def get(self, field: str) -> Rule | None:
        return self._rules.get(field)

    def has(self, field: str) -> bool:
        return field in self._rules

    def fields(self) -> list[str]:
        return list(self._rules)


def default_rules() -> RuleRegistry:
    return RuleRegistry(
        [PriceRule(), EmailRule(), NameRule(), BirthDateRule(), PhoneRule(), StatusRule()]
    )


def declared_rules() -> RuleRegistry:
    """The default rules plus those for domains, patterns and limits nothing enforces by default."""
    registry = default_rules()
    for rule in (
        domain_rule("phuong_thuc", C.PAYMENT_METHODS),
        domain_rule("gioi_tinh", C.GENDERS),
        domain_rule("do_uu_tien", C.PRIORITIES),
        domain_rule("chuc_vu", C.POSITIONS),
        domain_rule("ket_qua", C.OUTCOMES),
        range_rule("so_luong", C.MIN_QUANTITY, C.MAX_QUANTITY),
        range_rule("diem_danh_gia", C.MIN_RATING, C.MAX_RATING),
        *[pattern_rule(field, pattern) for field, pattern in C.ID_PATTERNS.items()],
    ):
        registry.add(rule.field, rule)
    return registry
