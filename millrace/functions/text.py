"""String expressions with the whitespace and truth rules of the record sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as whitespace in record text.
WHITESPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# The same set inside a regular expression.
WS = (
    r"\t\n\x0B\f\r \u00a0\u1680"
    r"\u2000-\u200a"
    r"\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def trim(c: Column) -> Column:
    """Remove whitespace, in the wide sense above, from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def trim_to_null(c: Column) -> Column:
    return F.nullif(trim(c), F.lit(""))


def collapse_spaces(c: Column) -> Column:
    return trim(F.regexp_replace(c, f"[{WS}]+", " "))


def remove_spaces(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}]+", "")


def is_blank(c: Column) -> Column:
    """Null or empty text; whitespace is not blank."""
    return c.isNull() | (c == "")


def is_truthy(c: Column, dtype: T.DataType) -> Column:
    """Whether a value counts as present: not null, not empty text, not zero, not false.

    A decimal counts as present even when it is zero: it reaches the merge as text.
    """
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return c.isNotNull() & (c != "")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.isNotNull() & (c != 0)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & (c != 0) & ~F.isnan(c)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def capitalize_word(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def capitalize_first(c: Column) -> Column:
    """Raise the first character and leave the rest alone."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def word_initials(c: Column) -> Column:
    """The first characters of all words, run together."""
    return F.regexp_replace(c, f"[{WS}]*([^{WS}])[^{WS}]*[{WS}]*", "$1")


def replace_first(c: Column, search: str, replacement: str) -> Column:
    """Replace only the first occurrence of a plain text."""
    escaped = "".join(ch if ch.isalnum() else "\\" + ch for ch in search)
    return F.regexp_replace(c, rf"(?s)\A(.*?){escaped}", "$1" + replacement)


def parse_float(c: Column) -> Column:
    """The number a text starts with, as a double; null where there is none."""
    number = F.regexp_extract(
        c, rf"^[{WS}]*([+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?))", 1
    )
    return number.try_cast("double")


def parse_int(c: Column) -> Column:
    """The whole number a text starts with; null where there is none or it exceeds a long."""
    return F.regexp_extract(c, rf"^[{WS}]*([+-]?[0-9]+)", 1).try_cast("bigint")
