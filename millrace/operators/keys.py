"""Source prefixes that keep the ids of different sources apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import catalog as C


def is_id_column(name: str) -> bool:
    return name in C.ID_COLUMNS


def prefix_of(source: Column, prefixes: Mapping[str, str] = C.ID_PREFIXES) -> Column:
    """The prefix of a source; empty for an unknown one."""
    return F.coalesce(_lookup(source, prefixes), F.lit(""))


def _lookup(source: Column, prefixes: Mapping[str, str]) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    return F.try_element_at(pairs, source)


def prefix_ids(
    df: DataFrame,
    id_columns: Sequence[str] = C.ID_COLUMNS,
    prefixes: Mapping[str, str] = C.ID_PREFIXES,
    source: str = C.SOURCE_COLUMN,
) -> DataFrame:
    """Put the prefix of the row's source before every id, references included.

    Missing ids, ids that carry any known prefix and rows of unknown sources stay as they are.
    """
    present = [c for c in id_columns if c in df.columns]
    if not present:
        return df
    prefix = _lookup(F.col(source), prefixes)
    replaced = {}
    for c in present:
        value = F.col(c)
        prefixed = F.lit(False)
        for p in prefixes.values():
            prefixed = prefixed | value.startswith(p)
        applies = prefix.isNotNull() & value.isNotNull() & (value != "") & ~prefixed
        replaced[c] = F.when(applies, F.concat(prefix, value)).otherwise(value)
    return df.withColumns(replaced)


def strip_prefix(value: Column, prefixes: Mapping[str, str] = C.ID_PREFIXES) -> Column:
    """Remove one prefix: the first in the list that the value starts with."""
    result = None
    for p in prefixes.values():
        rest = F.substr(value, F.lit(len(p) + 1))
        result = F.when(value.startswith(p), rest) if result is None else result.when(value.startswith(p), rest)
    return value if result is None else result.otherwise(value)
