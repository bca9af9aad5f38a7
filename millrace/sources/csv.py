"""CSV sources: all values are trimmed text unless converted."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.session import hadoop_path
from millrace.sources.tables import LINE

_SHORT = "__malformed"


def _options(multiline: bool) -> dict[str, str]:
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        # A row is only found to be too long if all of it is parsed.
        "columnPruning": "false",
    }


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = False,
    position: bool = False,
    on_long: str = "fail",
) -> DataFrame:
    """Rows of CSV files as trimmed text.

    Column names come from the header, trimmed; ``columns`` selects some and fails on missing ones.
    An empty cell is empty text, a cell a short row lacks is null, and blank lines are no rows.
    Without ``multiline`` a file can be read by many tasks. ``position`` adds ``_line``, which orders
    rows as they stand in their files.

    A row with more cells than the header fails the job or, with ``on_long="reject"``, is left out:
    :func:`long_rows` has those. Paths whose headers differ in order are matched by name; other names,
    also within the files of one path, are an error.
    """
    if on_long not in ("fail", "reject", "keep"):
        raise ValueError("on_long is 'fail' or 'reject'")
    paths = [path] if isinstance(path, str) else list(path)
    require_sources(spark, paths)
    options = _options(multiline)
    if len(paths) > 1:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for p in paths:
            by_header.setdefault(tuple(spark.read.options(**options).csv(p).columns), []).append(p)
        if len(by_header) > 1:
            parts = [read_csv(spark, p, columns, multiline, position, on_long) for group in by_header.values() for p in group]
            names_of = [sorted(part.columns) for part in parts]
            if any(n != names_of[0] for n in names_of):
                raise ValueError(f"different columns in {', '.join(paths)}")
            return reduce(DataFrame.unionByName, parts)
    header = spark.read.options(**options).csv(paths).columns
    names = [h.strip(text.WHITESPACE) for h in header]
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _SHORT]])
    reader = spark.read.options(**options).schema(schema).option("columnNameOfCorruptRecord", _SHORT)
    raw = reader.option("enforceSchema", "false").csv(paths)
    if on_long != "keep":
        fault = F.concat(F.lit(f"more than {len(header)} cells in a row of {paths[0]}: "), F.substring(_SHORT, 1, 200))
        failed = F.raise_error(fault).cast("boolean") if on_long == "fail" else F.lit(False)
        raw = raw.where(F.when(_is_long(header), failed).otherwise(True))
    place = []
    if position:
        # The counter rises within one piece of a file, whatever pieces share a task.
        place = [
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("row"),
            ).alias(LINE)
        ]
    cells = [
        F.coalesce(text.trim(F.col(f"`{h}`")), F.when(F.col(_SHORT).isNull(), F.lit(""))).alias(n)
        for h, n in zip(header, names)
    ]
    df = raw.select(*cells, *place)
    if columns is None:
        return df
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(paths)}")
    return df.select(*columns, *([LINE] if position else []))


def _cells(line: Column) -> Column:
    """How many cells a line has; null for rows that have as many as the header."""
    return F.regexp_count(F.regexp_replace(line, '"(?:[^"]|"")*"', ""), F.lit(",")) + 1


def _is_long(header: Sequence[str]) -> Column:
    # A reader that is asked for the malformed line alone refuses, so another column takes part.
    return (_cells(F.col(_SHORT)) > len(header)) & (F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0)


def long_rows(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The lines with more cells than the header, as they are."""
    options = _options(multiline)
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _SHORT]])
    raw = spark.read.options(**options).schema(schema).option("columnNameOfCorruptRecord", _SHORT).csv(path)
    return raw.where(_is_long(header)).select(F.col(_SHORT).alias("line"))


def read_csv_tables(
    spark: SparkSession, root: str, names: Sequence[str], multiline: bool = False
) -> dict[str, DataFrame]:
    """One frame per file ``root/<name>.csv``; a missing file fails before anything is read."""
    files = {name: f"{root.rstrip('/')}/{name}.csv" for name in names}
    require_sources(spark, list(files.values()))
    return {name: read_csv(spark, path, multiline=multiline) for name, path in files.items()}


def read_csv_where(
    spark: SparkSession, path: str, predicate: Callable[[DataFrame], Column] | Column, multiline: bool = False
) -> DataFrame:
    df = read_csv(spark, path, multiline=multiline)
    return df.where(predicate(df) if callable(predicate) else predicate)


def kept_counts(predicate: Column) -> list[Column]:
    """Kept and total rows of a filter, for ``observe`` or ``agg`` on the frame before it."""
    return [F.count_if(predicate).alias("kept"), F.count(F.lit(1)).alias("total")]


def convert_types(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Convert text columns: ``number``, ``integer``, ``boolean`` or ``date``; others stay text.

    A number is what the text starts with. Empty or unreadable text becomes null, since a typed column
    has no place for it.
    """
    replaced = {}
    for name, kind in kinds.items():
        if name not in df.columns:
            continue
        value = F.nullif(F.col(name), F.lit(""))
        if kind == "number":
            replaced[name] = text.parse_float(value)
        elif kind == "integer":
            replaced[name] = text.parse_int(value)
        elif kind == "boolean":
            replaced[name] = F.lower(value) == "true"
        elif kind == "date":
            replaced[name] = value.try_cast("timestamp")
    return df.withColumns(replaced) if replaced else df


def missing_sources(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths, or patterns, that match nothing."""
    missing = []
    for path in paths:
        fs, handle = hadoop_path(spark, path)
        found = fs.globStatus(handle)
        if found is None or len(found) == 0:
            missing.append(path)
    return missing


def require_sources(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail with one error that names every missing file."""
    missing = missing_sources(spark, paths)
    if missing:
        raise FileNotFoundError(f"Missing CSV files: {', '.join(missing)}")
