"""Duplicate removal and entity merge.

Arrival order decides all ties, so every operator takes the column that holds it. Groups can be of
any size: rows meet in partial aggregates on the map side, never in one in-memory list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.functions import text
from millrace.functions.plans import zero_of

KEY = "_key"
SOURCES = "_sources"
GROUP_SIZE = "_group_size"


def composite_key(columns: Sequence[Column | str]) -> Column:
    """Lower-cased, trimmed parts joined by a bar; a missing part reads ``null``."""
    parts = []
    for c in columns:
        column = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(F.lower(text.trim(column.cast("string"))), F.lit("null")))
    return F.concat_ws("|", *parts)


def _group_key(df: DataFrame, keys: Sequence[str], order: str, null_keys: str) -> Column:
    key = composite_key(keys)
    if null_keys == "merge":
        return key
    if null_keys != "keep":
        raise ValueError("null_keys is 'merge' or 'keep'")
    # Rows with a missing key part stay single: their arrival position sets them apart.
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    alone = F.concat(key, F.lit("\u0000"), F.col(order).cast("string"))
    return F.when(missing, alone).otherwise(key)


def _rank(c: Column, dtype: T.DataType) -> Column:
    """How much a value is wanted in a merge: 0 for a present one, more for less."""
    present = text.is_truthy(c, dtype)
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        # Null and empty text are worth the same, so the first of them stays.
        return F.when(present, 0).otherwise(1)
    return F.when(present, 0).when(c.isNotNull(), 1).otherwise(2)


# Arrival positions stay below this, so that a multiple of it can rank values before positions do;
# a position beyond it fails the job.
_FAR = 1 << 61


def _merged(df: DataFrame, column: str, order: str) -> Column:
    """The value a sequential fold would leave: the first present one, else what the first row has."""
    c, position = F.col(column), F.col(order)
    if not isinstance(df.schema[order].dataType, (T.IntegerType, T.LongType)):
        return _best(df, column, position)["value"]
    # Rank and position as one number are much cheaper to compare than as a pair.
    near = F.when(position < _FAR, position).otherwise(F.raise_error(F.lit("an arrival position is too large")).cast("bigint"))
    return F.min_by(c, near + _rank(c, df.schema[column].dataType) * F.lit(_FAR))


def dedup_merge(
    df: DataFrame,
    keys: Sequence[str],
    order: str = C.ORDER_COLUMN,
    source: str | None = C.SOURCE_COLUMN,
    sources: Sequence[str] | None = None,
    null_keys: str = "merge",
) -> DataFrame:
    """One row per key: the first, its gaps filled from the later ones in arrival order.

    Adds ``_group_size`` and, where the frame has a source column, ``_sources``: the distinct
    sources of a merged row in arrival order, null for a row that was alone. ``sources`` lists the
    sources that can occur and keeps the merge to one shuffle; without it the lineage takes a second.
    """
    position = F.col(order)
    values = [c for c in df.columns if c != order]
    keyed = df.withColumn(KEY, _group_key(df, keys, order, null_keys))
    tracked = source is not None and source in df.columns

    if not tracked or sources is not None:
        firsts = {s: F.min(F.when(F.col(source) == s, position)) for s in (sources or [])} if tracked else {}
        out = keyed.groupBy(KEY).agg(
            *[_merged(df, c, order).alias(c) for c in values],
            F.min(position).alias(order),
            F.count(F.lit(1)).alias(GROUP_SIZE),
            *[first.alias(f"__first_{i}") for i, first in enumerate(firsts.values())],
            *([F.count_if(~F.col(source).isin(*sources)).alias("__unlisted")] if tracked else []),
        )
        if not tracked:
            return out.select(*df.columns, GROUP_SIZE)
        seen = F.array(
            *[
                F.when(F.col(f"__first_{i}").isNotNull(), F.struct(F.col(f"__first_{i}").alias("p"), F.lit(s).alias("s")))
                for i, s in enumerate(firsts)
            ]
        )
        names = F.transform(F.array_sort(F.filter(seen, lambda x: x.isNotNull())), lambda x: x["s"])
        unlisted = F.raise_error(F.lit("a source outside the list given to dedup_merge")).cast("string")
        lineage = F.when(F.col("__unlisted") > 0, unlisted).otherwise(F.array_join(names, ","))
        return out.select(*df.columns, GROUP_SIZE, _lineage(lineage, names).alias(SOURCES))

    # Merge per key and source first; the lists that remain hold one entry per source.
    per_source = keyed.groupBy(KEY, F.col(source).alias("__source")).agg(
        *[_best(df, c, position).alias(c) for c in values],
        F.min(position).alias(order),
        F.count(F.lit(1)).alias(GROUP_SIZE),
    )
    out = per_source.groupBy(KEY).agg(
        *[F.min(c)["value"].alias(c) for c in values],
        F.sum(GROUP_SIZE).alias(GROUP_SIZE),
        F.collect_list(
            F.when(F.col("__source").isNotNull(), F.struct(F.col(order).alias("p"), F.col("__source").alias("s")))
        ).alias("__seen"),
        F.min(order).alias(order),
    )
    names = F.transform(F.array_sort("__seen"), lambda x: x["s"])
    return out.select(*df.columns, GROUP_SIZE, _lineage(F.array_join(names, ","), names).alias(SOURCES))


def _best(df: DataFrame, column: str, order: Column) -> Column:
    """As :func:`_merged`, keeping the rank and position so that the results can be merged again."""
    c = F.col(column)
    return F.min(
        F.struct(
            _rank(c, df.schema[column].dataType).alias("rank"), order.alias("position"), c.alias("value")
        )
    )


def _lineage(joined: Column, names: Column) -> Column:
    return F.when((F.col(GROUP_SIZE) > 1) & (F.size(names) > 0), joined)


def dedup_counts(
    df: DataFrame, keys: Sequence[str], name: str, null_keys: str = "merge", order: str = C.ORDER_COLUMN
) -> DataFrame:
    """Rows before and after duplicate removal, and their difference; ``null_keys`` as in :func:`dedup_merge`."""
    groups = df.groupBy(_group_key(df, keys, order, null_keys).alias(KEY)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("original"),
        F.count(F.lit(1)).alias("after"),
    ).select(
        F.lit(name).alias("table_name"),
        "original",
        "after",
        (F.col("original") - F.col("after")).alias("removed"),
    )


def dedup_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    null_keys: str = "merge",
    order: str = C.ORDER_COLUMN,
) -> DataFrame:
    """Removal counts per table and, in the row named ``total``, over all of them."""
    parts = [dedup_counts(df, keys[name], name, null_keys, order) for name, df in tables.items() if name in keys]
    parts += [
        df.agg(F.count(F.lit(1)).alias("original")).select(
            F.lit(name).alias("table_name"), "original", F.col("original").alias("after"), F.lit(0).cast("bigint").alias("removed")
        )
        for name, df in tables.items()
        if name not in keys
    ]
    by_table = parts[0]
    for part in parts[1:]:
        by_table = by_table.unionByName(part)
    return by_table.rollup("table_name").agg(
        F.sum("original").alias("original"), F.sum("after").alias("after"), F.sum("removed").alias("removed")
    ).withColumn("table_name", F.coalesce("table_name", F.lit("total")))


def dedup_all(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    order: str = C.ORDER_COLUMN,
    sources: Sequence[str] | None = tuple(C.SOURCE_RANKS),
    null_keys: str = "merge",
) -> dict[str, DataFrame]:
    """Merge every table that has a key; the others pass through."""
    return {
        name: dedup_merge(df, keys[name], order, sources=sources, null_keys=null_keys) if name in keys else df
        for name, df in tables.items()
    }


def dedup_first(df: DataFrame, keys: Sequence[str], order: str = C.ORDER_COLUMN) -> DataFrame:
    """The first row of every key, as it is."""
    # The rank filter runs before the shuffle too, so a task sends one row per key at most.
    first = Window.partitionBy(KEY).orderBy(order)
    return (
        df.withColumn(KEY, composite_key(keys))
        .withColumn("__n", F.row_number().over(first))
        .where(F.col("__n") == 1)
        .select(*df.columns)
    )


def find_duplicates(df: DataFrame, keys: Sequence[str], order: str = C.ORDER_COLUMN) -> DataFrame:
    """Every row that is not the first of its key, as ``(_key, existing, duplicate)``.

    Rows of one position follow a hash of their content; only copies in all columns are one row.
    """
    place = F.struct(F.col(order).alias("position"), F.xxhash64(*df.columns).alias("content"))
    keyed = df.select("*", composite_key(keys).alias(KEY), place.alias("__place"))
    row = F.struct(*[F.col(c) for c in df.columns])
    firsts = (
        keyed.groupBy(KEY)
        .agg(F.min_by(row, "__place").alias("existing"), F.min("__place").alias("__first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
        .withColumn("__zero", zero_of(KEY))
    )
    rows = keyed.select(KEY, "__place", row.alias("duplicate"), zero_of(KEY).alias("__zero"))
    # A large group is one row on the side of the firsts, so the join can split its other side.
    return rows.join(firsts, [KEY, "__zero"]).where(F.col("__place") > F.col("__first")).select(
        KEY, "existing", "duplicate"
    )


def analyze_duplicates(df: DataFrame, keys: Sequence[str], name: str, order: str = C.ORDER_COLUMN) -> DataFrame:
    """One row on the duplicates of a table: counts, their share as text, the key, three samples."""
    sample = F.struct(
        F.col(f"duplicate.{order}").alias("position"),
        KEY,
        F.to_json("existing").alias("existing"),
        F.to_json("duplicate").alias("duplicate"),
    )
    # Three rows: a bounded top-n, whatever the number of duplicates.
    first_three = find_duplicates(df, keys, order).orderBy(f"duplicate.{order}").limit(3)
    samples = first_three.agg(F.array_sort(F.collect_list(sample)).alias("samples"))
    both = dedup_counts(df, keys, name).unionByName(
        samples.withColumn("table_name", F.lit(name)), allowMissingColumns=True
    )
    share = F.format_string("%.2f%%", F.col("removed") / F.col("original") * 100)
    return (
        both.groupBy("table_name")
        .agg(*[F.max(c).alias(c) for c in ("original", "removed", "samples")])
        .select(
            "table_name",
            F.col("original").alias("total_records"),
            F.col("removed").alias("duplicate_count"),
            F.when(F.col("original") > 0, share).alias("duplicate_percentage"),
            F.lit(",".join(keys)).alias("deduplication_key"),
            "samples",
        )
    )


def drop_exact(df: DataFrame) -> DataFrame:
    """Drop rows that equal another in all columns."""
    return df.dropDuplicates()


def merge_two_sources(
    first: DataFrame,
    second: DataFrame,
    key: str,
    order: str = C.ORDER_COLUMN,
    labels: tuple[str, str] = ("ds1", "ds2"),
    on_null: str = "fail",
) -> DataFrame:
    """Merge two frames on a text key, folded to lower case without outer spaces.

    The last row of the first frame is the base; rows of the second fill its gaps in order. Adds
    ``sources``, the labels a row comes from. A missing key fails the job, or, with
    ``on_null="reject"``, leaves the row out: :func:`null_key_rows` has those.
    """
    if on_null not in ("fail", "reject"):
        raise ValueError("on_null is 'fail' or 'reject'")
    both = first.withColumn("__second", F.lit(False)).unionByName(second.withColumn("__second", F.lit(True)))
    columns = [c for c in first.columns if c != order]
    folded = F.lower(text.trim(F.col(key)))
    if on_null == "fail":
        folded = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"missing key {key}"))).otherwise(folded)
    else:
        both = both.where(F.col(key).isNotNull())
    from_second = F.col("__second")
    position = F.col(order)

    aggregates = []
    for i, c in enumerate(columns):
        dtype = first.schema[c].dataType
        rank = _rank(F.col(c), dtype)
        aggregates += [
            F.max_by(F.struct(F.col(c).alias("v"), rank.alias("r")), F.when(~from_second, position)).alias(f"__a{i}"),
            F.min_by(
                F.struct(F.col(c).alias("v"), rank.alias("r")),
                F.when(from_second, F.struct(rank, position)),
            ).alias(f"__b{i}"),
        ]
    grouped = both.groupBy(folded.alias(KEY)).agg(
        *aggregates,
        F.coalesce(F.max(F.when(~from_second, position)), F.min(position)).alias(order),
        F.bool_or(~from_second).alias("__in_first"),
        F.bool_or(from_second).alias("__in_second"),
    )
    merged = []
    for i, c in enumerate(columns):
        base, filler = F.col(f"__a{i}"), F.col(f"__b{i}")
        # The filler has the least rank of its side; an equal rank leaves the base in place.
        takes_filler = base.isNull() | (filler["r"] < base["r"])
        merged.append(F.when(takes_filler & filler.isNotNull(), filler["v"]).otherwise(base["v"]).alias(c))
    sources = F.concat_ws(
        ",", F.when(F.col("__in_first"), F.lit(labels[0])), F.when(F.col("__in_second"), F.lit(labels[1]))
    )
    return grouped.select(*merged, F.col(order), sources.alias("sources"))


def null_key_rows(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    return first.unionByName(second).where(F.col(key).isNull())
