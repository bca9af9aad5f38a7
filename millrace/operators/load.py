"""Loading of a star schema: reference filters, insert-if-absent, constraints, versioned refresh."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.functions import text
from millrace.functions.plans import zero_of
from millrace.session import cut_lineage, for_each, hadoop_path, keep_columns

VIOLATIONS = "_violations"
UNCAST = "_uncast"
# Rows without a reference are spread over this many join keys, so that they do not meet in one task.
_SPREAD = 4096


def primary_key_of(table: str, catalog: C.Catalog = C.DEFAULT_CATALOG) -> str:
    """The single key column of a table, by its logical or warehouse name; ``id`` where there is none."""
    for t in catalog:
        if table in (t.name, t.warehouse_name) and len(t.primary_key) == 1:
            return t.primary_key[0]
    return "id"


def parent_keys(parent: DataFrame, column: str) -> DataFrame:
    """The keys children may refer to."""
    return parent.select(F.col(column).alias("key")).where(F.col("key").isNotNull())


def mark_references(df: DataFrame, parents: Mapping[str, DataFrame], unique: bool = False) -> DataFrame:
    """Add ``_fk_ok``: every given reference is missing or found among its parents' keys.

    ``parents`` maps a column to a one-column frame of keys. Each reference costs one equi-join whose
    key side has unique keys: it is broadcast while the planner measures it to be small, and joined by
    a shuffle beyond that, where a hot key can be split on the side of the children. ``unique`` says
    that the keys are known to be distinct.
    """
    ok = F.lit(True)
    for i, (column, keys) in enumerate(parents.items()):
        found = keys.select(F.col(keys.columns[0]).alias("__pk"))
        missing = _missing(df, column)
        matched = _spread_join(df, found, {column: "__pk"}, missing, "left_outer", distinct=not unique)
        df = matched.withColumn(f"__ok{i}", missing | F.col("__pk").isNotNull()).drop("__pk")
        ok = ok & F.col(f"__ok{i}")
    marks = [f"__ok{i}" for i in range(len(parents))]
    return df.withColumn("_fk_ok", ok).drop(*marks)


def _missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return text.is_blank(c) if isinstance(df.schema[column].dataType, T.StringType) else c.isNull()


def _spread_join(
    df: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    missing: Column,
    how: str,
    distinct: bool = False,
) -> DataFrame:
    """An equi-join in which rows that cannot match do not all hash to one task.

    A second join key is zero where a match is possible and a positive bucket of the row elsewhere;
    the right side only has zeros, computed so that the planner does not fold them away.
    """
    # The position of a row is the narrowest thing that tells rows apart.
    spread_by = [C.ORDER_COLUMN] if C.ORDER_COLUMN in df.columns else df.columns
    bucket = F.when(missing, F.pmod(F.xxhash64(*spread_by), F.lit(_SPREAD)).cast("int") + 1).otherwise(F.lit(0))
    left = df.withColumn("__lb", bucket)
    # Made distinct before the bucket comes in, so that the join has its own exchange on both sides.
    other = (right.distinct() if distinct else right).withColumn("__rb", zero_of(*on.values()))
    condition = F.col("__lb") == F.col("__rb")
    for l, r in on.items():
        condition = condition & (F.col(l) == F.col(r))
    return left.join(other, condition, how).drop("__lb", "__rb")


def fk_filter(df: DataFrame, parents: Mapping[str, DataFrame], unique: bool = False) -> DataFrame:
    """Rows whose references are all missing, empty or known."""
    return mark_references(df, parents, unique).where("_fk_ok").drop("_fk_ok")


def fk_rejects(df: DataFrame, parents: Mapping[str, DataFrame], unique: bool = False) -> DataFrame:
    """Rows with at least one unknown reference."""
    return mark_references(df, parents, unique).where(~F.col("_fk_ok")).drop("_fk_ok")


def insert_if_absent(
    df: DataFrame,
    unique_keys: Sequence[Sequence[str]],
    order: str = C.ORDER_COLUMN,
    target: DataFrame | None = None,
) -> DataFrame:
    """The rows a sequence of inserts that skips conflicts would add, in arrival order.

    A row conflicts with an earlier inserted one, or one of ``target``, that has the same values in
    any of the unique keys; a key with a null conflicts with nothing.
    """
    keys = [list(k) for k in unique_keys]
    if target is not None:
        for key in keys:
            df = _without_taken(df, target, key)
    if len(keys) == 1:
        return _first_per_key(df, keys[0], order)
    return _insert_by_rounds(df, keys, order)


def _incomplete(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


def _without_taken(df: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the target; a key with a null is never taken."""
    renamed = {k: f"__t_{k}" for k in key}
    taken = target.dropna(subset=list(key)).select(*[F.col(k).alias(t) for k, t in renamed.items()])
    return _spread_join(df, taken, renamed, _incomplete(key), "left_anti")


def _first_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    # The rank filter also runs before the shuffle, so repeated keys do not travel. Null keys are
    # set apart by their position, which makes each a group of its own.
    first = Window.partitionBy(*key, "__alone").orderBy(order)
    return (
        df.withColumn("__alone", F.when(_incomplete(key), F.col(order)))
        .withColumn("__n", F.row_number().over(first))
        .where(F.col("__n") == 1)
        .select(*df.columns)
    )


def _insert_by_rounds(df: DataFrame, keys: list[list[str]], order: str) -> DataFrame:
    """Several unique keys: a row dropped for one key must not block others by another.

    Only rows whose values occur again in some key take part, and of those only keys and position. Each
    round takes the rows that come first in all their keys and drops those in conflict with them; what
    is left goes into the next round, with one checkpoint. Rows in random arrival order need few rounds;
    a chain in which each row conflicts with the next by another key needs one for every two of its rows.
    """
    narrow = cut_lineage(df.select(*dict.fromkeys([*(c for key in keys for c in key), order])))
    contested = None
    for key in keys:
        repeated = narrow.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        mine = narrow.join(repeated.select(*key), key, "left_semi").select(order)
        contested = mine if contested is None else contested.unionByName(mine)
    contested = contested.distinct()
    state = cut_lineage(_with_leaders(narrow.join(contested, order, "left_semi"), keys, order))
    accepted = []
    while not state.isEmpty():
        leaders = state.where("__lead")
        accepted.append(leaders.select(order))
        rest = state.where("not __lead").drop("__lead")
        for key in keys:
            rest = _without_taken(rest, leaders, key)
        state = cut_lineage(_with_leaders(rest, keys, order))
    if not accepted:
        return df
    lost = contested.join(reduce(DataFrame.unionByName, accepted), order, "left_anti")
    return df.join(lost, order, "left_anti").select(*df.columns)


def _with_leaders(df: DataFrame, keys: list[list[str]], order: str) -> DataFrame:
    """Add ``__lead``: the row is the first in each of its keys; a key with a null has no other row."""
    lead = F.lit(True)
    columns = df.columns
    for i, key in enumerate(keys):
        # Minima are combined before the shuffle, so a value of very many rows is one row of the join.
        renamed = {k: f"__k{i}_{k}" for k in key}
        firsts = df.dropna(subset=key).groupBy(*key).agg(F.min(order).alias(f"__first_{i}")).withColumnsRenamed(renamed)
        df = _spread_join(df, firsts, renamed, _incomplete(key), "left")
        lead = lead & (F.col(f"__first_{i}").isNull() | (F.col(order) == F.col(f"__first_{i}")))
    return df.select(*columns, lead.alias("__lead"))


def project_warehouse(
    df: DataFrame,
    table: C.Table,
    loaded_at: Column | None = None,
    keep: Sequence[str] = (),
    uncast: str | None = None,
) -> DataFrame:
    """The columns of a warehouse table in its types, with defaults and the load time.

    A default applies where the frame lacks the column altogether, as an insert that does not name it.
    A value that does not fit its type becomes null; ``uncast`` names a list of the columns where that
    happened, which :func:`check_constraints` counts as violations.
    """
    columns, failed = [], []
    for c in table.columns:
        if c.name in df.columns:
            value = F.col(c.name)
            if df.schema[c.name].dataType != c.dtype:
                value = value.try_cast(c.dtype)
                failed.append(F.when(F.col(c.name).isNotNull() & value.isNull(), F.lit(c.name)))
        else:
            value = F.lit(c.default)
        columns.append(value.cast(c.dtype).alias(c.name))
    if table.has_created_at:
        columns.append((loaded_at if loaded_at is not None else F.current_timestamp()).alias(C.CREATED_AT_COLUMN))
    if uncast is not None:
        found = F.filter(F.array(*failed), lambda name: name.isNotNull()) if failed else F.array().cast("array<string>")
        columns.append(found.alias(uncast))
    return df.select(*columns, *[k for k in keep if k in df.columns])


def violation_column(df: DataFrame, table: C.Table) -> Column:
    """The names of the constraints a row breaks: types, missing values, lengths and ranges."""
    broken = []
    if UNCAST in df.columns:
        broken += [F.when(F.array_contains(UNCAST, c.name), F.lit(f"{c.name}:type")) for c in table.columns]
    for c in table.columns:
        if c.name not in df.columns:
            continue
        value = F.col(c.name)
        if c.not_null or c.name in table.primary_key:
            broken.append(F.when(value.isNull(), F.lit(f"{c.name}:not_null")))
        if c.max_length is not None:
            broken.append(F.when(F.length(value) > c.max_length, F.lit(f"{c.name}:length")))
        if c.minimum is not None:
            broken.append(F.when(~value.between(c.minimum, c.maximum), F.lit(f"{c.name}:range")))
    if not broken:
        return F.array().cast("array<string>")
    return F.filter(F.array(*broken), lambda v: v.isNotNull())


def check_constraints(df: DataFrame, table: C.Table, on_violation: str = "fail") -> DataFrame:
    """Hold rows against the constraints of a table.

    ``fail`` ends the job at the first row that breaks one; ``mark`` adds the list ``_violations``;
    ``quarantine`` keeps the rows that break none (``mark`` has the others).
    """
    marked = df.withColumn(VIOLATIONS, violation_column(df, table)).drop(UNCAST)
    if on_violation == "mark":
        return marked
    broken = F.size(VIOLATIONS) > 0
    if on_violation == "quarantine":
        return marked.where(~broken).drop(VIOLATIONS)
    if on_violation != "fail":
        raise ValueError("on_violation is 'fail', 'mark' or 'quarantine'")
    message = F.concat(F.lit(f"{table.warehouse_name} breaks "), F.array_join(VIOLATIONS, ", "))
    return marked.where(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(VIOLATIONS)


# --------------------------------------------------------------------------------------------
# Star load
# --------------------------------------------------------------------------------------------


@dataclass
class Star:
    """Warehouse frames by logical table, with the rows each load left out."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    skipped: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    path: str | None = None


def _settled_keys(table: C.Table) -> list[list[str]]:
    """The keys that still can collide once rows are distinct by the dedup key."""
    keys = [list(table.primary_key), *[list(u) for u in table.unique]]
    return [k for k in keys if tuple(k) != tuple(table.dedup_key)]


def plan_table(
    df: DataFrame,
    table: C.Table,
    parents: Mapping[str, DataFrame],
    order: str,
    on_violation: str,
    loaded_at: Column | None,
    deduplicated: bool,
    observation: Observation | None = None,
    catalog: C.Catalog = C.DEFAULT_CATALOG,
) -> tuple[DataFrame, DataFrame]:
    """The rows one table gains, in warehouse form, and those that fail its references."""
    references = {
        column: parent_keys(parents[parent], primary_key_of(parent, catalog))
        for column, parent in table.foreign_keys.items()
        if column in df.columns
    }
    marked = mark_references(df, references, unique=True) if references else df.withColumn("_fk_ok", F.lit(True))
    if observation is not None:
        marked = marked.observe(
            observation, F.count(F.lit(1)).alias("offered"), F.count_if(~F.col("_fk_ok")).alias("skipped")
        )
    passed = marked.where("_fk_ok").drop("_fk_ok")
    keys = _settled_keys(table) if deduplicated else [list(table.primary_key), *[list(u) for u in table.unique]]
    typed = check_constraints(project_warehouse(passed, table, loaded_at, keep=[order], uncast=UNCAST), table, on_violation)
    return (insert_if_absent(typed, keys, order) if keys else typed).drop(order), marked.where(~F.col("_fk_ok")).drop("_fk_ok")


def load_star(
    clean: Mapping[str, DataFrame],
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    order: str = C.ORDER_COLUMN,
    on_violation: str = "fail",
    loaded_at: Column | None = None,
    deduplicated: bool = True,
) -> Star:
    """Plan the load of all given tables, parents first, as lazy frames.

    Parents with children are materialised once, by column, since every child reads their keys and nothing else.
    ``deduplicated`` says that rows are already distinct by their dedup key.
    """
    star = Star()
    with_children = {p for t in catalog if t.name in clean for p in t.foreign_keys.values()}
    for table in catalog:
        if table.name not in clean:
            continue
        loaded, skipped = plan_table(
            clean[table.name], table, star.tables, order, on_violation, loaded_at, deduplicated, catalog=catalog
        )
        star.tables[table.name] = keep_columns(loaded, "loaded") if table.name in with_children else loaded
        star.skipped[table.name] = skipped
    return star


def load_levels(names: Iterable[str], catalog: C.Catalog = C.DEFAULT_CATALOG) -> list[list[C.Table]]:
    """Tables in groups that can load side by side: the parents of each stand in earlier groups."""
    given, depth = set(names), {}
    for table in catalog:
        if table.name in given:
            above = [depth[p] + 1 for p in table.foreign_keys.values() if p in depth]
            depth[table.name] = max(above, default=0)
    levels = sorted(set(depth.values()))
    return [[catalog[n] for n, d in depth.items() if d == level] for level in levels]


def write_star(
    clean: Mapping[str, DataFrame],
    root: str,
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    order: str = C.ORDER_COLUMN,
    on_violation: str = "fail",
    loaded_at: Column | None = None,
    deduplicated: bool = True,
) -> Star:
    """Write a whole new version of the warehouse and point readers to it once it is complete.

    Children are checked against the parents as written. Counts come from the writes themselves.
    """
    spark = next(iter(clean.values())).sparkSession
    version = f"v-{uuid.uuid4().hex}"
    star = Star(path=f"{root.rstrip('/')}/{version}")

    def load_table(table: C.Table) -> tuple[DataFrame, DataFrame, dict[str, int]]:
        seen, written = Observation(), Observation()
        loaded, skipped = plan_table(
            clean[table.name], table, star.tables, order, on_violation, loaded_at, deduplicated, seen, catalog
        )
        target = f"{star.path}/{table.warehouse_name}"
        loaded.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
        counts = {**seen.get, "loaded": written.get["rows"]}
        return spark.read.schema(loaded.schema).parquet(target), skipped, counts

    for level in load_levels(clean, catalog):
        for table, (frame, skipped, counts) in zip(level, for_each(load_table, level)):
            star.tables[table.name], star.skipped[table.name] = frame, skipped
            star.metrics[table.name] = counts
    _point_to(spark, root, version)
    return star


def _point_to(spark: SparkSession, root: str, version: str) -> None:
    swap_pointer(spark, root, {"version": version})


def swap_pointer(spark: SparkSession, root: str, content: Mapping[str, object]) -> None:
    """Replace the pointer file of a folder in one step: readers see the old content or the new one."""
    fs, current = hadoop_path(spark, f"{root.rstrip('/')}/CURRENT")
    _, staged = hadoop_path(spark, f"{root.rstrip('/')}/CURRENT.{uuid.uuid4().hex}")
    stream = fs.create(staged, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        staged.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(staged, current, options)


def read_pointer(spark: SparkSession, root: str) -> dict | None:
    """What the pointer file of a folder holds, if there is one."""
    fs, current = hadoop_path(spark, f"{root.rstrip('/')}/CURRENT")
    if not fs.exists(current):
        return None
    return json.loads(spark.read.text(current.toString(), wholetext=True).first()["value"])


def read_star(spark: SparkSession, root: str, catalog: C.Catalog = C.DEFAULT_CATALOG) -> dict[str, DataFrame]:
    """The tables of the current warehouse version."""
    pointer = read_pointer(spark, root)
    if pointer is None:
        raise FileNotFoundError(f"no warehouse version below {root}")
    version = pointer["version"]
    tables = {}
    for table in catalog:
        path = f"{root.rstrip('/')}/{version}/{table.warehouse_name}"
        fs, handle = hadoop_path(spark, path)
        if fs.exists(handle):
            tables[table.name] = spark.read.parquet(path)
    return tables


def load_report(star: Star, catalog: C.Catalog = C.DEFAULT_CATALOG) -> DataFrame:
    """Rows loaded and skipped for a reference, by table and kind, with a total."""
    parts = []
    for name, loaded in star.tables.items():
        kind = "dimension" if catalog[name].is_dimension else "fact"
        parts.append(loaded.agg(F.count(F.lit(1)).alias("loaded")).select(*_labels(kind, catalog[name]), "loaded", F.lit(0).cast("bigint").alias("skipped")))
        if catalog[name].foreign_keys:
            skipped = star.skipped[name].agg(F.count(F.lit(1)).alias("skipped"))
            parts.append(skipped.select(*_labels(kind, catalog[name]), F.lit(0).cast("bigint").alias("loaded"), "skipped"))
    rows = reduce(DataFrame.unionByName, parts)
    by_table = rows.groupBy("kind", "table_name").agg(F.sum("loaded").alias("loaded"), F.sum("skipped").alias("skipped"))
    total = rows.agg(F.sum("loaded").alias("loaded"), F.sum("skipped").alias("skipped")).select(
        F.lit("total").alias("kind"), F.lit("total").alias("table_name"), "loaded", "skipped"
    )
    return by_table.unionByName(total)


def _labels(kind: str, table: C.Table) -> list[Column]:
    return [F.lit(kind).alias("kind"), F.lit(table.warehouse_name).alias("table_name")]


def integrity_audit(
    tables: Mapping[str, DataFrame], catalog: C.Catalog = C.DEFAULT_CATALOG
) -> DataFrame:
    """Counts of what a sound star has none of: repeated keys, missing keys, orphans."""
    parts: list[DataFrame] = []
    for name, df in tables.items():
        table = catalog[name]
        for key in [table.primary_key, *table.unique]:
            repeated = df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(_finding(repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")), table, "repeated_key", key))
        empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in table.primary_key])
        parts.append(_finding(df.agg(F.count_if(empty).alias("n")), table, "missing_key", table.primary_key))
        for column, parent in table.foreign_keys.items():
            if parent in tables and column in df.columns:
                keys = parent_keys(tables[parent], primary_key_of(parent, catalog))
                # Only the distinct references travel to the join; their row counts come along.
                used = df.where(~_missing(df, column)).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
                orphans = used.join(keys.distinct(), "key", "left_anti")
                parts.append(_finding(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), table, "orphan", [column]))
    return reduce(DataFrame.unionByName, parts)


def _finding(counted: DataFrame, table: C.Table, check: str, columns: Iterable[str]) -> DataFrame:
    return counted.select(
        F.lit(table.warehouse_name).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit("+".join(columns)).alias("columns"),
        F.col("n").cast("bigint").alias("n"),
    )
