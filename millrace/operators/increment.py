"""A warehouse that grows by increments: an increment reads only what its keys can hit and rewrites nothing.

The rows of a table lie in folders by load and segment, a segment being a range of a hash of the key, and in files by
bucket of the key. Every segment of every load has a Bloom filter of its keys. The keys of an increment meet the
filters first; those that no filter knows are new, and only the segments of the others are read, in a join for which
the stored side is neither shuffled nor read beyond its key columns. A load with so many keys that its filters would
let most others through has none: increments are then joined with the stored keys at once. New rows become files of
their own load, and one pointer file lists the loads that count, for all tables at once: a failed load is not in it
and is never read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.operators.load import (
    UNCAST,
    _incomplete,
    _missing,
    _spread_join,
    check_constraints,
    insert_if_absent,
    load_levels,
    mark_references,
    primary_key_of,
    project_warehouse,
    read_pointer,
    swap_pointer,
)
from millrace.session import cut_lineage, for_each, hadoop_path, keep_columns

LOAD, SEGMENT = "_load", "_segment"
#: Bits that a key sets in the filter of its segment.
_PROBES = 4
#: With fewer bits a key than this, one strange key in six passes a filter, and any increment opens all segments.
_FEWEST_BITS = 4


@dataclass(frozen=True)
class Layout:
    """How a table is cut: fixed for its life. About 12 bits a key keep false alarms near one in a hundred.

    The number of buckets should not be below ``spark.sql.shuffle.partitions``; the planner would shuffle the
    stored side for the sake of more tasks otherwise.
    """

    segments: int = 32
    buckets: int = 64
    bits: int = 1 << 16


class KeyedStore:
    """The stored rows of one table, found by one unique key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], layout: Layout):
        self.spark, self.path, self.schema, self.key, self.layout = spark, path.rstrip("/"), schema, list(key), layout
        self.table = f"millrace_{hashlib.md5(self.path.encode()).hexdigest()}"

    @property
    def _filters(self) -> str:
        return f"{self.path}/filters"

    def _segment(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.layout.segments)).cast("int")

    def _open(self) -> str:
        """The stored files as a bucketed table of the session; folders written meanwhile are found again."""
        fs, folder = hadoop_path(self.spark, f"{self.path}/rows")
        fs.mkdirs(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        clustered = ", ".join(f"`{k}`" for k in self.key)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, {LOAD} STRING, {SEGMENT} INT) USING parquet "
            f"PARTITIONED BY ({LOAD}, {SEGMENT}) CLUSTERED BY ({clustered}) INTO {self.layout.buckets} BUCKETS "
            f"LOCATION '{self.path}/rows'"
        )
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return self.table

    def read(self, loads: Sequence[str], segments: Sequence[int] | None = None, label: str | None = None) -> DataFrame:
        """The rows of some loads, all or those of some segments; others are not opened. ``label`` names their load."""
        rows = self.spark.table(self._open()).where(F.col(LOAD).isin(list(loads)))
        if segments is not None:
            rows = rows.where(F.col(SEGMENT).isin(list(segments)))
        return rows.select(*self.schema.names, *([F.col(LOAD).alias(label)] if label else []))

    def append(self, df: DataFrame, load: str) -> int:
        """Add rows as one load, and the filters of their keys; returns how many."""
        rows = df.select(*self.schema.names, F.lit(load).alias(LOAD), self._segment().alias(SEGMENT))
        # One file for each bucket and segment, and as many tasks as there are such files or shuffle partitions.
        bucket = F.pmod(F.hash(*self.key), F.lit(self.layout.buckets))
        rows.repartition(bucket, SEGMENT).write.insertInto(self._open())
        written = self.read([load])
        count = written.count()
        if count * _FEWEST_BITS <= self.layout.segments * self.layout.bits:
            words = self._probes(written.select(*self.key)).groupBy(SEGMENT, "word").agg(F.bit_or("mask").alias("bits"))
            words.write.parquet(f"{self._filters}/{LOAD}={load}")
        return count

    def has_filters(self, loads: Sequence[str]) -> bool:
        """Whether filters can tell which keys these loads hold."""
        folders = [hadoop_path(self.spark, f"{self._filters}/{LOAD}={load}") for load in loads]
        return all(fs.exists(folder) for fs, folder in folders)

    def _probes(self, keys: DataFrame) -> DataFrame:
        """For each key the places of its bits in the filter of its segment."""
        first, second = F.xxhash64(F.lit(1), *self.key), F.xxhash64(F.lit(2), *self.key)
        # Two hashes make any number of independent enough places; the sum stays within 64 bits.
        places = [F.pmod(F.shiftright(first, 8) + i * F.shiftright(second, 8), F.lit(self.layout.bits)) for i in range(_PROBES)]
        placed = keys.select(*self.key, self._segment().alias(SEGMENT), F.explode(F.array_distinct(F.array(*places))).alias("place"))
        return placed.select(
            *self.key, SEGMENT, F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("mask")
        )

    def candidates(self, keys: DataFrame, loads: Sequence[str]) -> DataFrame:
        """The distinct keys that the filters do not rule out, with their segment."""
        filters = self.spark.read.schema(f"{SEGMENT} int, word bigint, bits bigint, {LOAD} string").parquet(self._filters)
        bits = filters.where(F.col(LOAD).isin(list(loads))).groupBy(SEGMENT, "word").agg(F.bit_or("bits").alias("bits"))
        probes = self._probes(keys.dropna(subset=self.key).select(*self.key).distinct())
        missing = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")), F.lit(0)) == 0
        asked = probes.join(bits, [SEGMENT, "word"], "left").groupBy(*self.key, SEGMENT).agg(F.max(missing).alias("missing"))
        return asked.where(~F.col("missing")).drop("missing")

    def present(self, keys: DataFrame, loads: Sequence[str]) -> DataFrame:
        """The distinct keys that are stored; keys with a null are not."""
        if not loads:
            return keys.dropna(subset=self.key).select(*self.key).limit(0)
        if not self.has_filters(loads):
            asked = keys.dropna(subset=self.key).select(*self.key).distinct()
            return asked.join(self.read(loads).select(*self.key), self.key, "left_semi")
        asked = cut_lineage(self.candidates(keys, loads))
        touched = [r[SEGMENT] for r in asked.select(SEGMENT).distinct().collect()]
        # At most as many numbers as there are segments.
        return asked.select(*self.key).join(self.read(loads, touched).select(*self.key), self.key, "left_semi")

    def known(self, keys: DataFrame, loads: Sequence[str]) -> DataFrame:
        """Stored keys, each once, among them all that are in ``keys``: what rows with these keys are to be joined with."""
        if loads and not self.has_filters(loads):
            return self.read(loads).select(*self.key)
        return cut_lineage(self.present(keys, loads))


@dataclass
class IncrementalTable:
    """One warehouse table: its rows by primary key, and the values of its other unique keys."""

    table: C.Table
    rows: KeyedStore
    others: list[KeyedStore] = field(default_factory=list)

    @property
    def stores(self) -> list[KeyedStore]:
        return [self.rows, *self.others]

    def add(self, df: DataFrame, loads: Sequence[str], load: str, order: str) -> int:
        """Insert the rows that conflict neither with stored ones nor with earlier ones, as one load."""
        offered = df
        for store in self.stores:
            df = without_present(df, store, loads, offered)
        keys = [s.key for s in self.stores]
        count = self.rows.append(insert_if_absent(df, keys, order).drop(order), load)
        for store in self.others:
            store.append(self.rows.read([load]).dropna(subset=store.key), load)
        return count


def without_present(df: DataFrame, store: KeyedStore, loads: Sequence[str], offered: DataFrame | None = None) -> DataFrame:
    """The rows whose key is not stored; a key with a null never is."""
    if not loads:
        return df
    renamed = {k: f"__t_{k}" for k in store.key}
    taken = store.known(offered if offered is not None else df, loads).withColumnsRenamed(renamed)
    return _spread_join(df, taken, renamed, _incomplete(store.key), "left_anti")


class IncrementalStar:
    """A star schema below ``root`` that takes one increment after another.

    The layouts of its tables are fixed by the first increment. :meth:`read` gives the tables as of any number of
    loads; :meth:`compact` makes one load of all of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        catalog: C.Catalog = C.DEFAULT_CATALOG,
        layouts: Mapping[str, Layout] | None = None,
        default: Layout = Layout(),
    ):
        self.spark, self.root, self.catalog = spark, root.rstrip("/"), catalog
        state = read_pointer(spark, self.root) or {"loads": [], "layouts": {}, "tables": {}}
        self.loads: list[str] = state["loads"]
        #: The tables that each load holds rows of.
        self.contents: dict[str, list[str]] = state["tables"]
        self.layouts = {n: Layout(**v) for n, v in state["layouts"].items()}
        for table in catalog:
            self.layouts.setdefault(table.name, (layouts or {}).get(table.name, default))

    def table(self, name: str) -> IncrementalTable:
        table, layout = self.catalog[name], self.layouts[name]
        schema = T.StructType([T.StructField(c.name, c.dtype) for c in table.columns])
        if table.has_created_at:
            schema = schema.add(C.CREATED_AT_COLUMN, T.TimestampType())
        path = f"{self.root}/{table.warehouse_name}"
        others = [
            KeyedStore(self.spark, f"{path}/unique_{i}", T.StructType([schema[k] for k in key]), key, layout)
            for i, key in enumerate(table.unique)
        ]
        return IncrementalTable(table, KeyedStore(self.spark, f"{path}/primary", schema, table.primary_key, layout), others)

    def _loads_of(self, name: str, loads: Sequence[str]) -> list[str]:
        return [load for load in loads if name in self.contents.get(load, ())]

    def read(self, n_loads: int | None = None, label: str | None = None) -> dict[str, DataFrame]:
        """The tables after the first ``n_loads`` loads, or after all; ``label`` names the load of each row."""
        loads = self.loads[:n_loads]
        held = {n for load in loads for n in self.contents[load]}
        return {t.name: self.table(t.name).rows.read(self._loads_of(t.name, loads), label=label) for t in self.catalog if t.name in held}

    def add(
        self,
        clean: Mapping[str, DataFrame],
        order: str = C.ORDER_COLUMN,
        on_violation: str = "fail",
        loaded_at: Column | None = None,
    ) -> dict[str, dict[str, int]]:
        """Load an increment, parents first; returns rows offered, skipped for a reference, and inserted, by table.

        References are held against stored parents and those of the increment. Rows already stored are left as they
        are. Nothing is visible before all tables are written.
        """
        load = f"l{len(self.loads):06d}-{uuid.uuid4().hex}"
        self.contents[load] = []
        metrics: dict[str, dict[str, int]] = {}

        def add_table(table: C.Table) -> None:
            # Written once, by column: counts, filters and the insert all read it, each what it needs.
            marked = self._marked(clean[table.name], table, load)
            typed = keep_columns(project_warehouse(marked, table, loaded_at, keep=[order, "_fk_ok"], uncast=UNCAST), "offered")
            counts = typed.agg(F.count(F.lit(1)).alias("offered"), F.count_if(~F.col("_fk_ok")).alias("skipped")).first()
            typed = check_constraints(typed.where("_fk_ok").drop("_fk_ok"), table, on_violation)
            inserted = self.table(table.name).add(typed, self._loads_of(table.name, self.loads), load, order)
            metrics[table.name] = {**counts.asDict(), "inserted": inserted}

        for level in load_levels(clean, self.catalog):
            for_each(add_table, level)
            self.contents[load] += [t.name for t in level]
        self._commit([*self.loads, load])
        return metrics

    def _marked(self, df: DataFrame, table: C.Table, load: str) -> DataFrame:
        """The rows with ``_fk_ok``; only the parents' segments that the references can hit are read."""
        known = {}
        for column, parent in table.foreign_keys.items():
            if column in df.columns:
                name = primary_key_of(parent, self.catalog)
                used = df.where(~_missing(df, column)).select(F.col(column).alias(name))
                loads = self._loads_of(parent, [*self.loads, load])
                known[column] = self.table(parent).rows.known(used, loads)
        return mark_references(df, known, unique=True) if known else df.withColumn("_fk_ok", F.lit(True))

    def compact(self) -> None:
        """Make one load of all; earlier numbers of loads can no longer be read."""
        load = f"l000000-{uuid.uuid4().hex}"
        names = [t.name for t in self.catalog if any(t.name in self.contents[x] for x in self.loads)]

        def rewrite(name: str) -> None:
            for store in self.table(name).stores:
                store.append(store.read(self._loads_of(name, self.loads)), load)

        for_each(rewrite, names)
        self.contents[load] = names
        self._commit([load])

    def _commit(self, loads: list[str]) -> None:
        self.contents = {x: self.contents[x] for x in loads}
        swap_pointer(
            self.spark,
            self.root,
            {"loads": loads, "tables": self.contents, "layouts": {n: asdict(v) for n, v in self.layouts.items()}},
        )
        self.loads = loads
