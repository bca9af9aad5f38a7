"""Quarantine, audit and report tables that grow by runs, and what changed from one run to another."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.load import read_pointer, swap_pointer

RUN = "run_id"
_ATTEMPT = "_attempt"
NEW, CURED, FAILING = "new", "cured", "still failing"


class RunHistory:
    """The tables of all committed runs below ``root``.

    A run is written to a folder of its own in every table and counts once the pointer file names it, for all tables
    at once. What an attempt left that failed is never read; a run that is in already is not written again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        state = read_pointer(spark, self.root) or {"runs": {}, "tables": {}}
        #: Run ids in the order of their commits, with the attempt that counts.
        self.runs: dict[str, str] = state["runs"]
        self.tables: dict[str, list[str]] = state["tables"]

    def append(self, run_id: str, tables: Mapping[str, DataFrame]) -> bool:
        """Add the tables of a run; false if the run is in the history."""
        if run_id in self.runs:
            return False
        attempt = f"a-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{name}/{_ATTEMPT}={attempt}")
        runs = self.runs | {run_id: attempt}
        held = {n: [*self.tables.get(n, []), *([run_id] if n in tables else [])] for n in {**self.tables, **dict.fromkeys(tables)}}
        swap_pointer(self.spark, self.root, {"runs": runs, "tables": held})
        self.runs, self.tables = runs, held
        return True

    def read(self, name: str, *run_ids: str) -> DataFrame:
        """The rows of a table with their ``run_id``, of the given runs or of all; the folders of others stay closed."""
        wanted = [r for r in (run_ids or self.runs) if r in self.tables.get(name, ())]
        if not wanted:
            raise KeyError(f"no such run of {name}")
        # One entry for each run asked for.
        attempts = {self.runs[r]: r for r in wanted}
        rows = self.spark.read.parquet(f"{self.root}/{name}").where(F.col(_ATTEMPT).isin(list(attempts)))
        names = F.create_map(*[F.lit(x) for pair in attempts.items() for x in pair])
        return rows.select(names[F.col(_ATTEMPT)].alias(RUN), *[c for c in rows.columns if c != _ATTEMPT])

    def drift(self, before: str, after: str, table: str = "quarantine") -> DataFrame:
        """What became of the failing records of two runs: :func:`failing_drift` of their quarantine tables."""
        return failing_drift(self.read(table, before), self.read(table, after))


def _failing(rows: DataFrame, side: str) -> DataFrame:
    """One row for each record that fails, with the rules it breaks; there are only so many rules."""
    # The first error of a row stands for the row, so that one aggregation counts rows and gathers rules.
    broken = rows.select("table_name", "record_key", F.posexplode_outer("errors").alias("place", "error"))
    return broken.groupBy("table_name", "record_key").agg(
        F.array_join(F.array_sort(F.collect_set(F.col("error")["rule"])), ",").alias(f"rules_{side}"),
        F.count_if(F.coalesce("place", F.lit(0)) == 0).alias(f"rows_{side}"),
    )


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """A join by table and key in which missing keys are equal."""
    other = right.withColumnsRenamed({"table_name": "_table", "record_key": "_key"})
    joined = left.join(other, left["table_name"].eqNullSafe(F.col("_table")) & left["record_key"].eqNullSafe(F.col("_key")), how)
    present = F.coalesce(*[F.col(c).isNotNull() for c in left.columns if c not in ("table_name", "record_key")])
    return joined.select(
        F.when(present, F.col("table_name")).otherwise(F.col("_table")).alias("table_name"),
        F.when(present, F.col("record_key")).otherwise(F.col("_key")).alias("record_key"),
        *[c for c in joined.columns if c not in ("table_name", "record_key", "_table", "_key")],
    )


def failing_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table_name, record_key, status, changed, rules_before, rules_after, rows_before, rows_after) of two quarantines.

    ``status`` is new, cured or still failing; ``changed`` says that a record still fails by other rules. Several
    failing rows of one key are one record, rows without a key are one record of their table.
    """
    both = _null_safe(_failing(before, "before"), _failing(after, "after"), "full_outer")
    was, now = F.col("rows_before").isNotNull(), F.col("rows_after").isNotNull()
    return both.select(
        "table_name",
        "record_key",
        F.when(was & now, FAILING).when(was, CURED).otherwise(NEW).alias("status"),
        (was & now & (F.col("rules_before") != F.col("rules_after"))).alias("changed"),
        "rules_before",
        "rules_after",
        "rows_before",
        "rows_after",
    )


def drift_counts(drift: DataFrame) -> DataFrame:
    """Records by table and status, with those whose rules changed."""
    return drift.groupBy("table_name", "status").agg(F.count(F.lit(1)).alias("records"), F.count_if("changed").alias("changed"))
