"""The whole integration: staged tables to a clean star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from time import monotonic

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators.dedup import GROUP_SIZE, SOURCES, dedup_merge
from millrace.operators.keys import prefix_ids
from millrace.operators.load import (
    VIOLATIONS,
    Star,
    check_constraints,
    load_star,
    write_star,
)
from millrace.operators.quality import audit_rows, metrics_frame, quarantine_rows, split_quality
from millrace.operators.repair import CHANGED, repair
from millrace.operators.repairs import RepairRegistry, default_repairs
from millrace.operators.rules import RuleRegistry, default_rules
from millrace.operators.validate import (
    FIELDS_VALIDATED,
    FIXABLE_ERRORS,
    IS_VALID,
    UNFIXABLE_ERRORS,
    summary_counts,
    validate,
)
from millrace.session import configure, for_each, keep_columns
from millrace.sources.csv import read_csv, require_sources
from millrace.sources.tables import LINE, Relational, arrival_order, read_tables
from millrace.streaming.envelopes import publish
from millrace.streaming.ingest import StagingArea, ingest, ingest_counters, read_staged


@dataclass(frozen=True)
class Options:
    """``as_of`` pins the day ages are counted to; the others choose among documented behaviours."""

    as_of: str | None = None
    status_context: str = "record"
    null_keys: str = "merge"
    on_violation: str = "fail"
    birth_date_by_age: bool = False
    rules: RuleRegistry | None = None
    repairs: RepairRegistry | None = None
    sources: tuple[str, ...] | None = tuple(C.SOURCE_RANKS)


@dataclass
class Quality:
    """The quality phases of one table, as lazy frames over one shuffle."""

    merged: DataFrame
    validated: DataFrame
    repaired: DataFrame
    checked: DataFrame


def plan_quality(
    staged: DataFrame,
    table: C.Table,
    options: Options = Options(),
    observed: Callable[[str, DataFrame], DataFrame] = lambda phase, df: df,
) -> Quality:
    """Prefix ids, merge duplicates, validate, repair, validate again.

    ``observed`` may attach counts to the frames of the phases staged, validated, repaired and checked.
    """
    merged = dedup_merge(
        prefix_ids(observed("staged", staged), table.id_columns),
        table.dedup_key,
        sources=options.sources,
        null_keys=options.null_keys,
    ).drop(SOURCES, GROUP_SIZE)
    rules = options.rules or default_rules()
    repairs = options.repairs or default_repairs(options.birth_date_by_age)

    def judge(df: DataFrame) -> DataFrame:
        return validate(df, rules, as_of=options.as_of, status_context=options.status_context, table=table.name)

    validated = observed("validated", judge(merged))
    repaired = observed("repaired", repair(validated, repairs, options.as_of))
    return Quality(merged, validated, repaired, observed("checked", judge(repaired)))


def plan_star(
    staged: Mapping[str, DataFrame],
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    options: Options = Options(),
    loaded_at: Column | None = None,
) -> Star:
    """Staged tables to warehouse frames; clean rows are materialised once, by column, in the checkpoint folder."""

    def clean_table(name: str) -> DataFrame:
        return keep_columns(split_quality(plan_quality(staged[name], catalog[name], options).checked)[0], "clean")

    clean = dict(zip(staged, for_each(clean_table, staged)))
    return load_star(clean, catalog, on_violation=options.on_violation, loaded_at=loaded_at)


@dataclass
class Run:
    """Where a run left its results."""

    root: str
    star: Star
    report: DataFrame
    metrics: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict)

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def audit(self) -> str:
        return f"{self.root}/transform_audit"


def run_quality(
    spark: SparkSession,
    staged: Mapping[str, DataFrame],
    root: str,
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    options: Options = Options(),
) -> tuple[dict[str, DataFrame], dict[tuple[str, str], dict[str, int]]]:
    """Write the checked rows of every table once, then route clean, failing and changed rows from there.

    The checked table is what survives a lost executor; everything after it is a narrow read of it.
    """
    metrics: dict[tuple[str, str], dict[str, int]] = {}

    def clean_table(name: str) -> DataFrame:
        df, table = staged[name], catalog[name]
        before, first, second, changed = (Observation() for _ in range(4))
        counts = {
            "staged": (before, [F.count(F.lit(1)).alias("original")]),
            "validated": (first, summary_counts()),
            "repaired": (changed, [F.count_if(F.col(CHANGED)).alias("transformed"), F.count_if(~F.col(CHANGED)).alias("skipped")]),
            "checked": (second, [F.count_if(F.col(IS_VALID)).alias("clean"), F.count_if(~F.col(IS_VALID)).alias("still_invalid")]),
        }

        def observed(phase: str, frame: DataFrame) -> DataFrame:
            observation, columns = counts[phase]
            return frame.observe(observation, *columns)

        checked = plan_quality(df, table, options, observed).checked
        # Both splits of the error list can be had from the list.
        checked = checked.drop(FIXABLE_ERRORS, UNFIXABLE_ERRORS, FIELDS_VALIDATED)
        path = f"{root}/checked/{name}"
        checked.write.mode("overwrite").parquet(path)
        written = spark.read.schema(checked.schema).parquet(path)

        original, after = before.get["original"], first.get["total"]
        metrics["dedup", name] = {"original": original, "after": after, "removed": original - after}
        metrics["validate", name] = dict(first.get)
        metrics["repair", name] = dict(changed.get)
        metrics["final", name] = dict(second.get)

        good, _ = split_quality(written)
        if metrics["final", name]["still_invalid"]:
            quarantine_rows(written, table).write.mode("overwrite").parquet(f"{root}/quarantine/phase=rules/t={name}")
        if metrics["repair", name]["transformed"]:
            audit_rows(written, table).write.mode("overwrite").parquet(f"{root}/transform_audit/t={name}")
        if options.on_violation == "quarantine":
            marked = check_constraints(good, table, "mark").where(F.size(VIOLATIONS) > 0)
            marked.select(
                F.lit(name).alias("table_name"),
                F.to_json(F.struct(*good.columns)).alias("record"),
                F.col(VIOLATIONS).alias("violations"),
            ).write.mode("overwrite").parquet(f"{root}/quarantine/phase=constraints/t={name}")
        return good

    names = list(staged)
    return dict(zip(names, for_each(clean_table, names))), metrics


def run(
    spark: SparkSession,
    root: str,
    relational: Relational | None = None,
    csv_root: str | None = None,
    catalog: C.Catalog = C.DEFAULT_CATALOG,
    options: Options = Options(),
    chunk: int = 1000,
) -> Run:
    """Extract both sources, pass them through the landing folder into staging, clean and load them.

    All folders are below ``root``, which must be shared storage on a cluster and new for every run.
    """
    started = monotonic()
    configure(spark)
    root = root.rstrip("/")
    landing, area = f"{root}/landing", StagingArea(f"{root}/staging")
    if relational is not None:
        names = catalog.by_source(C.RELATIONAL)
        tables = read_tables(spark, relational, names, position=True)
        order = {n: arrival_order(df, catalog[n].primary_key) for n, df in tables.items()}
        publish(tables, C.RELATIONAL, landing, order, chunk, drop=[LINE])
    if csv_root is not None:
        names = catalog.by_source(C.CSV)
        files = {n: f"{csv_root.rstrip('/')}/{n}.csv" for n in names}
        require_sources(spark, list(files.values()))
        frames = for_each(lambda n: read_csv(spark, files[n], position=True), names)
        tables = dict(zip(names, frames))
        order = {n: arrival_order(df, catalog[n].primary_key) for n, df in tables.items()}
        publish(tables, C.CSV, landing, order, chunk, drop=[LINE])
    ingest(spark, landing, f"{root}/checkpoints", area, catalog=catalog)

    clean, metrics = run_quality(spark, read_staged(spark, area, catalog), root, catalog, options)
    star = write_star(clean, f"{root}/warehouse", catalog, on_violation=options.on_violation)
    for name, counts in star.metrics.items():
        metrics["load", name] = counts
    metrics["run", "total"] = {
        "loaded": sum(m["loaded"] for m in star.metrics.values()),
        "duration_ms": int((monotonic() - started) * 1000),
    }
    staged_counts = ingest_counters(spark, area).select(
        F.lit("ingest").alias("phase"),
        F.concat_ws("/", "source", "table_name").alias("table_name"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
                    for c in ("processed_messages", "total_records", "rejected_messages")
                ]
            )
        ),
    )
    report = reduce(DataFrame.unionByName, [staged_counts, metrics_frame(spark, metrics)])
    report.coalesce(1).write.mode("overwrite").parquet(f"{root}/run_report")
    return Run(root, star, spark.read.schema(report.schema).parquet(f"{root}/run_report"), metrics)
