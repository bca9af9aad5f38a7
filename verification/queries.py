"""The registered queries: every operator over whole tables, with flat, named columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.functions.plans import spread
from millrace.operators import dedup, domains, history, increment, keys, load, merge_state, opaque, quality, repair, repairs, rules, staging, validate
from millrace.operators.validate import CAN_FIX, ERRORS, IS_VALID
from millrace.plans.integration import Options, plan_quality, plan_star
from millrace.session import scratch_path
from millrace.sources import csv as csv_source
from millrace.sources import pages as page_source
from millrace.sources import splits as split_source
from millrace.sources import tables as table_source
from millrace.streaming import envelopes as envelope_stream
from millrace.streaming import ingest as ingest_stream
from millrace.streaming.progress import IngestProgress
from verification import inputs as I

AS_OF = I.AS_OF
OPTIONS = Options(as_of=AS_OF)
CAT = C.DEFAULT_CATALOG
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return I.for_spark(spark, sf_dir, I.STAR[name])


def verdict_columns() -> list[Column]:
    def joined(part: Callable[[Column], Column]) -> Column:
        return F.array_join(F.transform(ERRORS, part), ",")

    return [
        joined(lambda e: e["rule"]).alias("rules"),
        joined(lambda e: e["code"]).alias("codes"),
        joined(lambda e: F.when(e["can_fix"], "1").otherwise("0")).alias("fixes"),
        F.col(IS_VALID).alias("is_valid"),
        F.col(CAN_FIX).alias("can_fix"),
    ]


def judged(df: DataFrame, *columns: str, **kw) -> DataFrame:
    return validate.validate(df, as_of=AS_OF, **kw).select(*columns, *verdict_columns())


# ---- sources ---------------------------------------------------------------------------------


@query
def scan_table(spark, sf_dir):
    source = table_source.Relational("parquet", sf_dir)
    return table_source.read_table(spark, source, "nation")


@query
def extract_counts(spark, sf_dir):
    source = table_source.Relational("parquet", sf_dir)
    return table_source.extract_report(table_source.read_tables(spark, source, I.TABLES))


@query
def scan_splits(spark, sf_dir):
    """A table read part by part, with bounds of a key that a few values dominate."""
    source = table_source.Relational("parquet", sf_dir)
    df = table_source.read_table(spark, source, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    parts = split_source.split_predicates(df, "l_quantity", 12, spread="l_orderkey")
    read = [table_source.read_table(spark, source, "lineitem", part).select("l_orderkey", "l_partkey", "l_quantity") for part in parts]
    return quality.run_report(read)


@query
def scan_filter(spark, sf_dir):
    source = table_source.Relational("parquet", sf_dir)
    df = table_source.read_table(
        spark, source, "orders", "o_orderpriority = :priority AND o_totalprice > :least", {"priority": "1-URGENT", "least": 100000.0}
    )
    return df.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def scan_page(spark, sf_dir):
    df = I.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return table_source.read_page(df, ["o_orderkey"], limit=1000, offset=700)


@query
def scan_page_deep(spark, sf_dir):
    # The same page through row numbers, as pages far into a table are read.
    df = I.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    numbered = table_source.number_rows(df, order, "row_number")
    return numbered.select("l_orderkey", "l_linenumber", "l_extendedprice", "row_number")


@query
def scan_page_ties(spark, sf_dir):
    """Two pages of a tied order, one by a top-n and one by row numbers: together they are the whole table."""
    df = I.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    n = df.count()
    near = table_source.read_page(df, ["o_orderpriority"], limit=n // 3, offset=0, top_n=n)
    far = table_source.read_page(df, ["o_orderpriority"], limit=n, offset=n // 3, top_n=0)
    return near.unionByName(far)


@query
def scan_page_directory(spark, sf_dir):
    """Pages by place and pages behind a key, from one sorted copy."""
    df = I.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    pages = page_source.PageDirectory.build(df, ["o_orderpriority", "o_orderkey"], scratch_path(spark, "pages"), rows_per_range=1 << 10)
    wanted = {
        "first": pages.page(700, row="row_number"),
        "middle": pages.page(1500, pages.total // 2, row="row_number"),
        "last": pages.page(1000, pages.total - 300, row="row_number"),
        "behind": pages.page(500, pages.place_after(["2-HIGH", 700]), row="row_number"),
    }
    return quality.run_report([p.select(F.lit(name).alias("page"), "*") for name, p in wanted.items()])


@query
def scan_count(spark, sf_dir):
    return table_source.count_rows(I.read(spark, sf_dir, "lineitem"))


@query
def raw_sql(spark, sf_dir):
    frames = {t: I.read(spark, sf_dir, t) for t in ("customer", "orders", "nation")}
    return table_source.read_sql(
        spark,
        """SELECT n_name, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
           WHERE o_orderstatus <> :status GROUP BY n_name""",
        frames,
        {"status": "P"},
    )


def _as_csv(df: DataFrame, name: str) -> str:
    """Write a frame as CSV text, with padded cells, to read it back through the source."""
    root = scratch_path(df.sparkSession, "csv")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    padded = text.select(*[F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(f" {c} ") for c in text.columns])
    padded.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue=""
    ).csv(f"{root}/{name}.csv")
    return root


@query
def csv_scan(spark, sf_dir):
    tickets = table(spark, sf_dir, "phieu_ho_tro").select("ma_phieu_ho_tro", "ma_khach_hang", "loai_van_de", "mo_ta", "trang_thai")
    return csv_source.read_csv(spark, f"{_as_csv(tickets, 'phieu_ho_tro')}/phieu_ho_tro.csv")


@query
def csv_extract_counts(spark, sf_dir):
    roots = _as_csv(I.read(spark, sf_dir, "nation"), "nation")
    I.read(spark, sf_dir, "supplier").write.option("header", True).csv(f"{roots}/supplier.csv")
    I.read(spark, sf_dir, "customer").write.option("header", True).csv(f"{roots}/customer.csv")
    return table_source.extract_report(csv_source.read_csv_tables(spark, roots, ["nation", "supplier", "customer"]))


@query
def csv_filter(spark, sf_dir):
    customers = I.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = f"{_as_csv(customers, 'customer')}/customer.csv"
    return csv_source.read_csv_where(spark, path, F.col("c_mktsegment") == "BUILDING")


@query
def csv_filter_counts(spark, sf_dir):
    customers = I.read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = f"{_as_csv(customers, 'customer')}/customer.csv"
    return csv_source.read_csv(spark, path).agg(*csv_source.kept_counts(F.col("c_mktsegment") == "BUILDING"))


@query
def csv_typed(spark, sf_dir):
    raw = I.read(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.col("event_id").cast("string"), F.lit(".5abc")).alias("number"),
        F.concat(F.col("user_id").cast("string"), F.lit("px")).alias("whole"),
        F.when(F.col("event_type") == "click", "TRUE").when(F.col("event_type") == "error", "").otherwise("no").alias("flag"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    df = csv_source.read_csv(spark, f"{_as_csv(raw, 'events')}/events.csv")
    typed = csv_source.convert_types(df, {"number": "number", "whole": "integer", "flag": "boolean", "day": "date"})
    return typed.withColumn("day", F.to_date("day"))


@query
def source_presence(spark, sf_dir):
    paths = {t: f"{sf_dir}/{t}.parquet" for t in (*I.TABLES, "absent")}
    missing = set(csv_source.missing_sources(spark, list(paths.values())))
    present = [t for t, p in paths.items() if p not in missing]
    # The answer is the tables themselves: one row per table found, with its size.
    return table_source.extract_report({t: I.read(spark, sf_dir, t) for t in present})


# ---- streaming ingest -------------------------------------------------------------------------


def _event_records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "danh_gia").select(
        "ma_danh_gia", "ma_khach_hang", "diem_danh_gia", "nhan_xet", "ngay_danh_gia", F.col("_seq")
    )


@query
def envelope_chunks(spark, sf_dir):
    chunks = envelope_stream.chunk_records(_event_records(spark, sf_dir), ["_seq"], 1000)
    return chunks.select(
        "batch",
        F.col("totalBatches").alias("total_batches"),
        F.size("records").cast("bigint").alias("n_records"),
        F.element_at("records", 1)["ma_danh_gia"].alias("first_id"),
        F.element_at("records", -1)["ma_danh_gia"].alias("last_id"),
    )


@query
def envelope_publish(spark, sf_dir):
    lines = envelope_stream.envelopes(
        _event_records(spark, sf_dir), "danh_gia", C.CSV, ["_seq"], 500, drop=["_seq"]
    )
    parsed = ingest_stream.parse_envelopes(lines)
    return parsed.select(
        "source", F.col("table").alias("table_name"), "batch", F.col("recordCount").alias("record_count"),
        F.size("records").cast("bigint").alias("n_records"), F.col("reason").isNull().alias("sound"),
    )


def _ingested(spark, sf_dir, spoil: bool = False):
    root = scratch_path(spark, "ingest")
    landing, area = f"{root}/landing", ingest_stream.StagingArea(f"{root}/staging")
    ratings = _event_records(spark, sf_dir)
    orders = table(spark, sf_dir, "don_hang").drop("source")
    if spoil:
        ratings = ratings.withColumn("diem_danh_gia", F.when(F.col("diem_danh_gia") == 3, "three").otherwise(F.col("diem_danh_gia").cast("string")))
        # Pages of raw text are no envelopes; they land among them.
        I.read(spark, sf_dir, "pages").select("url").write.text(f"{landing}/csv/pages")
    envelope_stream.write_envelopes(ratings, "danh_gia", C.CSV, landing, ["_seq"], 1000, drop=["_seq"])
    envelope_stream.write_envelopes(orders, "don_hang", C.RELATIONAL, landing, ["_seq"], 1000, drop=["_seq"])
    for _ in range(2):  # the second drain finds nothing new
        ingest_stream.ingest(spark, landing, f"{root}/checkpoints", area)
    return landing, area, root


@query
def envelope_ingest(spark, sf_dir):
    _, area, _ = _ingested(spark, sf_dir)
    staged = ingest_stream.read_staged(spark, area)
    ratings = staged["danh_gia"].select(
        F.col("ma_danh_gia").alias("id"), "ma_khach_hang", F.col("ngay_danh_gia").alias("day"),
        F.col("diem_danh_gia").cast("string").alias("amount"), "source",
    )
    orders = staged["don_hang"].select(
        F.col("ma_don_hang").alias("id"), "ma_khach_hang", F.col("ngay_dat").alias("day"),
        F.col("tong_tien").cast("bigint").cast("string").alias("amount"), "source",
    )
    return ratings.unionByName(orders)


@query
def ingest_once(spark, sf_dir):
    """Ratings that land twice, the second time published anew and drained later: every one is staged once."""
    root = scratch_path(spark, "ingest")
    landing, area = f"{root}/landing", ingest_stream.StagingArea(f"{root}/staging")
    ratings = _event_records(spark, sf_dir)
    for part in ("first", "again"):
        envelope_stream.write_envelopes(ratings, "danh_gia", C.CSV, f"{landing}/{C.CSV}/{part}", ["_seq"], 1000, drop=["_seq"])
        ingest_stream.ingest(spark, landing, f"{root}/checkpoints", area, sources=[C.CSV], once="7 days")
    staged = ingest_stream.read_staged(spark, area)["danh_gia"]
    return staged.select("ma_danh_gia", "ma_khach_hang", "diem_danh_gia", "nhan_xet", "ngay_danh_gia")


@query
def ingest_progress(spark, sf_dir):
    """Messages and records as the running streams tell them, over several batches each."""
    root = scratch_path(spark, "ingest")
    landing, area = f"{root}/landing", ingest_stream.StagingArea(f"{root}/staging")
    ratings, orders = _event_records(spark, sf_dir), table(spark, sf_dir, "don_hang").drop("source")
    envelope_stream.publish({"danh_gia": ratings}, C.CSV, landing, {"danh_gia": ["_seq"]}, 200, drop=["_seq"])
    envelope_stream.publish({"don_hang": orders}, C.RELATIONAL, landing, {"don_hang": ["_seq"]}, 500, drop=["_seq"])
    with IngestProgress(spark) as progress:
        ingest_stream.ingest(spark, landing, f"{root}/checkpoints", area, max_files=2, progress=progress)
    return progress.counters()


@query
def ingest_positions(spark, sf_dir):
    """Positions stay unique over a table that is published twice, and messages that are no chunks."""
    root = scratch_path(spark, "ingest")
    landing, area = f"{root}/landing", ingest_stream.StagingArea(f"{root}/staging")
    ratings = _event_records(spark, sf_dir)
    for part in (0, 1):
        rows = ratings.where(F.pmod("_seq", F.lit(2)) == part)
        envelope_stream.write_envelopes(rows, "danh_gia", C.CSV, f"{landing}/{part}", ["_seq"], 1000, drop=["_seq"])
        single = envelope_stream.envelopes(rows, "danh_gia", C.CSV, ["_seq"], 500, drop=["_seq"])
        without = F.regexp_replace("value", ',"batch":[0-9]+,"totalBatches":[0-9]+', "").alias("value")
        single.select(without).write.text(f"{landing}/{part}/csv/unchunked")
        # The second publish lands when the first is staged.
        ingest_stream.ingest(spark, f"{landing}/{part}", f"{root}/checkpoints-{part}", area, stream=f"part{part}", first_batch=part)
    staged = ingest_stream.read_staged(spark, area)["danh_gia"]
    return staged.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(C.ORDER_COLUMN).alias("positions"))


@query
def envelope_order(spark, sf_dir):
    """Arrival positions follow the published order."""
    _, area, _ = _ingested(spark, sf_dir)
    rows = ingest_stream.read_staged(spark, area)["danh_gia"]
    place = F.col(C.ORDER_COLUMN).bitwiseAND((1 << staging.PLACE_BITS) - 1)
    batch = F.shiftright(C.ORDER_COLUMN, staging.PLACE_BITS).bitwiseAND((1 << staging.CHUNK_BITS) - 1)
    return rows.select("ma_danh_gia", (batch * 1000 + place).alias("row_number"))


@query
def ingest_counters(spark, sf_dir):
    _, area, _ = _ingested(spark, sf_dir, spoil=True)
    return ingest_stream.ingest_counters(spark, area)


@query
def ingest_dead_letters(spark, sf_dir):
    _, area, _ = _ingested(spark, sf_dir, spoil=True)
    return ingest_stream.read_dead_letters(spark, area).select("value", "reason")


@query
def ingest_rejects(spark, sf_dir):
    _, area, _ = _ingested(spark, sf_dir, spoil=True)
    rejects = ingest_stream.read_rejects(spark, area)
    return rejects.select(
        "table_name", "source", F.array_join(staging.UNCASTABLE, ",").alias("columns"),
        F.get_json_object("record", "$.ma_danh_gia").alias("ma_danh_gia"),
    )


@query
def ingest_callback(spark, sf_dir):
    root = scratch_path(spark, "callback")
    landing = f"{root}/landing"
    envelope_stream.write_envelopes(_event_records(spark, sf_dir), "danh_gia", C.CSV, landing, ["_seq"], 1000, drop=["_seq"])

    def count(envelopes: DataFrame, batch_id: int) -> None:
        envelopes.select("source", F.col("table").alias("table_name"), "batch", F.size("records").cast("bigint").alias("n")).write.mode(
            "overwrite"
        ).parquet(f"{root}/out/batch_id={batch_id}")

    ingest_stream.ingest_with(spark, landing, f"{root}/checkpoint", count)
    return spark.read.parquet(f"{root}/out").drop("batch_id")


# ---- staging ----------------------------------------------------------------------------------


def _text_products(spark, sf_dir) -> DataFrame:
    """Products as text, some with amounts that are none and ids that are too long."""
    k = F.col("p_partkey")
    return I.read(spark, sf_dir, "part").select(
        F.when(k % 50 == 0, F.concat(F.lit("SP-OVERLONG-"), k.cast("string"))).otherwise(F.concat(F.lit("SP"), k.cast("string"))).alias("ma_san_pham"),
        F.col("p_name").alias("ten_san_pham"),
        F.when(k % 10 == 0, F.lit("free")).otherwise((k % 1000).cast("string")).alias("don_gia"),
        F.col("p_size").cast("string").alias("ton_kho"),
        k.alias("_seq"),
    )


@query
def staging_append(spark, sf_dir):
    staged = staging.stage(_text_products(spark, sf_dir), CAT["san_pham"], C.RELATIONAL, 0)
    rows, _ = staging.split_castable(staged)
    return rows.select(
        "ma_san_pham", "ten_san_pham", "mo_ta", "ma_danh_muc", F.col("don_gia").cast("bigint").alias("don_gia"), "ton_kho", "source",
        "_seq", F.col("inserted_at").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("has_time"),
    )


@query
def staging_rejects(spark, sf_dir):
    staged = staging.stage(_text_products(spark, sf_dir), CAT["san_pham"], C.RELATIONAL, 0)
    _, rejected = staging.split_castable(staged)
    return rejected.select("ma_san_pham", F.array_join(staging.UNCASTABLE, ",").alias("columns"))


@query
def staging_union(spark, sf_dir):
    """Both sources of one table, from their staging folders."""
    root = scratch_path(spark, "staging")
    customers = CAT["khach_hang"]
    first = I.for_spark(spark, sf_dir, I.RELATIONAL_CUSTOMERS)
    second = I.for_spark(spark, sf_dir, I.CSV_CUSTOMERS).drop("ngay_sinh", "dia_chi")
    both = staging.union_sources(
        staging.split_castable(staging.stage(first.drop("source"), customers, C.RELATIONAL, 0))[0],
        staging.split_castable(staging.stage(second.drop("source").withColumn("_seq", F.col("_seq") - I.SECOND), customers, C.CSV, 1))[0],
    )
    staging.write_staging(both, customers, root)
    return staging.read_staging(spark, root)["khach_hang"].select("_seq", "source", "ma_khach_hang", "email", "dia_chi", "ngay_sinh")


@query
def staging_stats(spark, sf_dir):
    return staging.table_counts({name: table(spark, sf_dir, name) for name in I.STAR})


# ---- keys -------------------------------------------------------------------------------------


@query
def id_prefix(spark, sf_dir):
    return keys.prefix_ids(I.for_spark(spark, sf_dir, I.IDS))


@query
def id_unprefix(spark, sf_dir):
    df = I.for_spark(spark, sf_dir, I.IDS)
    return df.select("_seq", keys.strip_prefix(F.col("ma_don_hang")).alias("plain"), "source")


@query
def id_round_trip(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return keys.prefix_ids(df).select("_seq", keys.strip_prefix(F.col("ma_khach_hang")).alias("ma_khach_hang"))


@query
def source_prefix(spark, sf_dir):
    df = I.for_spark(spark, sf_dir, I.IDS)
    return df.groupBy(keys.prefix_of(F.col("source")).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


# ---- deduplication ----------------------------------------------------------------------------


def _merge_columns() -> list[str]:
    return [
        "_seq", "source", "ma_khach_hang", "ho_ten", "email", "so_dien_thoai", "dia_chi", "ngay_sinh", "ngay_dang_ky",
        "gioi_tinh", "loai_khach_hang",
    ]


@query
def composite_key(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return df.select("_seq", dedup.composite_key(["email", "ma_khach_hang"]).alias("key"))


@query
def dedup_merge(spark, sf_dir):
    df = dedup.dedup_merge(table(spark, sf_dir, "khach_hang"), ["email"], sources=[C.RELATIONAL, C.CSV])
    return df.select(*_merge_columns(), F.col("_group_size").alias("group_size"))


@query
def dedup_merge_numbers(spark, sf_dir):
    df = dedup.dedup_merge(table(spark, sf_dir, "chi_tiet_don_hang"), ["ma_don_hang", "ma_san_pham"], sources=[C.RELATIONAL])
    return df.select("_seq", "ma_don_hang", "ma_san_pham", "so_luong", F.col("don_gia").cast("bigint").alias("don_gia"), F.col("_group_size").alias("group_size"))


@query
def dedup_merge_keep_nulls(spark, sf_dir):
    df = dedup.dedup_merge(table(spark, sf_dir, "khach_hang"), ["email"], sources=[C.RELATIONAL, C.CSV], null_keys="keep")
    return df.select("_seq", "email", "ho_ten", F.col("_group_size").alias("group_size"))


@query
def dedup_sources(spark, sf_dir):
    df = dedup.dedup_merge(table(spark, sf_dir, "khach_hang"), ["email"], sources=[C.RELATIONAL, C.CSV])
    return df.select("_seq", F.col("_sources").alias("sources"))


@query
def dedup_sources_any(spark, sf_dir):
    """Lineage and merge where the possible sources are not known beforehand."""
    df = dedup.dedup_merge(table(spark, sf_dir, "khach_hang"), ["email"])
    return df.select(*_merge_columns(), F.col("_sources").alias("sources"), F.col("_group_size").alias("group_size"))


@query
def dedup_merge_batches(spark, sf_dir):
    """The merge of batches that arrive one after the other, kept in a state, with one batch that comes twice."""
    rows = table(spark, sf_dir, "khach_hang")
    state = merge_state.MergeState(spark, scratch_path(spark, "merge"), rows.schema, ["email"], buckets=16)
    for batch in (2, 0, 2, 1):
        state.add(rows.where(F.pmod(F.col("_seq") + F.when(F.col("source") == C.CSV, 1).otherwise(0), F.lit(3)) == batch), f"batch {batch}")
    return state.merged().select(*_merge_columns(), F.col("_sources").alias("sources"), F.col("_group_size").alias("group_size"))


@query
def dedup_report(spark, sf_dir):
    names = ["khach_hang", "san_pham", "don_hang", "chi_tiet_don_hang"]
    return dedup.dedup_report({n: table(spark, sf_dir, n) for n in names}, {n: CAT[n].dedup_key for n in names})


@query
def dedup_report_keep_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "khach_hang")
    return dedup.dedup_report({"khach_hang": rows}, {"khach_hang": ["email"]}, null_keys="keep")


@query
def dedup_first(spark, sf_dir):
    return dedup.dedup_first(table(spark, sf_dir, "khach_hang"), ["email"]).select(*_merge_columns())


@query
def find_duplicates(spark, sf_dir):
    found = dedup.find_duplicates(table(spark, sf_dir, "khach_hang"), ["email"])
    return found.select(
        F.col("_key").alias("key"),
        F.col("existing._seq").alias("existing_seq"),
        F.col("existing.ma_khach_hang").alias("existing_id"),
        F.col("duplicate._seq").alias("duplicate_seq"),
        F.col("duplicate.email").alias("duplicate_email"),
    )


@query
def duplicate_analysis(spark, sf_dir):
    names = ["khach_hang", "chi_tiet_don_hang", "danh_muc"]
    parts = [dedup.analyze_duplicates(table(spark, sf_dir, n), CAT[n].dedup_key, n) for n in names]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        "table_name", "total_records", "duplicate_count", "duplicate_percentage", "deduplication_key",
        F.array_join(F.transform("samples", lambda s: F.concat_ws("@", s["_key"], s["position"].cast("string"))), ",").alias("samples"),
    )


@query
def exact_dedup(spark, sf_dir):
    return dedup.drop_exact(I.for_spark(spark, sf_dir, I.REPEATED))


@query
def two_source_merge(spark, sf_dir):
    first = I.for_spark(spark, sf_dir, I.RELATIONAL_CUSTOMERS).drop("source")
    second = I.for_spark(spark, sf_dir, I.CSV_CUSTOMERS).drop("source")
    return dedup.merge_two_sources(first, second, "email", on_null="reject").select(
        "ma_khach_hang", "ho_ten", "email", "so_dien_thoai", "dia_chi", "ngay_sinh", "loai_khach_hang", "sources"
    )


# ---- validation -------------------------------------------------------------------------------


@query
def validate_name(spark, sf_dir):
    return judged(table(spark, sf_dir, "khach_hang"), "_seq", fields=["ho_ten"])


@query
def validate_email(spark, sf_dir):
    return judged(table(spark, sf_dir, "khach_hang"), "_seq", fields=["email"])


@query
def validate_phone(spark, sf_dir):
    return judged(table(spark, sf_dir, "khach_hang"), "_seq", fields=["so_dien_thoai"])


@query
def validate_birthdate(spark, sf_dir):
    return judged(table(spark, sf_dir, "khach_hang"), "_seq", fields=["ngay_sinh"])


@query
def validate_birthdate_text(spark, sf_dir):
    return judged(I.for_spark(spark, sf_dir, I.BIRTH_TEXTS), "_seq")


@query
def validate_price(spark, sf_dir):
    return judged(table(spark, sf_dir, "san_pham"), "_seq")


@query
def validate_price_text(spark, sf_dir):
    return judged(I.for_spark(spark, sf_dir, I.PRICE_TEXTS), "_seq")


def _statuses(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "don_hang").select("_seq", F.lit("don_hang").alias("kind"), "ma_don_hang", "trang_thai")
    payments = table(spark, sf_dir, "thanh_toan").select("_seq", F.lit("thanh_toan").alias("kind"), "ma_don_hang", "ma_thanh_toan", "trang_thai")
    tickets = table(spark, sf_dir, "phieu_ho_tro").select("_seq", F.lit("phieu_ho_tro").alias("kind"), "ma_phieu_ho_tro", "trang_thai")
    agents = table(spark, sf_dir, "nhanvien_cskh").select("_seq", F.lit("nhanvien_cskh").alias("kind"), "ma_nhan_vien", "trang_thai")
    plain = table(spark, sf_dir, "phieu_ho_tro").select("_seq", F.lit("none").alias("kind"), "trang_thai")
    return staging.union_sources(orders, payments, tickets, agents, plain)


@query
def validate_status(spark, sf_dir):
    checked = validate.validate(_statuses(spark, sf_dir), as_of=AS_OF)
    return checked.select(
        "_seq", "kind", *verdict_columns(), F.array_join(F.transform(ERRORS, lambda e: F.coalesce(e["suggested_value"], F.lit("-"))), ",").alias("suggested"),
    )


@query
def validate_status_by_table(spark, sf_dir):
    return judged(table(spark, sf_dir, "thanh_toan"), "_seq", status_context="table", table="thanh_toan")


@query
def validate_record(spark, sf_dir):
    return judged(table(spark, sf_dir, "khach_hang"), "_seq")


@query
def validate_split(spark, sf_dir):
    df = validate.validate(table(spark, sf_dir, "khach_hang"), as_of=AS_OF)
    return df.select(
        "_seq",
        F.size(ERRORS).cast("bigint").alias("n_errors"),
        F.size(validate.FIXABLE_ERRORS).cast("bigint").alias("n_fixable"),
        F.size(validate.UNFIXABLE_ERRORS).cast("bigint").alias("n_unfixable"),
        F.array_join(validate.FIELDS_VALIDATED, ",").alias("fields"),
    )


@query
def validate_summary(spark, sf_dir):
    parts = []
    for name in ("khach_hang", "san_pham", "don_hang", "thanh_toan", "danh_muc"):
        df = validate.validate(table(spark, sf_dir, name), as_of=AS_OF)
        parts.append(validate.validation_summary(df).withColumn("table_name", F.lit(name)))
    return quality.run_report(parts)


@query
def validate_chain(spark, sf_dir):
    df = validate.validate_chain(
        table(spark, sf_dir, "khach_hang"), ["so_dien_thoai", "no_such_field", "ho_ten", "email", "ngay_sinh"], as_of=AS_OF
    )
    return df.select(
        "_seq",
        F.col("_chain_valid").alias("is_valid"),
        F.col("_stopped_at").alias("stopped_at"),
        F.array_join(F.transform("_chain_errors", lambda e: e["rule"]), ",").alias("rules"),
    )


@query
def validate_declared(spark, sf_dir):
    """Domain, pattern, range and length rules that are off by default."""
    registry = rules.RuleRegistry(
        [
            rules.domain_rule("gioi_tinh", C.GENDERS),
            rules.pattern_rule("ma_khach_hang", C.ID_PATTERNS["ma_khach_hang"]),
            rules.length_rule("email", 16),
        ]
    )
    registry.add("dia_chi", rules.domain_rule("dia_chi", ["BUILDING", "MACHINERY"], required=True))
    return judged(table(spark, sf_dir, "khach_hang"), "_seq", registry=registry)


@query
def validate_range(spark, sf_dir):
    registry = rules.declared_rules()
    df = table(spark, sf_dir, "chi_tiet_don_hang")
    return judged(df, "_seq", registry=registry, fields=["so_luong"])


@query
def validate_custom_rule(spark, sf_dir):
    def even_stock(value: Column, context: rules.RuleContext) -> Sequence[rules.Finding]:
        return [rules.Finding("odd_stock", C.OUT_OF_RANGE, value % 2 == 1, value, True, message="odd")]

    registry = rules.default_rules()
    registry.remove("don_gia")
    registry.add("ton_kho", even_stock)
    return judged(table(spark, sf_dir, "san_pham"), "_seq", registry=registry)


@query
def validate_python_rule(spark, sf_dir):
    """The same rule as a plain Python function of the value."""
    registry = rules.default_rules()
    registry.remove("don_gia")
    registry.add("ton_kho", opaque.python_rule("ton_kho", lambda v: v is not None and v % 2 == 1, "odd_stock", C.OUT_OF_RANGE, "odd", True))
    return judged(table(spark, sf_dir, "san_pham"), "_seq", registry=registry)


@query
def domain_closest(spark, sf_dir):
    """Words of the benchmark, one letter changed, against all words that begin a line of the documents."""
    lines = I.read(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select(F.lower(F.element_at(F.split("line", " "), 1)).alias("word")).where(F.col("word").rlike("^[a-z]+$")).distinct()
    asked = I.read(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where("length(w) > 2").distinct()
    texts = asked.select(F.concat(F.substring("w", 1, 1), F.lit("q"), F.substring("w", 3, 100)).alias("text")).distinct()
    return domains.add_closest(texts, "text", domains.DomainIndex(words, "word", "word"), "closest")


# ---- repair -----------------------------------------------------------------------------------


@query
def repair_python(spark, sf_dir):
    """A repair that is a plain Python function."""
    tidy = opaque.python_repair(lambda v: None if v is None else v.strip(" ").lower()[::-1])
    return table(spark, sf_dir, "khach_hang").select("_seq", tidy(F.col("email")).alias("email"))


@query
def repair_name(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return df.select("_seq", repairs.repair_name(F.col("ho_ten")).alias("ho_ten"))


@query
def repair_email(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return df.select("_seq", repairs.repair_email(F.col("email")).alias("email"))


@query
def repair_dob(spark, sf_dir):
    df = I.for_spark(spark, sf_dir, I.BIRTH_TEXTS)
    return df.select("_seq", repairs.repair_birth_date(F.col("ngay_sinh")).alias("ngay_sinh"))


@query
def repair_dob_age_aware(spark, sf_dir):
    df = I.for_spark(spark, sf_dir, I.BIRTH_TEXTS)
    return repair.repair_column(df, "ngay_sinh", repairs.default_repairs(by_age=True), as_of=AS_OF)


@query
def repair_status(spark, sf_dir):
    checked = validate.validate(_statuses(spark, sf_dir), as_of=AS_OF)
    return repair.repair(checked).select("_seq", "kind", "trang_thai")


@query
def repair_type(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return repair.repair_column(df, "loai_khach_hang").select("_seq", "loai_khach_hang")


def _repaired(spark, sf_dir, name: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, name), C.ORDER_COLUMN)
    return repair.repair(validate.validate(rows, as_of=AS_OF), as_of=AS_OF)


@query
def repair_record(spark, sf_dir):
    df = _repaired(spark, sf_dir, "khach_hang")
    return df.select("_seq", "ho_ten", "email", "so_dien_thoai", "ngay_sinh", "loai_khach_hang", F.col("_changed").alias("changed"))


@query
def repair_summary(spark, sf_dir):
    parts = [
        repair.repair_summary(_repaired(spark, sf_dir, name)).withColumn("table_name", F.lit(name))
        for name in ("khach_hang", "don_hang", "san_pham")
    ]
    return quality.run_report(parts)


@query
def repair_strategy(spark, sf_dir):
    df = repair.apply_strategy(table(spark, sf_dir, "khach_hang"), "email", lambda c: F.lower(F.trim(c)))
    return df.select("_seq", "email", F.col("_changed").alias("changed"))


@query
def repair_sequence(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    return repair.apply_sequence(df, ["ho_ten", "unknown", "email", "loai_khach_hang"]).select("_seq", "ho_ten", "email", "loai_khach_hang")


@query
def repair_conditional(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang")
    conditions = {"email": F.col("loai_khach_hang") == "VIP", "ho_ten": F.col("email").isNull(), "other": F.lit(True)}
    return repair.apply_conditional(df, conditions).select("_seq", "ho_ten", "email")


@query
def repair_whole_column(spark, sf_dir):
    df = table(spark, sf_dir, "khach_hang").withColumn("ngay_sinh", F.col("ngay_sinh").cast("string"))
    for field in ("email", "ho_ten", "ngay_sinh", "loai_khach_hang"):
        df = repair.repair_column(df, field)
    return df.select("_seq", "ho_ten", "email", "ngay_sinh", "loai_khach_hang")


# ---- quality ----------------------------------------------------------------------------------


def _checked(spark, sf_dir, name: str) -> DataFrame:
    return validate.validate(_repaired(spark, sf_dir, name), as_of=AS_OF)


@query
def quality_split(spark, sf_dir):
    parts = []
    for name, key in (("khach_hang", "_seq"), ("don_hang", "_seq"), ("thanh_toan", "_seq")):
        clean, failing = quality.split_quality(_checked(spark, sf_dir, name))
        for df, side in ((clean, "clean"), (failing, "failing")):
            parts.append(df.select(F.lit(name).alias("table_name"), F.col(key).alias("_seq"), F.lit(side).alias("side")))
    return quality.run_report(parts)


@query
def quarantine(spark, sf_dir):
    rows = quality.quarantine_rows(_checked(spark, sf_dir, "khach_hang"), CAT["khach_hang"])
    return rows.select(
        "table_name",
        "record_key",
        F.get_json_object("record", "$._seq").cast("bigint").alias("_seq"),
        F.get_json_object("record", "$.ho_ten").alias("ho_ten"),
        F.array_join(F.transform("errors", lambda e: e["rule"]), ",").alias("rules"),
    )


@query
def transform_audit(spark, sf_dir):
    rows = quality.audit_rows(_checked(spark, sf_dir, "khach_hang"), CAT["khach_hang"])
    return rows.select(
        "record_key",
        F.get_json_object("original", "$._seq").cast("bigint").alias("_seq"),
        F.get_json_object("transformed", "$.ngay_sinh").alias("ngay_sinh"),
        F.inline("changes"),
    ).drop("note")


@query
def quality_drift(spark, sf_dir):
    """Failing customers of two runs: those of the first source as they came, and those of both after repair."""
    relational = table(spark, sf_dir, "khach_hang").where(F.col("source") == C.RELATIONAL)
    raw = validate.validate(spread(relational, C.ORDER_COLUMN), as_of=AS_OF)
    runs = history.RunHistory(spark, scratch_path(spark, "history"))
    runs.append("first", {"quarantine": quality.quarantine_rows(raw, CAT["khach_hang"])})
    runs.append("second", {"quarantine": quality.quarantine_rows(_checked(spark, sf_dir, "khach_hang"), CAT["khach_hang"])})
    return runs.drift("first", "second")


@query
def run_report(spark, sf_dir):
    parts = []
    for name in ("khach_hang", "don_hang"):
        df = table(spark, sf_dir, name)
        plan = plan_quality(df, CAT[name], OPTIONS)
        parts += [
            quality.long_counts(dedup.dedup_counts(df, CAT[name].dedup_key, name).drop("table_name"), "dedup", name),
            quality.long_counts(validate.validation_summary(plan.validated), "validate", name),
            quality.long_counts(repair.repair_summary(plan.repaired), "repair", name),
            quality.long_counts(validate.validation_summary(plan.checked).select("valid", "invalid"), "final", name),
        ]
    return quality.run_report(parts)


# ---- load -------------------------------------------------------------------------------------


def _keys(spark, sf_dir, name: str) -> DataFrame:
    return load.parent_keys(table(spark, sf_dir, name), load.primary_key_of(name))


@query
def parent_keys(spark, sf_dir):
    return _keys(spark, sf_dir, "san_pham")


@query
def fk_single(spark, sf_dir):
    rows = table(spark, sf_dir, "phieu_ho_tro")
    kept = load.fk_filter(rows, {"ma_khach_hang": _keys(spark, sf_dir, "khach_hang")})
    return kept.select("_seq", "ma_khach_hang")


@query
def fk_missing_passes(spark, sf_dir):
    """Missing and empty references pass; a fifth of the orders has none."""
    rows = table(spark, sf_dir, "don_hang")
    parents = I.read(spark, sf_dir, "supplier").select(F.concat(F.lit("KH"), F.col("s_suppkey").cast("string")).alias("key"))
    return load.fk_filter(rows, {"ma_khach_hang": parents}).select("_seq", "ma_khach_hang")


@query
def fk_multi(spark, sf_dir):
    parents = {
        "ma_san_pham": load.parent_keys(table(spark, sf_dir, "san_pham").where("don_gia > 0"), "ma_san_pham"),
        "ma_don_hang": load.parent_keys(table(spark, sf_dir, "don_hang").where("trang_thai LIKE '%giao'"), "ma_don_hang"),
    }
    return load.fk_filter(table(spark, sf_dir, "chi_tiet_don_hang"), parents).select("_seq", "ma_don_hang", "ma_san_pham")


@query
def fk_skipped(spark, sf_dir):
    parents = {
        "ma_san_pham": load.parent_keys(table(spark, sf_dir, "san_pham").where("don_gia > 0"), "ma_san_pham"),
        "ma_don_hang": load.parent_keys(table(spark, sf_dir, "don_hang").where("trang_thai LIKE '%giao'"), "ma_don_hang"),
    }
    skipped = load.fk_rejects(table(spark, sf_dir, "chi_tiet_don_hang"), parents)
    return skipped.groupBy("ma_san_pham").agg(F.count(F.lit(1)).alias("n"))


@query
def insert_if_absent(spark, sf_dir):
    rows = table(spark, sf_dir, "nhanvien_cskh").withColumn("email", F.nullif("email", F.lit("no mail")))
    return load.insert_if_absent(rows, [["email"]]).select("_seq", "ma_nhan_vien", "email")


@query
def insert_incremental(spark, sf_dir):
    """Rows against a target that already has some of the keys."""
    rows = table(spark, sf_dir, "chi_tiet_don_hang").select("_seq", "ma_don_hang", "ma_san_pham")
    target = table(spark, sf_dir, "chi_tiet_don_hang").where("so_luong IS NULL").select("ma_don_hang", "ma_san_pham")
    return load.insert_if_absent(rows, [["ma_don_hang", "ma_san_pham"]], target=target)


@query
def insert_two_unique_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "khach_hang").select("_seq", "ma_khach_hang", "email", "so_dien_thoai")
    return load.insert_if_absent(rows, [["ma_khach_hang"], ["email"]])


INCREMENT_TABLES = ("danh_muc", "san_pham", "khach_hang", "don_hang", "chi_tiet_don_hang")


@query
def star_increment(spark, sf_dir):
    """Two increments of the star, the second with all rows of the first: every value, and the load that brought it."""
    offered = {n: table(spark, sf_dir, n) for n in INCREMENT_TABLES}
    star = increment.IncrementalStar(spark, scratch_path(spark, "increments"), default=increment.Layout(segments=8, buckets=8, bits=1 << 17))
    star.add({n: df.where("_seq % 3 <> 0") for n, df in offered.items()}, on_violation="quarantine")
    star.add(offered, on_violation="quarantine")
    parts = []
    for name, df in star.read(label="load").items():
        values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in CAT[name].column_names]
        number = F.substring("load", 2, 6).cast("int") + 1
        parts.append(df.select(F.lit(CAT[name].warehouse_name).alias("table_name"), F.concat_ws("|", *values).alias("content"), number.alias("n_load")))
    return quality.run_report(parts)


@query
def warehouse_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "khach_hang").drop("loai_khach_hang", "gioi_tinh")
    out = load.project_warehouse(rows, CAT["khach_hang"], F.lit("2025-11-21").cast("date"))
    return out


@query
def constraint_check(spark, sf_dir):
    marked = load.check_constraints(table(spark, sf_dir, "khach_hang"), CAT["khach_hang"], "mark")
    return marked.select("_seq", F.array_join(load.VIOLATIONS, ",").alias("violations"))


@query
def constraint_quarantine(spark, sf_dir):
    ratings = table(spark, sf_dir, "danh_gia").withColumn("diem_danh_gia", (F.col("diem_danh_gia") + 1).cast("int"))
    return load.check_constraints(ratings, CAT["danh_gia"], "quarantine").select("_seq", "diem_danh_gia")


def _staged_star(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in I.STAR}


@query
def star_load(spark, sf_dir):
    """All loaded rows of the star by table and key, from flawed sources to the warehouse."""
    star = plan_star(_staged_star(spark, sf_dir), options=OPTIONS, loaded_at=F.lit(0).cast("timestamp"))
    parts = [
        df.select(F.lit(CAT[n].warehouse_name).alias("table_name"), F.concat_ws("|", *CAT[n].primary_key).alias("key"))
        for n, df in star.tables.items()
    ]
    return quality.run_report(parts)


@query
def star_load_stats(spark, sf_dir):
    return load.load_report(plan_star(_staged_star(spark, sf_dir), options=OPTIONS))


@query
def warehouse_stats(spark, sf_dir):
    """Counts of a warehouse version that was written, swapped in and read back."""
    root = scratch_path(spark, "warehouse")
    clean = {n: quality.split_quality(plan_quality(df, CAT[n], OPTIONS).checked)[0] for n, df in _staged_star(spark, sf_dir).items()}
    load.write_star(clean, root)
    return staging.table_counts(load.read_star(spark, root), total=False)


@query
def integrity_audit(spark, sf_dir):
    names = ["khach_hang", "san_pham", "don_hang", "chi_tiet_don_hang", "danh_muc"]
    return load.integrity_audit({n: table(spark, sf_dir, n) for n in names})


@query
def clean_orders(spark, sf_dir):
    """Clean orders whose customers are clean: the shortest way through all stages."""
    staged = {n: table(spark, sf_dir, n) for n in ("khach_hang", "don_hang")}
    clean = {n: quality.split_quality(plan_quality(df, CAT[n], OPTIONS).checked)[0] for n, df in staged.items()}
    customers = load.insert_if_absent(clean["khach_hang"], [["ma_khach_hang"]])
    orders = load.fk_filter(clean["don_hang"], {"ma_khach_hang": load.parent_keys(customers, "ma_khach_hang")}, unique=True)
    return load.insert_if_absent(orders, [["ma_don_hang"]]).select(
        "ma_don_hang", "ma_khach_hang", "ngay_dat", F.col("tong_tien").cast("bigint").alias("tong_tien"), "trang_thai"
    )
