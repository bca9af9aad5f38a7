import json

import pytest
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators import staging
from millrace.session import discard_scratch, scratch_path
from millrace.sources import csv as S
from millrace.sources import tables as T
from millrace.streaming import envelopes as E
from millrace.streaming import ingest as N

CAT = C.DEFAULT_CATALOG


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(' id , name ,x\n1,"a ""q"", b",\n\n2,"  ",5\n3\n4, z , 6 \n', encoding="utf8")
    rows = S.read_csv(spark, str(path), position=True).orderBy("_line").collect()
    assert [(r.id, r.name, r.x) for r in rows] == [("1", 'a "q", b', ""), ("2", "", "5"), ("3", None, None), ("4", "z", "6")]
    assert S.read_csv(spark, str(path), columns=["x", "id"]).columns == ["x", "id"]
    with pytest.raises(ValueError, match="no column nope"):
        S.read_csv(spark, str(path), columns=["nope"])
    kept = S.read_csv_where(spark, str(path), lambda df: df.id > "2")
    assert kept.count() == 2
    with pytest.raises(FileNotFoundError, match="b.csv.*c.csv"):
        S.read_csv_tables(spark, str(tmp_path), ["a", "b", "c"])


def test_csv_multiline(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('id,note\n1,"two\nlines"\n2,one\n')
    assert [r.note for r in S.read_csv(spark, str(path), multiline=True).orderBy("id").collect()] == ["two\nlines", "one"]


def test_csv_order_over_splits(spark, tmp_path):
    """Positions follow the file even where many tasks read pieces of it."""
    path = tmp_path / "big.csv"
    path.write_text("id,pad\n" + "".join(f"{i},{'x' * 50}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = S.read_csv(spark, str(path), position=True)
        numbered = T.number_rows(df, ["_line"], "n", total="all")
        assert numbered.where(F.col("n") != F.col("id").cast("bigint")).count() == 0
        assert numbered.select("all").distinct().collect()[0][0] == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_conversion(spark):
    df = spark.createDataFrame([("12.5abc", "7px", "TRUE", "2025-01-02", "t"), ("x", "", "no", "bad", "t"), (None, "-3.9", None, None, None)],
                               "n string, i string, b string, d string, t string")
    out = S.convert_types(df, {"n": "number", "i": "integer", "b": "boolean", "d": "date", "t": "text", "gone": "number"}).collect()
    assert [(r.n, r.i, r.b) for r in out] == [(12.5, 7, True), (None, None, False), (None, -3, None)]
    assert str(out[0].d) == "2025-01-02 00:00:00" and out[1].d is None and out[0].t == "t"


def test_relational_reads(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t.parquet"))
    source = T.Relational("parquet", str(tmp_path))
    assert T.read_table(spark, source, "t", "id > :low", {"low": 6}).count() == 3
    assert T.read_table(spark, source, "t", F.col("id") < 2).count() == 2
    assert T.count_rows(T.read_table(spark, source, "t")).first().total == 10
    T.read_table(spark, source, "t").createOrReplaceTempView("some_view")
    assert T.read_table(spark, T.Relational("table"), "some_view").count() == 10
    with pytest.raises(ValueError):
        T.read_table(spark, T.Relational("carrier pigeon"), "t")


@pytest.mark.parametrize("limit_at", [100_000, 0])
def test_pages(spark, monkeypatch, limit_at):
    monkeypatch.setattr(T, "TOP_N_LIMIT", limit_at)
    df = spark.range(100).repartition(7).withColumn("v", -F.col("id"))
    assert [r.id for r in T.read_page(df, ["v"], limit=5, offset=10).orderBy("v").collect()] == [89, 88, 87, 86, 85]
    assert T.read_page(df, ["v"], limit=50, offset=80).count() == 20
    with pytest.raises(ValueError):
        T.read_page(df, [])


def test_numbers_over_many_equal_rows(spark):
    """Copies of one row, and rows the order does not tell apart, can fall into several ranges."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("b"))
    numbered = T.number_rows(df, ["a"], "n", total="all")
    found = numbered.agg(F.count_distinct("n"), F.min("n"), F.max("n"), F.max("all")).first()
    assert tuple(found) == (30000, 0, 29999, 30000)
    ends = numbered.groupBy("a").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("size")).orderBy("a").collect()
    assert ends[0].low == 0 and all(x.high + 1 == y.low for x, y in zip(ends, ends[1:]))
    assert all(r.high - r.low + 1 == r["size"] for r in ends)


def test_stage(spark):
    df = spark.createDataFrame([("SP1", "1.5", "x"), ("SP2", "2", "7"), ("SP-much-too-long", None, None)], "ma_san_pham string, don_gia string, ton_kho string")
    good, bad = staging.split_castable(staging.stage(df, CAT["san_pham"], C.CSV, 1, order=None))
    assert [(r.ma_san_pham, float(r.don_gia), r.ton_kho, r.source, r.mo_ta) for r in good.collect()] == [("SP2", 2.0, 7, "csv", None)]
    assert {(r.ma_san_pham, tuple(r._uncastable)) for r in bad.collect()} == {("SP1", ("ton_kho",)), ("SP-much-too-long", ("ma_san_pham",))}
    with pytest.raises(ValueError, match="no column surprise"):
        staging.stage(df.withColumn("surprise", F.lit(1)), CAT["san_pham"], C.CSV, 1, order=None)


def test_staging_tables_that_were_never_written(spark):
    tables = staging.read_staging(spark, scratch_path(spark, "none"))
    assert len(tables) == 10 and tables["don_hang"].count() == 0
    assert {r.table_name: r.n for r in staging.table_counts(tables).collect()}["total"] == 0


def ratings(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("DG"), F.col("id").cast("string")).alias("ma_danh_gia"), F.lit("KH1").alias("ma_khach_hang"),
        (F.col("id") % 5 + 1).cast("int").alias("diem_danh_gia"), F.lit("ok").alias("nhan_xet"),
        F.lit("2025-01-01").cast("date").alias("ngay_danh_gia"), F.col("id").alias("place"),
    )


def test_chunks(spark):
    chunks = E.chunk_records(ratings(spark, 25), ["place"], 10, drop=["place"]).orderBy("batch").collect()
    assert [(c.batch, c.totalBatches, len(c.records)) for c in chunks] == [(1, 3, 10), (2, 3, 10), (3, 3, 5)]
    assert [r.ma_danh_gia for r in chunks[1].records] == [f"DG{i}" for i in range(10, 20)]
    with pytest.raises(ValueError):
        E.chunk_records(ratings(spark, 5), ["place"], 0)


def test_ingest_with_bad_lines_and_replay(spark):
    root = scratch_path(spark, "t")
    landing, area = f"{root}/landing", N.StagingArea(f"{root}/staging")
    E.write_envelopes(ratings(spark, 25), "danh_gia", "csv", landing, ["place"], 10, drop=["place"])
    good = {"source": "csv", "table": "danh_muc", "records": [{"ma_danh_muc": "DM1", "ten_danh_muc": "x"}], "recordCount": 1}
    lines = [
        "no json", json.dumps({**good, "recordCount": 2}), json.dumps({**good, "table": "nope"}), json.dumps({**good, "source": None}),
        json.dumps(good), json.dumps({**good, "records": [{"ma_danh_muc": "DM2", "extra": "1"}]}),
        json.dumps({"source": "csv", "table": "danh_gia", "records": [{"ma_danh_gia": "DGx", "diem_danh_gia": "much"}], "recordCount": 1}),
    ]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(f"{landing}/csv/more")
    N.ingest(spark, landing, f"{root}/cp", area)
    staged = N.read_staged(spark, area)
    rows = staged["danh_gia"].orderBy("_seq").collect()
    assert [r.ma_danh_gia for r in rows] == [f"DG{i}" for i in range(25)]
    assert rows[0].source == "csv" and str(rows[0].ngay_danh_gia) == "2025-01-01" and rows[0].diem_danh_gia == 1
    assert [r.ma_danh_muc for r in staged["danh_muc"].collect()] == ["DM1"]
    assert {(r.value[:7], r.reason) for r in N.read_dead_letters(spark, area).collect()} == {
        ("no json", "not an envelope"), ('{"sourc', "wrong record count"), ('{"sourc', "unknown table"), ('{"sourc', "no source"),
    }
    assert {tuple(r._uncastable) for r in N.read_rejects(spark, area).collect()} == {("diem_danh_gia",), ("extra",)}
    counters = {r.table_name: r for r in N.ingest_counters(spark, area).collect()}
    assert (counters["danh_gia"].processed_messages, counters["danh_gia"].total_records) == (4, 26)

    # Draining again adds nothing; running the same batch again replaces what it wrote.
    N.ingest(spark, landing, f"{root}/cp", area)
    N.stage_batch(area, stream="csv")(spark.read.option("recursiveFileLookup", "true").text(f"{landing}/csv"), 0)
    assert N.read_staged(spark, area)["danh_gia"].count() == 25

    # New files are picked up by the next run.
    spark.createDataFrame([(json.dumps(good),)], "value string").write.text(f"{landing}/csv/later")
    N.ingest(spark, landing, f"{root}/cp", area)
    assert N.read_staged(spark, area)["danh_muc"].count() == 2


def test_callback(spark):
    root = scratch_path(spark, "cb")
    E.write_envelopes(ratings(spark, 5), "danh_gia", "csv", f"{root}/landing", ["place"], 10, drop=["place"])
    spark.createDataFrame([("junk",)], "value string").write.text(f"{root}/landing/csv/junk")
    seen = []
    N.ingest_with(spark, f"{root}/landing", f"{root}/cp", lambda df, i: seen.extend(df.select("table", "recordCount").collect()), dead_letters=f"{root}/dead")
    assert [tuple(r) for r in seen] == [("danh_gia", 5)]
    assert spark.read.parquet(f"{root}/dead").first().value == "junk"


def test_tied_pages_do_not_depend_on_the_plan(spark):
    df = spark.range(300).repartition(5).select((F.col("id") % 3).alias("v"), "id")
    for offset in (0, 10, 150):
        pages = [[tuple(r) for r in T.read_page(df, ["v"], 20, offset, top_n=n).collect()] for n in (1000, 0)]
        assert pages[0] == pages[1]


def test_jdbc_reads_are_parallel_or_asked_for(spark):
    parts = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    source = T.Relational("jdbc", options={"url": "jdbc:x"}, partitions={"a": parts, "b": {}, "c": {"numPartitions": 2}})
    assert T.jdbc_options(source, "a")["numPartitions"] == "3" and T.jdbc_options(source, "a")["fetchsize"] == str(T.FETCH_SIZE)
    assert "numPartitions" not in T.jdbc_options(source, "b")
    for name in ("c", "d"):
        with pytest.raises(ValueError):
            T.jdbc_options(source, name)


def test_csv_rows_that_are_too_long(spark, tmp_path):
    path = str(tmp_path / "long.csv")
    (tmp_path / "long.csv").write_text('id,name\n1,Ann\n2,Bob,EXTRA\n3,"a, ""b"", c"\n4\n5,\n')
    with pytest.raises(Exception, match="more than 2 cells"):
        S.read_csv(spark, path).collect()
    kept = S.read_csv(spark, path, on_long="reject")
    assert kept.count() == 4
    assert {(r.id, r.name) for r in kept.collect()} == {("1", "Ann"), ("3", 'a, "b", c'), ("4", None), ("5", "")}
    assert [r.line for r in S.long_rows(spark, path).collect()] == ["2,Bob,EXTRA"]


def test_csv_headers_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Ann\n")
    (tmp_path / "b.csv").write_text("name,id\nCid,3\n")
    (tmp_path / "c.csv").write_text("name,key\nDot,4\n")
    a, b, c = (str(tmp_path / f"{x}.csv") for x in "abc")
    assert {(r.id, r.name) for r in S.read_csv(spark, [a, b]).collect()} == {("1", "Ann"), ("3", "Cid")}
    with pytest.raises(ValueError):
        S.read_csv(spark, [a, c])


def test_positions_of_repeated_publishes(spark):
    root = scratch_path(spark, "p")
    area = N.StagingArea(f"{root}/staging")
    message = lambda k: json.dumps({"source": "csv", "table": "danh_muc", "records": [{"ma_danh_muc": f"DM{k}", "ten_danh_muc": "x"}], "recordCount": 1})
    for run in range(2):
        spark.createDataFrame([(message(10 * run + k),) for k in range(4)], "value string").write.text(f"{root}/landing/csv/{run}")
        N.ingest(spark, f"{root}/landing", f"{root}/cp", area)
    rows = N.read_staged(spark, area)["danh_muc"].collect()
    assert len({r._seq for r in rows}) == len(rows) == 8
    early = {r._seq for r in rows if len(r.ma_danh_muc) == 3}
    assert max(early) < min(r._seq for r in rows if r._seq not in early)


def test_limits_are_those_of_the_table(spark):
    root = scratch_path(spark, "l")
    area = N.StagingArea(f"{root}/staging")
    agent = {"source": "csv", "table": "nhanvien_cskh", "records": [{"ma_nhan_vien": "NV1", "trang_thai": "x" * 30}], "recordCount": 1}
    spark.createDataFrame([(json.dumps(agent),)], "value string").write.text(f"{root}/landing/csv/a")
    N.ingest(spark, f"{root}/landing", f"{root}/cp", area)
    assert [r._uncastable for r in N.read_rejects(spark, area).collect()] == [["trang_thai"]]


def test_scratch_can_be_discarded(spark, monkeypatch):
    import millrace.session as session

    monkeypatch.setattr(session, "_scratch", [])
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert discard_scratch(spark) == 1 and discard_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_long_first_page_is_not_cut_in_one_task(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 3).alias("v"), F.col("id").alias("id")).repartition(6)
    expected = [tuple(r) for r in T.read_page(df, ["v"], 300, 0).collect()]
    monkeypatch.setattr(T, "TOP_N_LIMIT", 100)
    page = T.read_page(df, ["v"], 300, 0, top_n=1000)
    assert "TakeOrdered" not in page._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in page.collect()] == expected


def test_batch_holds_text_but_no_parsed_records(spark, monkeypatch):
    root, held = scratch_path(spark, "held"), []
    E.write_envelopes(ratings(spark, 25), "danh_gia", "csv", f"{root}/landing", ["place"], 10, drop=["place"])
    kind = type(spark.range(1))
    keep = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *level: held.append(self.schema) or keep(self, *level))
    N.ingest(spark, f"{root}/landing", f"{root}/cp", N.StagingArea(f"{root}/staging"))
    assert held and not [f.name for schema in held for f in schema if "array" in f.dataType.simpleString()]
