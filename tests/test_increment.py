"""Increments of a star, a merge kept up to date, pages of a sorted copy, and the history of runs."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.operators import dedup, history, increment
from millrace.operators.increment import IncrementalStar, KeyedStore, Layout
from millrace.operators.load import insert_if_absent
from millrace.operators.merge_state import BUCKET, MergeState
from millrace.sources.pages import PageDirectory

SMALL = Layout(segments=4, buckets=4, bits=1 << 10)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(root):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{root}/**/*.parquet", recursive=True) if os.path.isfile(p)}


@pytest.fixture
def store(spark, tmp_path):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7).alias("value"))
    made = KeyedStore(spark, str(tmp_path / "store"), df.schema, ["key"], Layout(segments=16, buckets=4, bits=1 << 12))
    assert made.append(df, "l0") == 2000
    return made


def test_present(spark, store):
    asked = spark.createDataFrame([("k5",), ("k5",), ("k1999",), ("k2000",), (None,), ("",)], "key string")
    assert rows(store.present(asked, ["l0"])) == [("k1999",), ("k5",)]
    assert store.present(asked, []).count() == 0
    assert store.present(asked, ["other"]).count() == 0
    # A filter never misses a key and rules most of the others out.
    assert store.candidates(store.read(["l0"]), ["l0"]).count() == 2000
    others = spark.range(2000, 12000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert store.candidates(others, ["l0"]).count() < 1000


def test_only_hit_segments_are_read(spark, store):
    """The stored side is neither exchanged nor opened beyond the segments that a key can be in."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        one = store.present(spark.createDataFrame([("k7",)], "key string"), ["l0"])
        plan = one._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    left, right = plan.split("LeftSemi")[-1].rsplit("FileScan parquet", 1)
    assert left.count("Exchange") == 1 and "Exchange" not in right and "Bucketed: true" in right
    assert re.search(r"_segment#\d+ = \d+", right) and "InMemoryFileIndex(1 paths)" in right
    assert one.count() == 1


def test_filters_that_rule_nothing_out_are_not_kept(spark, tmp_path):
    """More keys than the filters tell apart: found by a join with the stored keys, with the same result."""
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    full = KeyedStore(spark, str(tmp_path / "full"), df.schema, ["key"], Layout(segments=4, buckets=4, bits=1 << 8))
    assert full.append(df, "l0") == 2000 and full.append(spark.createDataFrame([("few",)], "key string"), "l1") == 1
    assert not full.has_filters(["l0"]) and full.has_filters(["l1"]) and not full.has_filters(["l0", "l1"])
    assert not os.path.exists(f"{full.path}/filters/_load=l0")
    asked = spark.createDataFrame([("k5",), ("k5",), ("k2000",), ("few",), (None,)], "key string")
    assert rows(full.present(asked, ["l0", "l1"])) == [("few",), ("k5",)] and rows(full.present(asked, ["l1"])) == [("few",)]
    assert rows(increment.without_present(asked, full, ["l0", "l1"])) == [("k2000",), (None,)]
    assert full.known(asked, ["l0", "l1"]).count() == 2001


def test_append_leaves_files_alone(spark, store):
    before = files(store.path)
    more = spark.range(5000, 5010).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).cast("long").alias("value"))
    store.append(more, "l1")
    after = files(store.path)
    assert {p: t for p, t in after.items() if p in before} == before and len(after) > len(before)
    assert store.read(["l0"]).count() == 2000 and store.read(["l0", "l1"]).count() == 2010


def customers(spark, data):
    schema = "_seq long, ma_khach_hang string, ho_ten string, email string, so_dien_thoai string"
    return spark.createDataFrame(data, schema)


def test_star_in_increments(spark, tmp_path):
    """Versions of two tables: the same rows as an insert of everything in turn, old versions readable."""
    star = IncrementalStar(spark, str(tmp_path / "star"), default=SMALL)
    first = {
        "khach_hang": customers(spark, [(1, "K1", "A", "a@x", None), (2, "K2", "B", "b@x", None), (3, "K1", "C", "c@x", None)]),
        "don_hang": spark.createDataFrame([(1, "D1", "K1", "2024-01-01"), (2, "D2", "K9", "2024-01-01"), (3, "D3", None, "2024-01-01")], "_seq long, ma_don_hang string, ma_khach_hang string, ngay_dat string"),
    }
    counts = star.add(first)
    assert counts == {"khach_hang": {"offered": 3, "skipped": 0, "inserted": 2}, "don_hang": {"offered": 3, "skipped": 1, "inserted": 2}}
    second = {
        # K2 is stored, a@x belongs to K1, K5 comes twice, and b@x is free for nobody.
        "khach_hang": customers(spark, [(1, "K2", "X", "n@x", None), (2, "K4", "Y", "a@x", None), (3, "K5", "Z", "z@x", None), (4, "K5", "Q", "q@x", None), (5, "K9", "W", "w@x", None)]),
        "don_hang": first["don_hang"],
    }
    counts = star.add(second)
    assert counts == {"khach_hang": {"offered": 5, "skipped": 0, "inserted": 2}, "don_hang": {"offered": 3, "skipped": 0, "inserted": 1}}
    # A new reader finds the same; the first version is still there.
    again = IncrementalStar(spark, str(tmp_path / "star"))
    assert again.layouts["khach_hang"] == SMALL
    assert rows(again.read()["khach_hang"].select("ma_khach_hang", "ho_ten")) == [("K1", "A"), ("K2", "B"), ("K5", "Z"), ("K9", "W")]
    assert rows(again.read()["don_hang"].select("ma_don_hang")) == [("D1",), ("D2",), ("D3",)]
    assert rows(again.read(1)["don_hang"].select("ma_don_hang")) == [("D1",), ("D3",)]
    again.compact()
    assert len(again.loads) == 1 and rows(again.read()["don_hang"].select("ma_don_hang")) == [("D1",), ("D2",), ("D3",)]
    assert again.add(second)["khach_hang"]["inserted"] == 0


def test_failed_increment_is_not_seen(spark, tmp_path):
    star = IncrementalStar(spark, str(tmp_path / "star"), default=SMALL)
    star.add({"khach_hang": customers(spark, [(1, "K1", "A", "a@x", None)])})
    bad = {"khach_hang": customers(spark, [(1, "K2", "B", "b@x", None)]), "don_hang": spark.createDataFrame([(1, "D1", "K1", None)], "_seq long, ma_don_hang string, ma_khach_hang string, ngay_dat string")}
    with pytest.raises(Exception, match="ngay_dat:not_null"):
        star.add(bad)
    again = IncrementalStar(spark, str(tmp_path / "star"))
    assert list(again.read()) == ["khach_hang"] and again.read()["khach_hang"].count() == 1
    assert again.add({"khach_hang": bad["khach_hang"]})["khach_hang"]["inserted"] == 1


def test_increment_equals_whole_insert(spark, tmp_path):
    """Three increments with hot and null mail addresses against one sequence of inserts."""
    data = [(k, f"K{k % 400}", "N", None if k % 5 == 0 else f"m{k % 3 if k % 2 else k}@x", None) for k in range(1, 1200)]
    table = C.DEFAULT_CATALOG["nhanvien_cskh"]
    agents = customers(spark, data).withColumnRenamed("ma_khach_hang", "ma_nhan_vien")
    star = IncrementalStar(spark, str(tmp_path / "star"), default=SMALL)
    for part in range(3):
        star.add({"nhanvien_cskh": agents.where((F.col("_seq") > part * 400) & (F.col("_seq") <= (part + 1) * 400))})
    expected = insert_if_absent(agents, [list(table.primary_key), ["email"]])
    assert rows(star.read()["nhanvien_cskh"].select("ma_nhan_vien", "email")) == rows(expected.select("ma_nhan_vien", "email"))


def test_merge_state(spark, tmp_path):
    schema = "_seq long, k string, a string, n int, source string"
    data = [(s, f"k{s % 50}" if s % 7 else None, None if s % 3 else f"a{s}", None if s % 4 == 0 else s % 5, ["postgresql", "csv", None][s % 3]) for s in range(600)]
    data += [(s, "hot", None, 0, "csv") for s in range(600, 900)]
    df = spark.createDataFrame(data, schema)
    for null_keys in ("merge", "keep"):
        state = MergeState(spark, str(tmp_path / null_keys), df.schema, ["k"], null_keys=null_keys, buckets=8)
        assert state.merged().count() == 0
        # The later rows arrive first.
        state.add(df.where("_seq >= 500"), "two")
        state.add(df.where("_seq < 500"), "one")
        assert state.add(df.where("_seq < 500"), "one") == []
        expected = dedup.dedup_merge(df, ["k"], null_keys=null_keys)
        got = MergeState(spark, str(tmp_path / null_keys), df.schema, ["k"], null_keys=null_keys).merged()
        assert rows(got.select(*expected.columns)) == rows(expected)


def test_merge_state_rewrites_touched_buckets(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("_seq"), F.concat(F.lit("k"), F.col("id") % 300).alias("k"))
    state = MergeState(spark, str(tmp_path), df.schema, ["k"], buckets=16)
    assert state.add(df, "a") == list(range(16))
    before, folders = files(tmp_path), dict(state.folders)
    touched = state.add(spark.createDataFrame([(5000, "k3")], "_seq long, k string"), "b")
    assert len(touched) == 1
    after = files(tmp_path)
    assert {p: t for p, t in after.items() if p in before} == before
    assert all(f"{BUCKET}={touched[0]}/" in p or "/batch-" in p for p in after if p not in before)
    assert {b: v for b, v in state.folders.items() if b != touched[0]} == {b: v for b, v in folders.items() if b != touched[0]}
    assert state.merged().where("k = 'k3'").first()["_group_size"] == 5
    with pytest.raises(Exception, match="outside the list"):
        MergeState(spark, str(tmp_path / "s"), df.withColumn("source", F.lit("x")).schema, ["k"]).add(df.withColumn("source", F.lit("x")), "a")


@pytest.fixture
def pages(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 13).alias("b"), F.lit("x").alias("c")).repartition(7)
    # A third of all rows are copies of one.
    df = df.unionByName(spark.range(500).select(F.lit(3).cast("long").alias("a"), F.lit(5).cast("long").alias("b"), F.lit("y").alias("c")))
    return df, PageDirectory.build(df, ["a", "b"], str(tmp_path / "pages"), rows_per_range=128)


def key(r):
    return tuple((v is not None, v or 0) for v in r[:2])


def test_pages(spark, pages):
    df, directory = pages
    everything = sorted((tuple(r) for r in df.collect()), key=key)
    assert directory.total == 1500 and directory.directory().count() == 12
    for limit, offset in ((100, 0), (128, 100), (1, 700), (300, 1400), (50, 1500), (0, 3), (1500, 0)):
        page = [tuple(r) for r in directory.page(limit, offset).collect()]
        assert [key(r) for r in page] == [key(r) for r in everything[offset : offset + limit]]
    together = [tuple(r) for k in range(0, 1500, 70) for r in directory.page(70, k).collect()]
    assert sorted(together, key=str) == sorted(everything, key=str)
    # Another reader of the folder, and the page behind a key.
    again = PageDirectory(spark, directory.root)
    for wanted in ((3, 5), (3, None), (0, None), (9, 12), (-1, 0), (50, 0), (3, 4)):
        place = sum(key(r) <= key(wanted) for r in everything)
        assert again.place_after(wanted) == place
        assert [key(r) for r in again.page_after(wanted, 20).collect()] == [key(r) for r in everything[place : place + 20]]


def test_page_opens_its_ranges(pages):
    _, directory = pages
    for offset in (0, 500, 1000):
        page = directory.page(128, offset)
        plan = page._jdf.queryExecution().executedPlan()
        found = re.search(r"PartitionFilters: \[([^\]]*)\]", plan.toString())[1]
        first, last = (int(x) for x in re.findall(r"[<>]= (\d+)", found))
        assert (first, last) == (offset // 128, (offset + 127) // 128) and last - first <= 1


def test_many_small_ranges_share_folders(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    directory = PageDirectory.build(df, ["a", "b"], str(tmp_path / "small"), rows_per_range=2)
    everything = sorted(tuple(r) for r in df.collect())
    assert len(list((tmp_path / "small" / "rows").glob("_range=*"))) <= 256
    assert directory.directory().count() == 1500 and {r["n"] for r in directory.directory().collect()} == {2}
    for limit, offset in ((3, 0), (50, 1001), (10, 2995), (3000, 0)):
        assert [tuple(r) for r in directory.page(limit, offset).collect()] == everything[offset : offset + limit]
    assert directory.place_after([3, 500]) == sum(r <= (3, 500) for r in everything)


def test_empty_pages(spark, tmp_path):
    directory = PageDirectory.build(spark.createDataFrame([], "a long, b string"), ["a"], str(tmp_path / "none"))
    assert directory.total == 0 and directory.page(10).count() == 0 and directory.place_after([5]) == 0
    with pytest.raises(FileNotFoundError):
        PageDirectory(spark, str(tmp_path / "nowhere"))


def test_history(spark, tmp_path):
    schema = "table_name string, record_key string, record string, errors array<struct<rule: string>>"
    first = spark.createDataFrame([("t", "1", "", [("a",), ("b",)]), ("t", "2", "", [("a",)]), ("t", None, "", [("c",)]), ("u", "1", "", [("a",)]), ("t", "5", "", [])], schema)
    second = spark.createDataFrame([("t", "2", "", [("a",)]), ("t", "3", "", [("a",)]), ("t", "1", "", [("b",)]), ("t", "1", "", [("a",), ("d",)]), ("t", None, "", [("c",)])], schema)
    runs = history.RunHistory(spark, str(tmp_path))
    assert runs.append("r1", {"quarantine": first, "audit": first.limit(1)}) and runs.append("r2", {"quarantine": second})
    before = files(tmp_path)
    assert not history.RunHistory(spark, str(tmp_path)).append("r1", {"quarantine": second})
    assert files(tmp_path) == before
    runs = history.RunHistory(spark, str(tmp_path))
    assert runs.read("quarantine").count() == 10 and runs.read("quarantine", "r2").select("run_id").distinct().first()[0] == "r2"
    with pytest.raises(KeyError):
        runs.read("audit", "r2")
    # What a failed attempt left is not read.
    second.write.parquet(f"{tmp_path}/quarantine/_attempt=a-lost")
    assert runs.read("quarantine").count() == 10
    drift = runs.drift("r1", "r2")
    assert rows(drift) == sorted(
        [
            ("t", "1", "still failing", True, "a,b", "a,b,d", 1, 2),
            ("t", "2", "still failing", False, "a", "a", 1, 1),
            ("t", "3", "new", False, None, "a", None, 1),
            ("t", "5", "cured", False, "", None, 1, None),
            ("t", None, "still failing", False, "c", "c", 1, 1),
            ("u", "1", "cured", False, "a", None, 1, None),
        ],
        key=str,
    )
    assert rows(history.drift_counts(drift)) == [("t", "cured", 1, 0), ("t", "new", 1, 0), ("t", "still failing", 3, 1), ("u", "cured", 1, 0)]
