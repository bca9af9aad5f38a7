"""Merges against a plain sequential model, on random rows in any partitioning."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup

SCHEMA = "_seq bigint, source string, email string, name string, n int"


def random_rows(seed, count=300):
    rng = random.Random(seed)
    rows = []
    for seq in range(count):
        # A third of all rows has no key, and one key takes much of the rest.
        email = rng.choice([None, None, None, " A@x.vn", "a@X.vn ", "a@x.vn", "null", "", f"m{rng.randint(0, 40)}@x.vn"])
        rows.append((seq, rng.choice(["postgresql", "csv"]), email, rng.choice([None, "", " ", f"n{seq}"]), rng.choice([None, 0, 0, seq])))
    return rows


def key_of(row):
    return "null" if row[2] is None else row[2].strip().lower()


def model_merge(rows):
    groups = {}
    for row in rows:
        groups.setdefault(key_of(row), []).append(row)
    out = set()
    for members in groups.values():
        merged = list(members[0])
        for row in members[1:]:
            for i in range(1, 5):
                if row[i] is not None and row[i] != "" and not merged[i]:
                    merged[i] = row[i]
        sources = ",".join(dict.fromkeys(r[1] for r in members)) if len(members) > 1 else None
        out.add((*merged, len(members), sources))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("sources", [None, ["csv", "postgresql"]])
def test_merge_equals_a_sequential_fold(spark, seed, sources):
    rows = random_rows(seed)
    shuffled = rows[:]
    random.Random(99).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, SCHEMA).repartition(5)
    out = dedup.dedup_merge(df, ["email"], sources=sources)
    got = {(r._seq, r.source, r.email, r.name, r.n, r._group_size, r._sources) for r in out.collect()}
    assert got == model_merge(rows)


def test_merge_of_gaps(spark):
    rows = [(1, "s", "i", "a", 0), (2, "s", "i", "a", 5), (3, "s", "j", "", None), (4, "s", "j", "b", 0),
            (5, "s", "k", " ", None), (6, "s", "k", "b", None)]
    out = dedup.dedup_merge(spark.createDataFrame(rows, SCHEMA), ["email"], sources=["s"])
    assert {(r.email, r.name, r.n) for r in out.collect()} == {("i", "a", 5), ("j", "b", 0), ("k", " ", None)}


def test_unlisted_source_is_an_error(spark):
    df = spark.createDataFrame(random_rows(0), SCHEMA)
    with pytest.raises(Exception, match="outside the list"):
        dedup.dedup_merge(df, ["email"], sources=["csv"]).collect()


def test_missing_keys_kept_apart(spark):
    rows = random_rows(1)
    out = dedup.dedup_merge(spark.createDataFrame(rows, SCHEMA), ["email"], null_keys="keep")
    assert out.where("email IS NULL").count() == sum(r[2] is None for r in rows)


def test_first_find_counts(spark):
    rows = random_rows(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    firsts = {}
    later = []
    for row in rows:
        if key_of(row) in firsts:
            later.append((key_of(row), firsts[key_of(row)][0], row[0]))
        else:
            firsts[key_of(row)] = row
    assert {tuple(r) for r in dedup.dedup_first(df, ["email"]).collect()} == set(firsts.values())
    found = dedup.find_duplicates(df, ["email"]).collect()
    assert {(r._key, r.existing._seq, r.duplicate._seq) for r in found} == set(later) and len(found) == len(later)
    counts = dedup.dedup_counts(df, ["email"], "t").first()
    assert (counts.original, counts.after, counts.removed) == (300, len(firsts), len(later))
    analysis = dedup.analyze_duplicates(df, ["email"], "t").first()
    assert analysis.duplicate_percentage == f"{len(later) / 3:.2f}%"
    assert [s.position for s in analysis.samples] == [x[2] for x in later[:3]]


def test_analysis_of_an_empty_table(spark):
    analysis = dedup.analyze_duplicates(spark.createDataFrame([], SCHEMA), ["email"], "t").first()
    assert analysis.total_records == 0 and analysis.duplicate_percentage is None and analysis.samples == []


def test_report_and_untouched_tables(spark):
    df = spark.createDataFrame(random_rows(0), SCHEMA)
    report = {r.table_name: r for r in dedup.dedup_report({"a": df, "b": df}, {"a": ["email"]}).collect()}
    assert report["b"].removed == 0 and report["total"].original == 600
    assert dedup.dedup_all({"b": df}, {})["b"] is df


def test_two_sources(spark):
    schema = "_seq bigint, email string, name string, n int"
    first = spark.createDataFrame([(1, "a@x", "old", 1), (2, " A@x", "", 2), (3, "b@x", "b", 0), (8, None, "z", 1)], schema)
    second = spark.createDataFrame([(4, "a@x", "new", 9), (5, "c@x", "", None), (6, "C@x ", "c", 3), (7, "b@x", "bb", 7)], schema)
    out = dedup.merge_two_sources(first, second, "email", on_null="reject").collect()
    assert {(r.email, r.name, r.n, r.sources) for r in out} == {
        (" A@x", "new", 2, "ds1,ds2"), ("b@x", "b", 7, "ds1,ds2"), ("c@x", "c", 3, "ds2"),
    }
    assert [r._seq for r in dedup.null_key_rows(first, second, "email").collect()] == [8]
    with pytest.raises(Exception, match="missing key"):
        dedup.merge_two_sources(first, second, "email").collect()


def test_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "i int, s string")
    assert dedup.drop_exact(df).count() == 2


def test_composite_key(spark):
    df = spark.createDataFrame([(" A ", None, 3)], "a string, b string, c int")
    assert df.select(dedup.composite_key(["a", "b", "c"])).first()[0] == "a|null|3"
    assert df.select(dedup.composite_key([F.lit("X"), "c"])).first()[0] == "x|3"


def test_hot_group_of_duplicates_is_split(spark):
    df = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("_seq"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 15000).cast("string"))).alias("email"),
        F.concat(F.lit("some text "), F.col("id").cast("string")).alias("name"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = dedup.find_duplicates(df, ["email"])
        # 10000 keys of four rows each, and one of 20000 rows.
        assert len(found.collect()) == 60000 - 10001
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_report_counts_what_the_merge_keeps(spark):
    df = spark.createDataFrame([(1, "a", "csv"), (2, None, "csv"), (3, None, "csv"), (4, "A", "csv")], "_seq bigint, email string, source string")
    for null_keys, after in (("merge", 2), ("keep", 3)):
        assert dedup.dedup_merge(df, ["email"], null_keys=null_keys).count() == after
        assert dedup.dedup_counts(df, ["email"], "t", null_keys).first().after == after


def test_duplicates_of_one_position(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, "b", "z")], "_seq bigint, email string, v string")
    assert dedup.find_duplicates(df, ["email"]).count() == 1
