"""Rules and repairs in plain Python, the closest value of a large domain, messages that land twice, running counters."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import catalog as C
from millrace.operators import domains, opaque, repair, rules, validate
from millrace.operators.repairs import RepairRegistry
from millrace.streaming import envelopes
from millrace.streaming.ingest import StagingArea, ingest, ingest_counters, read_staged
from millrace.streaming.progress import IngestProgress


def test_python_rule_and_repair(spark):
    rows = spark.createDataFrame([(1, "ab", "x" * 50), (2, None, None), (3, "abc", "y")], "_seq long, code string, other string").repartition(2)
    registry = rules.RuleRegistry()
    registry.add("code", opaque.python_rule("code", lambda v: v is not None and len(v) % 2 == 1, "odd_length", C.OUT_OF_RANGE, "odd", True))
    checked = validate.validate(rows, registry)
    assert {r["_seq"]: [(e["rule"], e["code"], e["message"]) for e in r[validate.ERRORS]] for r in checked.collect()} == {1: [], 2: [], 3: [("odd_length", C.OUT_OF_RANGE, "odd")]}
    plan = checked.select("_seq", validate.IS_VALID)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and re.search(r"ArrowEvalPython \[run\(code#\d+\)", plan)
    repairs = RepairRegistry()
    repairs.add("code", opaque.python_repair(lambda v: None if v is None else v + "!"))
    assert {r["_seq"]: r["code"] for r in repair.repair(checked, repairs).collect()} == {1: "ab", 2: None, 3: "abc!"}


@pytest.mark.parametrize(
    ("function", "message"),
    [(lambda values: values[:-1], "returned 2 values for 3"), (lambda values: ["x"] * len(values), "no bigint"), (lambda values: [object()] * len(values), "no bigint")],
)
def test_python_answers_are_checked(spark, function, message):
    column = opaque.python_column(function, T.LongType())
    with pytest.raises(Exception, match=message):
        spark.range(3).coalesce(1).select(column(F.col("id"))).collect()
    good = opaque.python_column(lambda values: [None if v is None else v + 1 for v in values], T.LongType())
    assert [r[0] for r in spark.createDataFrame([(1,), (None,)], "a long").coalesce(1).select(good(F.col("a"))).collect()] == [2, None]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def fold(text):
    return "".join(text.lower().split())


def test_closest_equals_brute_force(spark):
    rng = random.Random(6)
    values = list(dict.fromkeys("".join(rng.choice("abcdé") for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 10, 14, 20]))) for _ in range(500)))
    values = [v.upper() if k % 5 == 0 else v[: len(v) // 2] + " " + v[len(v) // 2 :] if k % 7 == 0 else v for k, v in enumerate(values)]
    texts = ["", " ", None, "zzzzzz", *values[:40]]
    for _ in range(250):
        t = list(fold(rng.choice(values)))
        for _ in range(rng.randrange(0, 6)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randrange(2)] = [rng.choice("abcdé")] * rng.randrange(2)
        texts.append("".join(t))
    domain = spark.createDataFrame(list(enumerate(values)), "place int, value string").unionByName(spark.createDataFrame([(9999, None)], "place int, value string"))
    index = domains.DomainIndex(domain, "value", "place")
    frame = spark.createDataFrame([(t, "x") for t in texts], "t string, value string").repartition(3)
    found = {r["t"]: r["closest"] for r in domains.add_closest(frame, "t", index, "closest").collect()}
    for t in set(texts):
        near = [(d, k, v) for k, v in enumerate(values) if t is not None and (d := levenshtein(fold(t), fold(v))) <= int(len(fold(v)) * C.STATUS_SIMILARITY)]
        assert found[t] == (min(near)[2] if near else None), t
    assert domains.add_closest(frame, "t", index, "closest").count() == len(texts)
    none = domains.DomainIndex(domain.limit(0), "value", "place")
    assert domains.add_closest(frame, "t", none, "closest").where("closest IS NOT NULL").count() == 0


def test_fifty_thousand_values(spark):
    """Exact for every text that was made from a value by one edit, in one equi-join."""
    rng = random.Random(8)
    values = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(50_000)]
    index = domains.DomainIndex(spark.createDataFrame([(v, k) for k, v in enumerate(values)], "v string, k int"), "v", "k", similarity=0.12)
    texts = [v[:4] + "z" + v[5:] for v in values[:300]]
    best = domains.add_closest(spark.createDataFrame([(t,) for t in texts], "t string"), "t", index, "c")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    found = {r["t"]: r["c"] for r in best.collect()}
    assert all(found[t] is not None and levenshtein(t, found[t]) == 1 for t in texts)
    with pytest.raises(ValueError, match="DomainIndex"):
        rules.closest_value(F.col("t"), values)


RATINGS = "ma_danh_gia string, ma_khach_hang string, diem_danh_gia int, _seq long"


def test_message_twice(spark, tmp_path):
    """A chunk that lands again, in the same drain or a later one, is staged once; another chunk of its number is not lost."""
    landing, area = f"{tmp_path}/landing", StagingArea(f"{tmp_path}/area")
    frame = lambda ids: spark.createDataFrame([(f"DG{k}", f"KH{k}", 3, k) for k in ids], RATINGS)

    def publish(name, ids):
        envelopes.write_envelopes(frame(ids), "danh_gia", C.CSV, f"{landing}/{C.CSV}/{name}", ["_seq"], 10, drop=["_seq"])

    def drain():
        ingest(spark, landing, f"{tmp_path}/checkpoint", area, sources=[C.CSV], once="1 day")
        return sorted(r[0] for r in read_staged(spark, area)["danh_gia"].select("ma_danh_gia").collect())

    publish("a", range(25))
    publish("b", range(25))
    assert drain() == sorted(f"DG{k}" for k in range(25))
    publish("c", range(25))
    publish("d", range(100, 105))
    assert drain() == sorted(f"DG{k}" for k in [*range(25), *range(100, 105)])
    assert ingest_counters(spark, area).first()["total_records"] == 30


def test_progress(spark, tmp_path):
    landing, area = f"{tmp_path}/landing", StagingArea(f"{tmp_path}/area")
    frame = spark.createDataFrame([(f"DG{k}", f"KH{k}", 3, k) for k in range(95)], RATINGS)
    envelopes.write_envelopes(frame, "danh_gia", C.CSV, landing, ["_seq"], 10, drop=["_seq"])
    spark.createDataFrame([("no envelope",), ('{"table":"other","recordCount":7}',)], "value string").coalesce(1).write.mode("append").text(f"{landing}/{C.CSV}/danh_gia")
    with IngestProgress(spark) as progress:
        ingest(spark, landing, f"{tmp_path}/checkpoint", area, sources=[C.CSV], max_files=1, progress=progress)
        assert progress.batches[C.CSV] > 1
        assert sorted(map(tuple, progress.counters().collect())) == [("csv", "danh_gia", 10, 95), ("csv", "unknown", 2, 7)]
    assert read_staged(spark, area)["danh_gia"].count() == 95


def _without_cache(monkeypatch, spark):
    """Frames stay as if their cached blocks were lost, so that every branch computes them again."""
    seen, kind = [], type(spark.range(1))
    monkeypatch.setattr(kind, "persist", lambda self, *level: seen.append(self) or self)
    monkeypatch.setattr(kind, "unpersist", lambda self, *blocking: self)
    return seen


def test_progress_of_partitions_computed_twice(spark, tmp_path, monkeypatch):
    landing, area = f"{tmp_path}/landing", StagingArea(f"{tmp_path}/area")
    frame = spark.createDataFrame([(f"DG{k}", f"KH{k}", 3, k) for k in range(95)], RATINGS)
    envelopes.write_envelopes(frame, "danh_gia", C.CSV, landing, ["_seq"], 10, drop=["_seq"])
    _without_cache(monkeypatch, spark)
    with IngestProgress(spark) as progress:
        ingest(spark, landing, f"{tmp_path}/checkpoint", area, sources=[C.CSV], progress=progress)
    assert [tuple(r) for r in progress.counters().collect()] == [("csv", "danh_gia", 10, 95)]
    positions = [r[0] for r in read_staged(spark, area)["danh_gia"].orderBy("ma_khach_hang").select(C.ORDER_COLUMN).collect()]
    assert len(set(positions)) == 95


def test_progress_of_a_batch_that_ran_again(spark):
    progress = IngestProgress(spark)
    for batch, n in (("a-0", 3), ("a-1", 2), ("a-1", 2)):
        progress.finished("csv", batch, [("danh_gia", n, 10 * n)])
    assert [tuple(r) for r in progress.counters().collect()] == [("csv", "danh_gia", 5, 50)] and progress.batches["csv"] == 2
