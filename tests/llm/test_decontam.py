"""Benchmark search against a plain scan of windows."""

import hashlib
import random
import re

import pytest

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import decontam, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    by_window = {}
    for item_id, text in items:
        w = words(text)
        for k in range(max(len(w) - 12, min(1, len(w)))):
            by_window.setdefault(tuple(w[k : k + 13]), set()).update([] if item_id is None else [str(item_id)])
    sizes = {len(x) for x in by_window}
    out = []
    for doc_id, text in docs:
        w, hit, owners = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (found := by_window.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    owners |= found
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(owners), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as items", "1 as segment")
    b = spark.createDataFrame(items, "item_id long, text string")
    return sorted([tuple(r) for r in decontam.digests(decontam.contamination(d.repartition(3), b, **options)).collect()], key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "Dé", "ß", "x1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 12, 13, 14, 25])))) for i in range(30)]
    docs = []
    for i in range(120):
        parts = [rng.choice([rng.choice(items)[1], " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30)))]) for _ in range(3)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(500, None), (501, ""), (501, ""), (502, "a " * 50000)]
    expected = brute(docs, items)
    assert run(spark, docs, items) == expected
    assert run(spark, docs, items, block_bytes=60) == expected


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute(docs, items)
    assert any(r[-1] for r in expected)
    assert sorted([tuple(r) for r in queries.op4_decontamination(spark, sf).collect()], key=str) == expected


@pytest.mark.parametrize(("docs", "items"), [([], []), ([(1, "a b")], []), ([(1, "a b")], [(3, "c"), (2, None)])])
def test_empty(spark, docs, items):
    assert [r[2:4] for r in run(spark, docs, items)] == [(0, 0)] * len(docs)


def test_items_without_id_hit(spark):
    """Their windows count as hits; they have no name among the items. A repeated item is one."""
    passage = " ".join(f"w{k}" for k in range(20))
    docs = [(1, f"x {passage} y"), (2, "own words"), (3, f"{passage} b b")]
    items = [(None, passage)] * 30 + [(5, "b b"), (5, "b b"), (None, None)]
    found = run(spark, docs, items)
    assert found == brute(docs, items) and [r[2] for r in found] == [20, 0, 22] and [r[3] for r in found] == [0, 0, 1]
    assert run(spark, docs, items, block_bytes=40) == found


def test_columns_of_any_name_survive(spark):
    passage = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, passage, "a", 1), (2, "own", "b", 2), (None, None, None, 3)], "doc_id long, text string, key string, row int")
    kept = decontam.drop_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.schema == docs.schema and sorted(map(tuple, kept.collect()), key=str) == [(2, "own", "b", 2), (None, None, None, 3)]


def test_phrase_and_proximity(spark):
    docs = spark.createDataFrame([(1, "The cat sat, the CAT ran"), (2, "cat the dog the cat"), (3, "the"), (None, None)], "doc_id long, text string").coalesce(1)
    index = decontam.build_index(docs)
    exact = decontam.phrase_matches(index, {"p": "the cat", "q": "the", "none": ""})
    assert sorted(tuple(r) for r in exact.where("phrase = 'p'").collect()) == [(1, "p", 0, 2), (1, "p", 3, 5), (2, "p", 3, 5)]
    near = decontam.phrase_matches(index, {"p": "cat dog"}, near=3)
    assert sorted(tuple(r) for r in near.collect()) == [(2, "p", 0, 3), (2, "p", 2, 5)]


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows_of_spark(queries.op4_decontamination(spark, sf)) == rows_of_sql(connect(sf), queries.ORACLE_SQL["op4_decontamination"])
