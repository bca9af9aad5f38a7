"""The shingle join against comparing every pair, and signatures against random similar sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import graphs, queries
from millrace.llm import ngram_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j > k}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[root(j)] = root(k)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def edited(rng, text, rate):
    words = text.split(" ")
    for _ in range(int(len(words) * rate) + rng.randrange(2)):
        at = rng.randrange(len(words) + 1)
        words[at : at + rng.randrange(2)] = [rng.choice("pqrs") * rng.randrange(1, 4)] * rng.randrange(2)
    return rng.choice([" ", "\n", "\t "]).join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(J, "PART", 300)
    monkeypatch.setattr(J, "RUN_DOCUMENTS", 20)
    monkeypatch.setattr(J, "BLOCK", 16)
    monkeypatch.setattr(J, "HUB_BLOCK", 5)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 5))) for _ in range(200)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    bases = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 3, 4, 5, 7, 9, 12, 20, 35, 60, 120, 400)]
    rows = [(k, edited(rng, rng.choice(bases), rng.choice([0, 0.01, 0.03, 0.06]))) for k in range(100)]
    rows += [(200 + k, " ".join(rng.choice(words) for _ in range(30)) + " " + passage) for k in range(30)]
    rows += [(300 + k, bases[-2].upper()) for k in range(30)] + [(400, None), (401, ""), (402, " \n"), (403, "same " * 2000), (404, "same " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(J.join(docs)) == brute(rows)


def test_signatures_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    common = (rng.integers(0, 5, J.COUNTED) * (rng.random(J.COUNTED) < 0.5)).astype(np.uint8)
    tried = 0
    while tried < 400:
        n = max(1, int(rng.choice([1, 2, 3, 4, 5, 7, 10, 13, 20, 36, 50, 80, 150, 300, 700])) + int(rng.integers(-1, 2)))
        a = np.unique(J.mix(rng.integers(0, 1 << 62, n).astype(np.uint64)))
        kept = a[rng.permutation(n)[int(rng.integers(0, n // 4 + 1)) :]]
        b = np.unique(np.concatenate([kept, J.mix(rng.integers(0, 1 << 62, int(rng.integers(0, n // 3 + 2))).astype(np.uint64))]))
        both = len(np.intersect1d(a, b))
        if J.similar(both, len(a), len(b)):
            tried += 1
            assert len(np.intersect1d(J.signatures(a), J.signatures(b)))
            assert len(np.intersect1d(J.signatures(a, common), J.signatures(b, common)))
            x, y = (np.frombuffer(J.sketch(s), np.uint8)[None] for s in (a, b))
            width = min(x.shape[1], y.shape[1])
            distance = J._distance(J._folded(x, width), J._folded(y, width))
            assert distance[0, 0] <= len(a) + len(b) - 2 * both
            assert J.may_link(np.array([len(a)]), np.array([len(b)]), distance[0])[0]


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100 + rng.randrange(60), 100 + rng.randrange(60)) for _ in range(50)] + [(500, 500 + k) for k in range(1, 30)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    wanted = {x: root(x) for x in parent}
    rows = graphs.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in rows} == wanted and len(rows) == len(wanted)
    assert graphs.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, "a b c d e f"), (None, "a b c d e f"), (7, "x y"), (7, "x y"), (7, None), (8, "x y")]])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("check", "size", "node", "part")})
    assert got(J.join(docs)) == brute(rows)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == ([(7, "x y"), (7, None), (None, "a b c d e f")] if rows else [])


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op3_ngram_join(spark, sf)) == brute(rows)


def signed(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return set(J.signatures(J.shingle_sets(data, np.array([0, len(data)]))[0]).tolist())


def test_copies_in_another_partition(spark):
    """Pairs E-F that meet only in signatures with an unrelated smaller D, every row once more in another partition."""
    rng, rows = random.Random(5), []
    while len(rows) < 18:
        words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(24)]
        d, e = " ".join(words[:9] + words[17:]), " ".join(words[:16])
        f = " ".join(words[:15] + words[16:17])
        both = signed(e) & signed(f)
        if both and both <= signed(d):
            rows += [(len(rows) + k, text) for k, text in enumerate((d, e, f))]
    rows += [(100 + k, text) for k, text in rows]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    assert got(J.join(docs)) == brute(rows)


def test_keep_one_of_each_component(spark):
    """Unrelated texts under null ids, and under one id, are components of their own."""
    texts = [" ".join(f"{c}{k}" for k in range(12)) for c in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[3]), (None, texts[4]), (9, texts[4])]
    kept = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4])], key=str
    )


def test_runs_close_within_a_step(monkeypatch):
    """A step larger than what is left of a run: no run has more documents than can be numbered."""
    monkeypatch.setattr(J, "RUN_DOCUMENTS", 20)
    monkeypatch.setattr(J, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})())}))
    texts = [f"own{k} words of text{k}".encode() for k in range(90)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(90)), "check": list(range(90)), "text": pa.array(texts, pa.binary())})
    nodes = [n for out in J._sign(3)(iter([batch])) for n in out.column("node").to_pylist() if n is not None]
    assert len(set(nodes)) == 90 and max(n & 0xFFFF for n in nodes) < 20


def test_keep_one_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (3, None, None, 3)], "doc_id long, text string, check string, _doc int")
    docs = docs.withColumns({"wordless": F.lit("w"), "component": F.lit(5), "row": F.lit(1.5)})
    kept = J.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [(1, "a b c d e f", "x", 1, "w", 5, 1.5), (3, None, None, 3, "w", 5, 1.5)]


def test_groups_of_many_documents(spark, monkeypatch):
    """A large group of near copies, one row very often, and a passage many documents share: settled within groups."""
    monkeypatch.setattr(J, "BLOCK", 32)
    monkeypatch.setattr(J, "HUB_BLOCK", 16)
    monkeypatch.setattr(J, "CELL_ROWS", 100)
    monkeypatch.setattr(J, "FEW", 8)
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, "the very same text of seven words") for k in range(400)]
    passage = " ".join(base[:60])
    rows += [(2000 + k, passage + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([8, 11, 14, 30])))) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(J.join(docs)) == brute(rows)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows_of_spark(queries.op3_ngram_join(spark, sf)) == rows_of_sql(connect(sf), queries.ORACLE_SQL["op3_ngram_join"])
