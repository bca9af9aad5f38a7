"""Repeated strings against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import queries, suffixes


def brute(rows):
    """Rows of different ids, or equal ones."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = True
            seen.add(window)
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out[doc_id] = (doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return sorted((out[doc_id] for doc_id, _ in rows), key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def passages(rng, n):
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([5, 20, 60]))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(suffixes, "FIRST_PART", 500)
    monkeypatch.setattr(suffixes, "LAST_PART", 100)
    pieces = passages(rng, 12)
    rows = [(i * 3, " ".join(rng.choice([rng.choice(pieces), *passages(rng, 1)]) for _ in range(rng.randrange(1, 6)))) for i in range(80)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]
    rows += [(2000, "ab" * 400), (2001, "x" * 350 + "y" + "x" * 350), (2002, "ab" * 60), (2003, pieces[2][:99]), (2004, rows[3][1] + "!"), (2005, None), (2006, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(suffixes.digests(suffixes.deduplicated(docs))) == brute(rows)


def test_edges(spark):
    assert suffixes.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "long text " * 30), (1, None), (2, "own " * 5), (2, "own " * 5), (3, "long text " * 30), (3, "long text " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("check", F.lit(1)).withColumn("z", F.lit("z"))
    assert got(suffixes.digests(suffixes.deduplicated(docs))) == brute(rows)


def test_last_pass_is_exact():
    data = np.frombuffer(b"A" * 150 + b"B" + b"A" * 150, np.uint8)
    starts = np.arange(202)
    left, group = suffixes.equal_windows(data, starts, np.zeros(202, np.int64))
    classes = {}
    for k, g in zip(left, group):
        classes.setdefault(g, set()).add(bytes(data[starts[k] : starts[k] + 100]))
    assert all(len(c) == 1 for c in classes.values())
    assert {int(k) for k in left} == {s for s in range(202) if b"B" not in bytes(data[s : s + 100])}


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op9_suffixes(spark, sf)) == brute(rows)


def test_shared_passage_is_few_entries_of_a_task():
    """An anchor or window of all documents, with other text around it in each, does not go on once for each document."""
    rng = random.Random(7)
    passage = bytes(rng.randrange(97, 123) for _ in range(150))
    texts = [bytes(rng.randrange(97, 123) for _ in range(120)) + passage + bytes(rng.randrange(97, 123) for _ in range(120)) for _ in range(300)]
    offsets = np.cumsum([0, *map(len, texts)])
    hashes, place, start, last, context = suffixes.anchors(np.frombuffer(b"".join(texts), np.uint8), offsets)
    row = np.searchsorted(offsets, start, side="right") - 1
    n, at = last - start + 1, start - offsets[row]
    assert np.unique(hashes, return_counts=True)[1].max() >= 300
    dealt, anchor, *_, state = suffixes._together(suffixes._SEVERAL, hashes, context, row, row, at, n, place - start)
    assert np.unique(anchor[state < suffixes._AGAIN], return_counts=True)[1].max() <= suffixes._SEVERAL
    assert np.unique(dealt, return_counts=True)[1].max() <= suffixes._SEVERAL
    contexts = [texts[r][a : a + k + 99] for r, a, k in zip(row, at, n, strict=True)]
    dealt, *_, counts = suffixes._windows(row, row, at, n, contexts)
    assert np.unique(dealt, return_counts=True)[1].max() == 1
    windows = [text[k : k + 100] for text in texts for k in range(len(text) - 99)]
    assert counts.sum() == len(windows) - len(set(windows))


@pytest.mark.parametrize("several", [1, 8])
def test_pieces_of_tasks_agree(spark, several, monkeypatch):
    """Contexts and windows that are put together in several pieces of a task."""
    rng = random.Random(11)
    for name, value in (("_SEVERAL", several), ("_ENTRIES", 40), ("_WINDOWS", 100), ("_STEP", 2000), ("FIRST_PART", 500), ("LAST_PART", 20)):
        monkeypatch.setattr(suffixes, name, value)
    passage, pieces = " ".join(passages(rng, 6)), passages(rng, 6)
    rows = [(i, " ".join([passages(rng, 1)[0], passage[: rng.randrange(100, 300)], rng.choice(pieces), *passages(rng, 1)])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(suffixes.digests(suffixes.deduplicated(docs))) == brute(rows)


@pytest.mark.parametrize("parts", [1, 4])
def test_repeated_row_keeps_what_stands_first(spark, parts):
    rng = random.Random(13)
    p, q, x, y = ("".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(4))
    rows = [(1, p + q), (2, x + p + y), (2, x + p + y), (3, y + p[:120] + x)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "doc_id long, text string")
    assert got(suffixes.digests(suffixes.deduplicated(docs))) == brute(rows)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows_of_spark(queries.op9_suffixes(spark, sf)) == rows_of_sql(connect(sf), queries.ORACLE_SQL["op9_suffixes"])


def test_texts_of_one_id_with_equal_short_hashes(spark):
    """What only one of two texts repeats stays in the other, also where a 32-bit hash cannot tell them apart."""
    passage = "".join(f"{k:x} of it, " for k in range(40))
    own = F.concat(*[F.md5(F.concat(F.lit(salt), "id")) for salt in "abcde"], F.lit(" "), "id")
    other = F.concat(F.lit(passage), "id")
    texts = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, own).otherwise(other).alias("text"))
    same = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("texts")).where("size(texts) = 2").collect()
    pairs = [r["texts"] for r in same if sum(t.startswith(passage) for t in r["texts"]) == 1]
    assert pairs
    rows = [(1, passage), *[(None, t) for t in pairs[0]], *[(7, t) for t in pairs[-1]]]
    found = sorted((str(r["doc_id"]), bytes(r["text"]).decode().startswith(passage), list(r["starts"])) for r in suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect())
    assert [(d, p, bool(s)) for d, p, s in found if d == "7"] == [("7", False, False), ("7", True, True)]
    assert not any(s for d, p, s in found if d == "None")
