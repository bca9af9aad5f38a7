"""Reversed search against SQL and against a plain version."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import queries, search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=10):
    """(item_id, rank, doc_id, score) straight from the contract's formulas."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for i, t in dict.fromkeys(items):
        wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, query in wanted.items():
        scored = []
        for d, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // max(total, 1)
            score = 0
            for t, repeats in query.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is not None, d or 0))
        for rank, (score, known, d) in enumerate(sorted(scored)[:best], 1):
            out.append((i, rank, d if known else None, -score))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def frames(spark, docs, items):
    extra = {c: F.lit("x") for c in ("score", "rank", "shard", "terms", "n")}
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumns(extra).repartition(5),
        spark.createDataFrame(items, "item_id long, text string").withColumns(extra).repartition(3),
    )


DOCS = [(k, f"alpha {'beta ' * (k % 4)}Gamma{k % 7} été-{k % 3} x") for k in range(150)]
DOCS += [(None, "beta alpha alpha"), (None, "nothing else"), (200, None), (201, ""), (202, " -- ."), (203, "zeta ZETA zeta")]
# Copies of one row, ties with equal scores, and one id with two texts.
DOCS += [(300, "delta beta")] * 40 + [(k, "Delta delta") for k in range(400, 440)] + [(7, "delta epsilon"), (7, "epsilon delta delta")]
ITEMS = [(1, "Alpha beta BETA"), (2, "delta"), (3, None), (4, "..."), (5, "unheard of"), (6, "été zeta gamma3 gamma3")]
ITEMS += [(2, "delta"), (7, "epsilon"), (7, "alpha"), (None, "zeta beta")]


def test_sql(spark):
    assert rows_of_spark(queries.op11_search(spark, SF)) == rows_of_sql(connect(SF), queries.ORACLE_SQL["op11_search"])


def test_brute(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert got(search.search(docs, items)) == brute(DOCS, ITEMS)
    assert got(search.search(docs, items, best=3)) == brute(DOCS, ITEMS, best=3)


def test_blocks_and_steps(spark, monkeypatch):
    """The same rows whatever the sizes of blocks of items."""
    monkeypatch.setattr(search, "BLOCK_BYTES", 100)
    docs, items = frames(spark, DOCS, ITEMS)
    assert got(search.search(docs, items)) == brute(DOCS, ITEMS)


def test_long_text():
    """Pieces of a text end between terms."""
    text = b"abc Def9 " * 400_000 + b"y" * 3_000_000 + b" end"
    found = Counter(t for part in search.terms_of(text) for t in part)
    assert found == Counter({b"abc": 400_000, b"def9": 400_000, b"y" * 3_000_000: 1, b"end": 1})


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty(spark, empty):
    docs, items = frames(spark, DOCS, ITEMS)
    docs, items = (docs.limit(0) if empty != "items" else docs), (items.limit(0) if empty != "docs" else items)
    found = search.search(docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
