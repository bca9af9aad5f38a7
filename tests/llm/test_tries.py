"""The trie of conversations against SQL and against a plain version; running totals and list ranking on their own."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import queries, scans, tries

SF = "/root/testdata/sf0.001"


def brute(rows):
    """Nodes as in the contract, by plain dictionaries."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in by.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9 if c is not None else 0
        source = c - int(c - 5 * int(c / 5)) if c is not None else None
        whole[c] = tuple((turns.get(source, []) if c is not None else [])[:h] + own[h:])
    members = {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    least = {s: min((c for c in m if c is not None), default=None) for s, m in members.items()}
    children, leaves, saved = {}, {s: 0 for s in members}, {s: 0 for s in members}
    for s in members:
        if s:
            children[s[:-1]] = children.get(s[:-1], 0) + 1
    for s, m in members.items():
        saving = (len(m) - 1) * len(s[-1][1].encode()) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += saving
            leaves[s[:d]] += s not in children
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if c is not None and whole[c] == s))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((least[s], len(s), least[s[:-1]] if s else None, len(m), children.get(s, 0), leaves[s], saved[s], digest))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select(*tries.COLUMNS).collect()], key=str)


def frame(spark, rows, parts=3):
    extra = {c: F.lit("x") for c in ("at", "digest", "one", "depth", "g", "k1", "head")}
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(extra).repartition(parts)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_sql(spark, sf):
    found = queries.op13_trie(spark, sf)
    assert rows_of_spark(found) == rows_of_sql(connect(sf), queries.ORACLE_SQL["op13_trie"])


def test_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(tries.trie(spark.read.parquet(f"{SF}/conversations.parquet"))) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (1, None, None, "first"), (1, 2, "user", None), (1, 2, "user", "b"), (1, 2, "assistant", "z")]
    rows += [(c, t, "user", f"same {t}") for c in range(10, 40) for t in range(c % 4 + 1)]
    rows += [(c, t, "user", f"same {t}") for c in (-7, -5, -1) for t in range(9)]
    rows += [(60, t, "r" * (t % 3), "é" * t) for t in range(12)] + [(61, 0, "user", "x")] * 5
    # Role and text are apart: "ab" + "c" is another turn than "a" + "bc".
    rows += [(70, 0, "ab", "c"), (75, 0, "a", "bc"), (76, 0, "a", "bc"), (77, 5, "", "")]
    assert got(tries.trie(frame(spark, rows))) == brute(rows)
    assert got(tries.trie(frame(spark, rows), at_once=3)) == brute(rows)
    only_null = [(None, 0, "user", "a"), (None, 1, "user", "b")]
    assert got(tries.trie(frame(spark, only_null))) == brute(only_null)
    assert tries.trie(frame(spark, rows).limit(0)).count() == 0


def test_hot_groups(spark):
    """One conversation of very many turns, one common conversation, and one node with very many children."""
    rows = [(0, t, "user", f"t{t % 7}") for t in range(3000)]
    rows += [(c, t, "user", f"common {t}") for c in range(100, 700) for t in range(3)]
    rows += [(c, t, "user", f"own {c} {t}") for c in range(1000, 1400) for t in range(2)]
    found = got(tries.trie(frame(spark, rows, 8), at_once=500))
    # The plain version copies every prefix; the long one is left to a check of its chain.
    short = [r for r in rows if r[0] >= 100]
    wanted = brute(short)
    long = [r for r in found if r[0] == 0 and r[1] > 0]
    assert len(long) == len({r[1] for r in long}) and max(r[1] for r in long) == 3000
    assert all(r[3] == 1 and r[5] == 1 for r in long if r[1] > 8)
    below = {r[:2]: r[2:] for r in found if r[0] is not None and r[0] >= 100}
    same = [r for r in wanted if r[1] > 1]
    assert same and all(below[r[:2]] == r[2:] for r in same)


@pytest.mark.parametrize("at_once", [2, 50, 5000])
def test_list_ranking(spark, at_once):
    n = 700
    order = list(range(n))
    random.Random(5).shuffle(order)
    rows = [(v, order[k - 1] if k else None, order[k + 1] if k + 1 < n else None) for k, v in enumerate(order)]
    arcs = spark.createDataFrame(rows, "id long, prev long, next long").repartition(4)
    assert {r["id"]: r["at"] for r in tries.ranked(arcs, at_once).collect()} == {v: k for k, v in enumerate(order)}


def test_running(spark):
    """Sums and exclusive ors by key, where keys reach over several tasks and are null."""
    source = random.Random(3)
    rows = [(source.choice([None, 1, 2, 2, 2, 2, 3]), k, source.randrange(-50, 50), source.randrange(1 << 60)) for k in range(3000)]
    rows += [(9, 5000, 1, 1)] * 3000
    df = spark.createDataFrame(rows, "key long, o long, v long, x long").repartition(6)
    found = [tuple(r) for r in scans.running(df, ["o"], sums=["v"], xors=["x"], key="key").collect()]
    sums, wanted = {}, []
    for key, o, v, x in sorted(rows, key=lambda r: r[1]):
        total, mixed = sums.get(key, (0, 0))
        wanted.append((key, o, v, x, total, mixed))
        sums[key] = (total + v, mixed ^ x)
    assert sorted(found, key=str) == sorted(wanted, key=str)
    overall = sorted((r["o"], r["v_before"]) for r in scans.running(df.where("key = 2"), ["o"], sums=["v"], drop=["key"]).collect())
    assert [t for _, t in overall] == [w[4] for w in wanted if w[0] == 2]
    assert scans.running(df.limit(0), ["o"], sums=["v"]).count() == 0
