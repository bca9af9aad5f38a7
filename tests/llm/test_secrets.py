"""Secret scan against a plain scan in Python, and the cases every operator must define."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, secrets

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8],
        "access": [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16],
        "hex": [m.span() for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 32],
    }
    spans = sorted((s, i, k, e) for i, k in enumerate(found) for s, e in found[k])
    return [len(found[k]) for k in found], [f"{k}:{s}:{e}" for s, i, k, e in spans]


def check(rows, got):
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text in rows:
        counts, spans = brute(text)
        r = by_id[doc_id]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts, text
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(",")) or not spans
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == spans


def test_base_patterns(spark):
    rng = random.Random(1)
    pieces = ["token", "Token=", "api_key: ", 'APIKEY="', "secret=secret=abcdefghij", "'", "é", "😀", " ", "=", ":", "deadbeef" * 5,
              "AKIA", "ABCDEFGH12345", "password : x", "passwd=longenough-1", "\n", "x" * 9, "0123456789abcdef" * 2]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "token=abcdefgh " * 3000)]
    got = secrets.digests(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))).collect()
    check(rows, got)


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op1_secrets(spark, sf).collect()
    assert len(got) == len(rows)
    check(rows, got)


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["internationalization" * 2, "counterrevolutionaries", "antidisestablishmentarianism", "the_quick_brown_fox_jumps"]
    rows = [(i, f"a {words[i % 4]} b") for i in range(200)]
    rows += [(500 + i, "x " + "".join(rng.choice(letters) for _ in range(64)) + " y") for i in range(20)]
    rows.append((900, "x " + "ab" * 30))
    got = {r["doc_id"]: r["spans"] for r in secrets.digests(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert sum(got[500 + i] == "random:2:66" for i in range(20)) >= 17
    assert {got[i] for i in range(200)} == {""} and got[900] == "hex:2:62"


@pytest.mark.parametrize("rows", [[], [(None, None)], [(7, "token=abcdefgh1"), (7, "token=abcdefgh1")]])
def test_empty_null_repeated(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as base_spans", "2 as spans", "3 as n_hex")
    got = secrets.digests(secrets.scan(docs)).collect()
    assert len(got) == len(rows)
    assert all(r["n_assign"] == (r["doc_id"] == 7) for r in got)
    assert secrets.redact(docs).columns == docs.columns


def test_keys_in_paths(spark):
    """A key is found whatever signs stand around it: runs with signs of two alphabets are tested in parts."""
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, at = [], {}
    for k in range(60):
        key = "".join(rng.choice(letters) for _ in range(48))
        before, after = [("a ", " b"), ("/api_v1/", " b"), ("/my-app/", "/x_y"), ("see a+b_c/", "")][k % 4]
        rows.append((k, before + key + after))
        at[k] = (len(before), len(before) + 48)
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [any(s["start"] <= at[k][0] and s["end"] >= at[k][1] for s in found[k]) for k in range(60)]
    assert all(sum(hit[i::4]) >= 13 for i in range(4))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(rows[k][1][at[k][0] : at[k][1]] not in clean[k] for k in range(60) if hit[k])


def masked(text, spans, mark="[SECRET]"):
    """A plain version: marks in place of spans, one for those that overlap."""
    out, at = "", 0
    for k, (start, end) in enumerate(sorted(spans)):
        if start >= at:
            out += text[at:start] + mark
        at = max(at, end)
    return out + text[at:]


def test_redaction_of_any_spans(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        text = "".join(rng.choice("abé😀汉 ") for _ in range(rng.randrange(1, 700)))
        spans = set()
        for _ in range(rng.choice([1, 2, 5, 300, 600])):
            start = rng.randrange(len(text))
            spans.add((start, min(len(text), start + rng.randrange(1, 6))))
        rows.append((text, sorted(spans)))
    frame = spark.createDataFrame([(t, [(a, 3, b) for a, b in s]) for t, s in rows], "text string, spans array<struct<start: int, kind: int, end: int>>")
    found = frame.select("text", secrets._masked(F.col("text"), F.sort_array("spans"), "[SECRET]").alias("clean")).collect()
    wanted = {t: masked(t, s) for t, s in rows}
    assert all(r["clean"] == wanted[r["text"]] for r in found)


def test_redaction_keeps_other_columns(spark):
    docs = spark.createDataFrame(
        [(1, "token=abcdefgh1 x", "s", "b", 9, "t"), (2, None, None, None, None, None), (3, "AKIA" + "B2" * 9, "", "c", 1, "u")],
        "doc_id long, text string, spans string, base_spans string, n_chars int, _secret_text string",
    )
    clean = sorted((tuple(r) for r in secrets.redact(docs).collect()))
    assert clean == [(1, "[SECRET] x", "s", "b", 10, "t"), (2, None, None, None, None, None), (3, "[SECRET]", "", "c", 8, "u")]


def test_many_spans_in_one_text(spark):
    text = "token=abcdefgh1 " * 40_000
    clean = secrets.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["text"]
    assert clean == "[SECRET] " * 40_000
