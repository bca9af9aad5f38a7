"""Fingerprints against a slow reading of their definition, and neighbours in any partitioning."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import fingerprints as fp
from millrace.llm import queries


def occurrence_numbers(text, k):
    seen, out = {}, []
    for i in range(max(len(text) - k + 1, min(len(text), 1))):
        part = text[i : i + k]
        out.append((part, seen.get(part, 0)))
        seen[part] = seen.get(part, 0) + 1
    return out


def test_numbered_kmers():
    rng = random.Random(5)
    for n in (0, 1, 3, 6, 40, 500):
        text = "".join(rng.choice("abé") for _ in range(n))
        hashes = fp._numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32), 3).tolist()
        numbered = occurrence_numbers(text, 3)
        assert len(hashes) == len(numbered)
        assert len(set(zip(hashes, numbered))) == len(set(hashes)) == len(set(numbered))


def slow(text, k=fp.K, buckets=fp.BUCKETS, size=fp.TUPLE):
    hashes = fp._numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32), k).tolist()
    out = []
    for b in range(buckets):
        smallest = sorted((h, i) for i, h in enumerate(hashes) if h % buckets == b)[:size]
        value = np.uint64(0)
        for _, h in sorted((i, h) for h, i in smallest):
            with np.errstate(over="ignore"):
                value = fp.mix(np.array([value * np.uint64(fp.BASE) + np.uint64(h)]))[0]
        out.append(int(value >> np.uint64(32)) | 1 if smallest else 0)
    return out


def test_selection():
    rng = random.Random(6)
    for n in (0, 1, 5, 30, 400, 6000):
        text = "".join(rng.choice("abcdefgh ") for _ in range(n))
        assert fp.fingerprint(text).tolist() == slow(text)


def test_order_counts():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(600)]
    text, turned = " ".join(words), " ".join(words[300:] + words[:300])
    near = " ".join(words[:50] + ["new"] + words[51:])
    own = fp.fingerprint(text)
    assert fp.likeness(own, own) == 1
    assert fp.likeness(own, fp.fingerprint(near)) > 0.9
    assert fp.likeness(own, fp.fingerprint(turned)) < fp.likeness(own, fp.fingerprint(near)) - 0.2
    assert fp.likeness(own, fp.fingerprint(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(600)))) < 0.1


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        a, b, c = (fp.fingerprint(t) for t in (text, changed, following))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.astype(">u4").tobytes().hex(),
                    b.astype(">u4").tobytes().hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("rows", [
    [], [(1, "abc")], [(1, None), (2, "")], [(k, f"text {k} " * (k % 7)) for k in range(50)],
    [(3, "same text"), (3, "same text"), (None, "x😀y"), (4, "long " * 30000)],
])
def test_neighbours(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kind", "2 as part").repartition(5)
    assert got(fp.compare_with_next(docs)) == expected(rows)
    plain = fp.fingerprints(docs).collect()
    assert sorted(r["n_chars"] for r in plain) == sorted(len(t or "") for _, t in rows)


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op7_fingerprints(spark, sf)) == expected(rows)


def test_many_copies_of_one_row(spark):
    """Copies of one row spread over several ranges and give the same result each."""
    rows = [(5, "the same text of a row")] * 3000 + [(6, "another text")]
    found = fp.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    same = [r for r in found if r["doc_id"] == 5]
    assert len(same) == 3000 and len({r["fingerprint"] for r in same}) == 1 and len({r["edited_sha256"] for r in same}) <= 2
    assert sum(r["near_next"] == 1.0 for r in same) == 2999
