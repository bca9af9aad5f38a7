"""Pieces put together again are the documents, with the ids of the whole tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, queries

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_of_any_white_space():
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\n\n", "\t", " ", " ", "don't", "it's", "the", "Ä", "😀", "1984", "!!", ".", "'s", "<|endoftext|>", "\r\n"]
    encode = packing.tokenizer("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
    for _ in range(3000):
        text = "".join(rng.choice(parts[:-2] if rng.random() < 0.9 else parts) for _ in range(rng.randrange(12)))
        assert encode.ids(text).tolist() == expected(text)[:-1], repr(text)


def test_pieces(spark):
    rows = [(1, "a b c " * 2000), (2, None), (3, ""), (3, ""), (None, "x y"), (4, "hello world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "2 as ids")
    got = packing.pack(docs.repartition(2)).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    by_doc = {}
    for r in got:
        assert r["length"] == len(r["ids"]) and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["offset"] == 0
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in dict(rows).items():
        ids = []
        for r in sorted(by_doc[doc_id], key=lambda r: (r["start"], r["sequence_id"])):
            ids += r["ids"]
        assert ids == expected(text) * (2 if doc_id == 3 else 1)
        assert {r["doc_tokens"] for r in by_doc[doc_id]} == {len(expected(text))}
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, max_length=100)


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_packing(spark, sf).collect()
    ends = {k: 0 for k in texts}
    ids = {k: np.array(expected(t), "<u4") for k, t in texts.items()}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == ends[r["doc_id"]]
        ends[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : ends[r["doc_id"]]].tobytes())
    assert ends == {k: len(v) for k, v in ids.items()}


def test_buckets_and_batches(spark, tmp_path):
    """Every piece is in one bucket; batches are full, of one length, and together the whole bucket."""
    docs = spark.createDataFrame([(k, "word " * (k * 7 % 300)) for k in range(120)], "doc_id long, text string").repartition(3)
    pieces = packing.pack(docs, max_length=64)
    path = str(tmp_path / "buckets")
    packing.write_buckets(pieces, path)
    rows = spark.read.schema(packing.PIECES).parquet(path)
    assert sorted(map(str, rows.collect())) == sorted(map(str, pieces.select(*rows.columns).collect()))
    for length in (64, 8, 1):
        wanted = {(r["doc_id"], r["start"]) for r in rows.where(f"length = {length}").collect()}
        drawn = packing.batches(spark, path, length, 10, seed=3)
        found = drawn.collect()
        assert {(r["doc_id"], r["start"]) for r in found} == wanted and len(found) == len(wanted)
        assert all(len(r["ids"]) == length == r["length"] for r in found)
        sizes = {}
        for r in found:
            sizes.setdefault(r["batch"], set()).add(r["place"])
        assert all(sizes[b] == set(range(10)) for b in range(len(sizes) - 1)) and len(sizes) == -(-len(wanted) // 10)
    again = [(r["batch"], r["place"], r["doc_id"], r["start"]) for r in packing.batches(spark, path, 64, 10, seed=3).collect()]
    other = [(r["batch"], r["place"], r["doc_id"], r["start"]) for r in packing.batches(spark, path, 64, 10, seed=4).collect()]
    first = [(r["batch"], r["place"], r["doc_id"], r["start"]) for r in packing.batches(spark, path, 64, 10, seed=3).collect()]
    assert sorted(again) == sorted(first) != sorted(other)
    assert packing.batches(spark, path, 32768, 10).count() == 0
