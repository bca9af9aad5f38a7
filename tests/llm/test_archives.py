"""Archives against Python's zipfile, and pages that come back as they were."""

import base64
import hashlib
import io
import random
import zipfile

import pytest

from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import archives, queries


def written(members, **options):
    out = io.BytesIO()
    writer = archives.ZipWriter(out, **options)
    for name, data in members.items():
        writer.begin(name)
        for k in range(0, len(data), 1000):
            writer.data(data[k : k + 1000])
        writer.end()
    writer.close()
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_zip(zip64):
    members = {"archive/data-00000.warc": b"x" * 5000, "indexes/index.cdxj": b"{}\n", "é": b""}
    data = written(members, zip64=zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == members
    reader = archives.ZipReader(io.BytesIO(data), len(data))
    assert {n: reader.read(*reader.range_of(n)) for n in reader.members} == members


def test_foreign_archives():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"one")
        z.writestr(zipfile.ZipInfo("b"), b"two" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it, and more than twenty-two bytes behind it"
    data = out.getvalue()
    reader = archives.ZipReader(io.BytesIO(data), len(data))
    assert reader.read(*reader.range_of("a")) == b"one"
    with pytest.raises(ValueError):
        reader.range_of("b")
    for broken in (b"", b"no archive", data[:-60]):
        with pytest.raises(ValueError):
            archives.ZipReader(io.BytesIO(broken), len(broken))
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    assert archives.ZipReader(empty, len(empty.getvalue())).members == {}


def expected(rows, least=0):
    largest = {}
    for page_id, _, html in rows:
        largest.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, _, html in rows:
        data, ids = (html or "").encode(), [x for x in largest[html or ""] if x is not None]
        target = max(ids, default=None)
        revisit = target is not None and len(data) >= least and page_id != target
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in archives.digests(df).collect()], key=str)


def test_round_trip(spark):
    rng = random.Random(8)
    texts = [None, "", "<p>a</p>", "ü\r\n\r\nWARC/1.1\r\n", "x" * 100_000]
    rows = [(i, rng.choice([None, "http://a/?q=ü\n\"", ""]), rng.choice([*texts, f"own {i}"])) for i in range(200)] + [(None, "u", ""), (None, "u", "lonely"), (7, "u", "twice"), (7, "v", "twice")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as payload", "2 as refers_to").repartition(4)
    for least in (0, 5):
        back = archives.round_trip(pages, least)
        assert got(back) == expected(rows, least)
    urls = {(r["page_id"], r["url"]) for r in back.collect()}
    assert urls == {(p, u) for p, u, _ in rows}
    payloads = {r["page_id"]: r["payload"] for r in back.where("record_type = 'response'").collect()}
    assert all(bytes(v) == (dict((p, h) for p, _, h in rows)[p] or "").encode() for p, v in payloads.items() if p is not None)
    assert archives.round_trip(pages.limit(0)).count() == 0


def test_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(queries.op6_warc(spark, sf)) == expected(rows)


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows_of_spark(queries.op6_warc(spark, sf)) == rows_of_sql(connect(sf), queries.ORACLE_SQL["op6_warc"])
