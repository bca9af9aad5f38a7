"""Repeated lines against SQL and a plain version, and the pipeline stage by stage."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, rows_of_spark, rows_of_sql
from millrace.llm import common, lines, queries, secrets
from test_decontam import brute as contaminated
from test_ngram_join import brute as joined
from test_packing import expected as tokens

SF = "/root/testdata/sf0.001"


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        kept, removed, at = [], [], 0
        units = (text or "").split("\n")
        for line in units:
            unit = re.sub(r"[ \t\r\f]+", " ", line.lower()).strip(" ")
            if unit and unit in seen:
                removed.append((at, at + len(line)))
            else:
                kept.append(line)
            seen.add(unit)
            at += len(line) + 1
        spans = ",".join(f"{a}:{b}" for a, b in removed)
        left = "\n".join(kept)
        out[doc_id] = (doc_id, len(text or ""), len(left), sum(b - a for a, b in removed), len(units), len(removed), spans, hashlib.sha256(left.encode()).hexdigest())
    return sorted((out[d] for d, _ in rows), key=str)


def test_sql(spark):
    assert rows_of_spark(queries.op5_lines(spark, SF)) == rows_of_sql(connect(SF), queries.ORACLE_SQL["op5_lines"])


def test_lines(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(k, "\n".join([f"own {k}", long.upper() if k % 2 else long.replace(" ", "\t "), "short line", long + " é" * (k % 3)])) for k in range(60)]
    rows += [(100, None), (101, ""), (102, long), (102, long), (None, f"x\n{long}"), (103, (long + "\n") * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("check", "place", "digest", "places")}).repartition(3)
    assert got(lines.digests(lines.deduplicated(docs))) == brute(rows)
    assert lines.deduplicated(docs.limit(0)).count() == 0


def test_every_line(spark):
    """Short lines and lines without blanks are units too; empty lines are none."""
    rows = [(1, "short line\n\n汉字" * 2), (2, "Short  line\n\n \n汉字\nown"), (3, None), (4, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = {r["doc_id"]: r["kept"] for r in lines.deduplicated(docs).collect()}
    assert out == {1: "short line\n\n汉字short line\n\n汉字", 2: "\n \nown", 3: "", 4: ""}


def test_longer_lines_only(spark):
    rows = [(1, "one two three\nfour five"), (2, "one two three\nfour five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in lines.deduplicated(docs, least_words=3).collect()} == {1: rows[0][1], 2: "four five"}


def test_common_line_can_be_split(spark):
    """Both sides of the join on digests are read straight from exchanges."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lines.repeated_lines(spark.createDataFrame([(1, "a\na")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sides = plan.split("SortMergeJoin")[1].split("Sort [digest")[1:]
    assert len(sides) >= 2 and all("Exchange hashpartitioning(digest" in side.split("\n")[1] for side in sides[:2])
    assert ", zero" in sides[0].split("\n")[0] and ", zero" in sides[1].split("\n")[0]


def test_redaction(spark):
    rows = [(1, "a token=abcdefghij b"), (2, "AKIA" + "A1" * 10), (3, None), (4, "clean"), (5, "secret=" + "ab" * 20 + " x " + "cd" * 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.redact(docs).collect()}
    assert out == {1: ("a [SECRET] b", 12), 2: ("[SECRET]", 8), 3: (None, None), 4: ("clean", 5), 5: ("[SECRET] x [SECRET]", 19)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "decontamination", "secrets", "packing"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    keep = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert keep.schema == docs.schema
    assert {r["doc_id"] for r in keep.collect()} == {d for d, n, c in joined(rows) if n == 0 or d == c}
    keep = corpus_pipeline.drop_benchmark(spark, docs, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert keep.schema == docs.schema
    assert {r["doc_id"] for r in keep.collect()} == {r[0] for r in contaminated(rows, items) if not r[-1]}
    calm = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert calm.schema == docs.schema and 0 < calm.count() <= docs.count()


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    assert packed and len({r["sequence_id"] for r in packed}) == len(packed)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    by_doc = {}
    for r in sorted(packed, key=lambda r: r["start"]):
        by_doc.setdefault(r["doc_id"], []).extend(r["ids"])
    clean = [d for d in by_doc if not re.search(r"(?i)password|token|secret|api_?key|AKIA|[0-9a-f]{32}", texts[d] or "")]
    assert clean and all(by_doc[d] == tokens(texts[d]) for d in clean)


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_odd_rows(spark, stage, tmp_path):
    rows = [(None, None, None), (1, "", "x"), (1, "", "x"), (2, "a b c d e f " * 30, None), (2, "a b c d e f " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(os.path.join(tmp_path, "benchmark.parquet"))
    function = corpus_pipeline.STAGES[stage][1]
    out = function(spark, docs, str(tmp_path))
    assert out.count() >= 4 - (stage == 1)
    assert stage == 4 or out.columns == docs.columns
    assert function(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_workers_give_memory_back(spark):
    """What a task has freed does not stay with its worker, by whichever allocator it was taken."""

    def private() -> float:
        with open("/proc/self/smaps_rollup") as lines:
            return sum(int(x.split()[1]) for x in lines if x.startswith(("Pss_Anon", "Pss_Shmem"))) / 1024

    def run(batches):
        for _ in batches:
            # Small pieces with some between them that stay: the allocator keeps what lies below those.
            pieces = [bytes(60_000) for _ in range(2000)]
            kept.append(pieces[-1])
            yield len(pieces)

    kept, before = [], private()
    assert list(common.released(run)([1, 2])) == [2000, 2000]
    assert private() - before < 40


def test_toxicity_stage_bounds_its_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    corpus_pipeline.drop_toxic(spark, docs, SF)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(common.BATCH_BYTES)
