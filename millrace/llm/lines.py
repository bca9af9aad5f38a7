"""Removal of repeated lines: every normalised line is kept where it stands first, by document and place.

Digests of lines are grouped over all documents, with partial results in each task, so that a line which very many
documents share is not gathered anywhere. Only digests that occur again meet the lines once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.plans import zero_of
from millrace.llm.common import saved, small_batches

#: Words that a line must have at least to be removed; one is every line that is not empty.
LEAST_WORDS = 1


def normalised(line: Column) -> Column:
    """Lower-case, with single blanks."""
    return F.trim(F.regexp_replace(F.lower(line), "[ \t\r\f]+", " "))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("check", F.xxhash64("text"))


def repeated_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, check, place) of every line that stands earlier: in a smaller doc_id, or before in the same text."""
    units = _rows(docs).select("doc_id", "check", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    line = normalised(F.col("line"))
    units = units.where((F.size(F.split(line, " ")) >= least_words) & (line != "")).select(
        "doc_id", "check", "place", F.unhex(F.md5(line)).alias("digest")
    )
    units = saved(units, "lines")
    first = (
        units.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "check", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    # A further key that is always zero, but computed, gives the side of the firsts an exchange of its own, so that
    # adaptive execution can split a line that stands everywhere.
    first = first.withColumn("zero", zero_of("digest"))
    # The same row twice is one document: neither of the two is a repetition of the other.
    again = units.withColumn("zero", zero_of("place")).join(first, ["digest", "zero"]).where(~F.struct("doc_id", "check", "place").eqNullSafe(F.col("first")))
    return again.select("doc_id", "check", "place")


def deduplicated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every row: (doc_id, text, kept, n_lines, starts, ends), the text, its kept lines, and what went.

    ``starts`` and ``ends`` are code points of the removed lines in the original text. A null text is empty and has
    one empty line; a null id is smaller than any. Repeated rows are one document with one result twice; different
    texts of one id stand in the order of a hash. An empty table gives no rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    gone = repeated_lines(docs, least_words).groupBy("doc_id", "check").agg(F.collect_set("place").alias("places"))
    rows = _rows(docs)
    joined = rows.join(
        gone.withColumnsRenamed({"doc_id": "_doc", "check": "_check"}),
        rows["doc_id"].eqNullSafe(F.col("_doc")) & (rows["check"] == F.col("_check")),
        "left",
    ).select("doc_id", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                out = []
                for r in batch.slice(first, 500).to_pylist():
                    lines, places = r["text"].split("\n"), set(r["places"] or ())
                    at, starts, ends = 0, [], []
                    for k, line in enumerate(lines):
                        if k in places:
                            starts.append(at)
                            ends.append(at + len(line))
                        at += len(line) + 1
                    kept = "\n".join(line for k, line in enumerate(lines) if k not in places)
                    out.append((r["doc_id"], r["text"], kept, len(lines), starts, ends))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["doc_id", "text", "kept", "n_lines", "starts", "ends"],
                )

    return joined.mapInArrow(run, "doc_id long, text string, kept string, n_lines long, starts array<long>, ends array<long>")


def digests(rows: DataFrame) -> DataFrame:
    """Lengths before and after, the removed spans as start:end, and the digest of what is kept.

    ``n_chars`` and ``n_removed`` count the code points that are kept and those of the removed lines.
    """
    lengths = F.zip_with("starts", "ends", lambda a, b: b - a)
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars_before"),
        F.length("kept").cast("long").alias("n_chars"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_removed"),
        "n_lines",
        F.size("starts").cast("long").alias("n_lines_removed"),
        F.array_join(F.zip_with("starts", "ends", lambda a, b: F.concat_ws(":", a, b)), ",").alias("removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: The same in SQL.
SQL = """
WITH units AS (
    SELECT doc_id, place, line, trim(regexp_replace(lower(line), '[ \t\r\f]+', ' ', 'g')) AS unit
    FROM (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
    )
), placed AS (
    SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS from_,
        unit <> '' AND row_number() OVER (PARTITION BY unit ORDER BY doc_id, place) > 1 AS gone
    FROM units
)
SELECT doc_id, (sum(length(line) + 1) - 1)::BIGINT AS n_chars_before,
    greatest(coalesce(sum(length(line) + 1) FILTER (NOT gone), 0) - 1, 0)::BIGINT AS n_chars,
    coalesce(sum(length(line)) FILTER (gone), 0)::BIGINT AS n_removed,
    count(*) AS n_lines, count(*) FILTER (gone) AS n_lines_removed,
    coalesce(string_agg(from_ || ':' || (from_ + length(line)), ',' ORDER BY place) FILTER (gone), '') AS removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM placed GROUP BY doc_id
"""
