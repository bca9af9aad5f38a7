"""Reversed lexical search: an index of the items is broadcast and the documents stream through it.

The items are the queries. Their terms form an inverted index, term to items, which every task holds; a document's
term counts look up the items that have its terms, and all scores of a few documents at a time are summed as a small
table of documents by items. Each task keeps the best documents of each item in a heap of fixed size, and the heaps
of all tasks are merged. Neither documents nor pairs are shuffled.

The index is cut into blocks of items of a bounded size; each block is one pass over the documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import saved, small_batches, steps, utf8

#: Documents returned of each item.
BEST = 10
#: Bytes of terms and postings in one block of items, which is what is broadcast.
BLOCK_BYTES = 8 << 20
#: Bytes of a text that are split into terms at a time.
PIECE = 1 << 20
#: Cells of a table of documents by items, and contributions to it, that one step of a task holds.
CELLS, CONTRIBUTIONS = 1 << 20, 1 << 20
#: Groups in which heaps are merged first, so that no task gets the heaps of all others.
SHARDS = 64

_OTHER = rb"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_TERM, _BREAK = re.compile(rb"[^" + _OTHER + rb"]+"), re.compile(rb"[" + _OTHER + rb"]")


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in pieces: runs of digits, letters and everything beyond ASCII, A-Z in lower case."""
    at = 0
    while at < len(data):
        end = len(data)
        if at + PIECE < end and (stop := _BREAK.search(data, at + PIECE)):
            end = stop.start()
        # Only A-Z are changed by the lower case of bytes.
        yield _TERM.findall(data[at:end].lower())
        at = end


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, repeats): how often each term stands in the texts of an item; a row given twice counts once."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct().select("item_id", utf8().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in enumerate(batch.column("text")):
                counts: Counter[bytes] = Counter()
                for terms in terms_of(data.as_py()):
                    counts.update(terms)
                if counts:
                    ids = pa.repeat(batch.column("item_id")[k], len(counts))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                        names=["item_id", "term", "repeats"],
                    )

    counted = rows.mapInArrow(run, "item_id long, term binary, repeats long")
    return counted.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Every row: (doc_id, n, terms, counts), all its terms with repeats, and those of the vocabulary by number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in steps(batches):
            sizes, places, counts = [], [], []
            for data in batch.column("text"):
                n, found = 0, Counter()
                for terms in terms_of(data.as_py()):
                    n += len(terms)
                    found.update(terms)
                known = [(number[t], c) for t, c in found.items() if t in number]
                sizes.append(n)
                places.append([t for t, _ in known])
                counts.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


@dataclass
class Index:
    """Items by term: those of term t are items[first[t]:first[t + 1]], each with its share of the score."""

    ids: list[int | None]
    first: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    documents: int
    terms: int


@dataclass
class Heaps:
    """The best documents of every item so far, in order."""

    items: np.ndarray
    nulls: np.ndarray
    docs: np.ndarray
    scores: np.ndarray
    least: np.ndarray

    @classmethod
    def empty(cls, n: int) -> Heaps:
        none = np.zeros(0, np.int64)
        return cls(none, np.zeros(0, bool), none, none, np.ones(n, np.int64))

    def add(self, items: np.ndarray, nulls: np.ndarray, docs: np.ndarray, scores: np.ndarray, size: int) -> None:
        items, nulls = np.concatenate([self.items, items]), np.concatenate([self.nulls, nulls])
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        order = np.lexsort((docs, ~nulls, -scores, items))
        starts = np.searchsorted(items[order], np.arange(len(self.least)))
        rank = np.arange(len(order)) - starts[items[order]]
        kept = order[rank < size]
        self.items, self.nulls, self.docs, self.scores = items[kept], nulls[kept], docs[kept], scores[kept]
        # A full heap takes no score below its last; an equal one may still have a smaller id.
        full = rank == size - 1
        self.least[items[order][full]] = scores[order][full]


def _ranked(batch: pa.RecordBatch, index: Index, heaps: Heaps, size: int) -> None:
    """Score the documents of a batch, a bounded number at a time."""
    lists, counts = batch.column("terms"), batch.column("counts")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    terms, tf = lists.values.to_numpy(), counts.values.to_numpy()[counts.offsets[0].as_py() :]
    terms, bounds = terms[bounds[0] :], bounds - bounds[0]
    reach = (index.first[1:] - index.first[:-1])[terms[: bounds[-1]]]
    spent = np.concatenate([[0], np.cumsum(reach)])[bounds]
    lengths = batch.column("n").to_pylist()
    doc_ids, nulls = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    width, a = len(index.ids), 0
    while a < batch.num_rows:
        b = min(a + max(1, CELLS // width), int(np.searchsorted(spent, spent[a] + CONTRIBUTIONS, side="right")) - 1)
        b = min(max(b, a + 1), batch.num_rows)
        # Python's integers: 75 * n * N may exceed 64 bits where the quotient does not.
        m = np.array([25 + (75 * n * index.documents) // max(index.terms, 1) for n in lengths[a:b]], np.int64)
        part = slice(bounds[a], bounds[b])
        doc = np.repeat(np.arange(b - a), np.diff(bounds[a : b + 1]))
        share = (1_000_000_000 * tf[part]) // (1000 * tf[part] + 8 * m[doc])
        n = reach[part]
        entry = np.repeat(np.arange(len(n)), n)
        posting = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + index.first[terms[part]][entry]
        scores = np.zeros((b - a) * width, np.int64)
        np.add.at(scores, doc[entry] * width + index.items[posting], share[entry] * index.weights[posting])
        scores = scores.reshape(b - a, width)
        row, item = np.nonzero(scores >= heaps.least)
        if len(row):
            heaps.add(item, nulls[a:b][row], doc_ids[a:b][row], scores[row, item], size)
        a = b


def _blocks(terms: DataFrame) -> int:
    """How many blocks of items hold about ``BLOCK_BYTES`` each."""
    total = terms.agg(F.sum(F.length("term") + 24)).first()[0] or 0
    return -(-total // BLOCK_BYTES)


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of each item, equal scores by ascending doc_id.

    The score of a document sums, over an item's terms with repeats, the term's weight times its saturated count. A
    null or wordless text has no terms: such a document does not count, such an item has no rows. Every row of
    ``docs`` is a document, also a repeated one; a null doc_id is smaller than any. Rows of one item_id are one item
    with all their texts, a row given twice counts once, and null is an id like others. Empty tables give no rows;
    other columns are ignored. An item's distinct terms must fit into a block's memory.
    """
    spark = docs.sparkSession
    small_batches(spark)
    terms = saved(item_terms(items), "item-terms")
    blocks = _blocks(terms)
    heaps = None
    for block in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow() if blocks > 1 else terms.toArrow()
        if part.num_rows:
            found = _search_block(docs, part, best)
            heaps = found if heaps is None else heaps.unionByName(found)
    if heaps is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for keys in (["item_id", "shard"], ["item_id"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        heaps = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return heaps.select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, part: pa.Table, best: int) -> DataFrame:
    """(item_id, doc_id, score, shard): the heaps of all tasks."""
    spark = docs.sparkSession
    names = part.column("term").to_pylist()
    vocabulary = {t: k for k, t in enumerate(sorted(set(names)))}
    counted = saved(term_counts(docs, vocabulary), "term-counts")
    documents, total = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        holding[row["term"]] = row["df"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)

    ids = sorted(set(part.column("item_id").to_pylist()), key=lambda i: (i is not None, i or 0))
    place = {i: k for k, i in enumerate(ids)}
    term = np.array([vocabulary[t] for t in names])
    item = np.array([place[i] for i in part.column("item_id").to_pylist()])
    order = np.argsort(term, kind="stable")
    first = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
    repeats = part.column("repeats").to_numpy()
    index = spark.sparkContext.broadcast(Index(ids, first, item[order], (repeats * weight[term])[order], documents, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = index.value
        heaps = Heaps.empty(len(held.ids))
        for batch in batches:
            if batch.num_rows:
                _ranked(batch, held, heaps, best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([held.ids[k] for k in heaps.items], pa.int64()),
                pa.array(heaps.docs, pa.int64(), mask=heaps.nulls),
                pa.array(heaps.scores, pa.int64()),
            ],
            names=["item_id", "doc_id", "score"],
        )

    heaps = counted.mapInArrow(run, "item_id long, doc_id long, score long")
    return heaps.withColumn("shard", F.spark_partition_id() % SHARDS)


#: The same in SQL.
SQL = r"""
WITH wanted AS (
    SELECT item_id, term, count(*) AS repeats
    FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
), numbered AS (
    SELECT row_number() OVER () AS place, doc_id, text FROM documents
), occurring AS (
    SELECT place, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM numbered
), counted AS (
    SELECT place, term, count(*) AS tf FROM occurring GROUP BY ALL
), sized AS (
    SELECT place, sum(tf)::BIGINT AS n FROM counted GROUP BY place
), corpus AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS terms FROM sized
), weights AS (
    SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM counted WHERE term IN (SELECT term FROM wanted) GROUP BY term), corpus
), scored AS (
    SELECT item_id, place, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // terms))))::BIGINT AS score
    FROM counted JOIN wanted USING (term) JOIN weights USING (term) JOIN sized USING (place), corpus
    GROUP BY item_id, place
), ranked AS (
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST))::INTEGER AS rank, doc_id, score
    FROM scored JOIN numbered USING (place) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
