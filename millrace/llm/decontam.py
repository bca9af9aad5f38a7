"""Which documents repeat passages of a benchmark: a positional inverted index, searched from the rarest terms.

The index is sharded by documents: a segment holds the postings (sorted positions of every term) of about two
megabytes of text and is one row of a table. A search sends its phrases to all segments. In each, the list of a
phrase's rarest term, moved by the term's offset, is intersected with the lists of the others in order of their
rarity; what is left starts an exact match. Nothing is shuffled and no term is hot, since a segment bounds its
lists. Phrases go out in blocks of bounded size, so a benchmark of any size can be searched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    U64, byte_array, lower_ascii, prefix_hash, released, run_hash, runs_of, saved, small_batches, whole_row, steps, word_table, words_of,
)

# Fixed value: bytes that no word has, beside capitals, which are lowered first.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WINDOW = 13
#: Text of a benchmark that is sent to the segments at once.
BLOCK_BYTES = 16 << 20

SEGMENT = "segment long, doc_ids array<long>, firsts binary, terms binary, lists binary, positions binary"
HITS = "segment long, place int, doc_id long, n_words long, starts array<long>, ends array<long>, items array<string>"
_TABLE = word_table(SEPARATORS)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word and the place of each text's first word."""
    data = lower_ascii(data)
    starts, ends, firsts = words_of(data, offsets, _TABLE)
    return run_hash(prefix_hash(data), starts, ends), firsts


def build_index(docs: DataFrame) -> DataFrame:
    """Segments of a positional index over every word of every row; a null or empty text has no words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in steps(batches):
            terms, firsts = terms_of(*byte_array(batch.column("text")))
            order = np.argsort(terms, kind="stable")
            ordered = terms[order]
            lists = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(terms) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    *[
                        pa.array([part.tobytes()], pa.binary())
                        for part in (firsts.astype(np.int64), ordered[lists], lists.astype(np.uint32), order.astype(np.uint32))
                    ],
                ],
                names=["segment", "doc_ids", "firsts", "terms", "lists", "positions"],
            )
            shard += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(released(build), SEGMENT)


class Segment:
    """A row of the index."""

    def __init__(self, row: dict):
        self.firsts = np.frombuffer(row["firsts"], np.int64)
        self.terms = np.frombuffer(row["terms"], U64)
        self.positions = np.frombuffer(row["positions"], np.uint32).astype(np.int64)
        self.lists = np.append(np.frombuffer(row["lists"], np.uint32).astype(np.int64), len(self.positions))
        self.sizes = np.diff(self.lists)
        # Ordered by term and position: membership in any list is one binary search.
        self.keys = (np.repeat(np.arange(len(self.terms)), self.sizes) << 32) | self.positions

    def find_terms(self, hashes: np.ndarray) -> np.ndarray:
        """The list number of each term, or -1."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        keys = (lists << 32) | positions
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return (self.keys[at] == keys) & (positions >= 0)

    def phrases(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the phrases (rows of ``hashes``, as many columns as ``lengths`` says) and where they start."""
        used = np.arange(hashes.shape[1]) < lengths[:, None]
        lists = np.where(used, self.find_terms(hashes), -2)
        chosen = np.flatnonzero((lists != -1).all(axis=1) & (lengths > 0))
        none = np.zeros(0, np.int64)
        if not len(chosen):
            return none, none
        lists = lists[chosen]
        rarity = np.where(lists >= 0, self.sizes[np.maximum(lists, 0)], np.iinfo(np.int64).max)
        ranked = np.argsort(rarity, axis=1, kind="stable")
        rarest = ranked[:, 0]
        anchor = lists[np.arange(len(chosen)), rarest]
        n = self.sizes[anchor]
        row = np.repeat(np.arange(len(chosen)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.positions[self.lists[anchor][row] + within] - rarest[row]
        for turn in range(1, hashes.shape[1]):
            offset = ranked[row, turn]
            wanted = lists[row, offset]
            keep = (wanted < 0) | self.has(np.maximum(wanted, 0), start + offset)
            row, start = row[keep], start[keep]
            if not len(row):
                return none, none
        last = start + lengths[chosen][row] - 1
        keep = (start >= 0) & (self.document(start) == self.document(last))
        return chosen[row[keep]], start[keep]

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, position, side="right") - 1

    def near(self, hashes: np.ndarray, width: int) -> list[tuple[int, int]]:
        """Shortest spans (start, end) of at most ``width`` words of one document that hold all the terms."""
        lists = self.find_terms(np.unique(hashes))
        if not len(lists) or (lists < 0).any():
            return []
        own = [self.positions[self.lists[k] : self.lists[k + 1]] for k in lists]
        anchors = min(own, key=len)
        positions, terms = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
        # Only what stands near an occurrence of the rarest term can be part of a span.
        after = np.minimum(np.searchsorted(anchors, positions), len(anchors) - 1)
        before = np.maximum(after - 1, 0)
        close = (np.abs(anchors[after] - positions) < width) | (np.abs(anchors[before] - positions) < width)
        order = np.flatnonzero(close)[np.argsort(positions[close], kind="stable")]
        latest: dict[int, int] = {}
        spans: dict[int, int] = {}  # by start, the shortest
        for position, term in zip(positions[order].tolist(), terms[order].tolist(), strict=True):
            latest[term] = position
            first = min(latest.values())
            if len(latest) == len(own) and position - first < width:
                spans.setdefault(first, position + 1)
        return [(a, b) for a, b in spans.items() if len(set(self.document(np.array([a, b - 1])))) == 1]


def windows_of(texts: list[str | None], names: list[str | None], window: int = WINDOW):
    """Distinct windows of the texts as rows of term hashes, their lengths, and the names of the texts of each.

    A text without a name has windows that name nobody.
    """
    rows: dict[bytes, tuple[np.ndarray, set[str]]] = {}
    for text, name in zip(texts, names, strict=True):
        terms, _ = terms_of(*byte_array(pa.array([text], pa.string())))
        for k in range(max(len(terms) - window + 1, min(len(terms), 1))):
            part = terms[k : k + window]
            rows.setdefault(part.tobytes(), (part, set()))[1].update([] if name is None else [name])
    hashes = np.zeros((len(rows), window), U64)
    lengths = np.zeros(len(rows), np.int64)
    for k, (part, _) in enumerate(rows.values()):
        hashes[k, : len(part)], lengths[k] = part, len(part)
    return hashes, lengths, [sorted(owners) for _, owners in rows.values()]


def search(index: DataFrame, hashes: np.ndarray, lengths: np.ndarray, owners: list[list[str]]) -> DataFrame:
    """For every document of the index: its number of words, the spans of words hit, and the owners of the phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                segment, doc_ids = Segment(row), row["doc_ids"]
                phrase, start = segment.phrases(hashes, lengths)
                place = segment.document(start)
                edges = np.zeros(len(segment.positions) + 1, np.int64)
                np.add.at(edges, start, 1)
                np.add.at(edges, start + lengths[phrase], -1)
                covered = np.cumsum(edges[:-1]) > 0
                starts, ends, items = ([[] for _ in doc_ids] for _ in range(3))
                for k in np.unique(place):
                    first, last = segment.firsts[k], segment.firsts[k + 1]
                    a, b = runs_of(covered[first:last])
                    starts[k], ends[k] = a.tolist(), b.tolist()
                    items[k] = sorted({name for p in np.unique(phrase[place == k]) for name in owners[p]})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * len(doc_ids), pa.int64()),
                        pa.array(range(len(doc_ids)), pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(np.diff(segment.firsts)),
                        pa.array(starts, pa.list_(pa.int64())),
                        pa.array(ends, pa.list_(pa.int64())),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["segment", "place", "doc_id", "n_words", "starts", "ends", "items"],
                )

    return index.mapInArrow(released(run), HITS)


def phrase_matches(index: DataFrame, phrases: dict[str, str], near: int | None = None) -> DataFrame:
    """(doc_id, phrase, start, end) in words: exact matches of each phrase, or spans of ``near`` words with all its terms."""
    parts = {name: terms_of(*byte_array(pa.array([text], pa.string())))[0] for name, text in phrases.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                segment, out = Segment(row), []
                for name, terms in parts.items():
                    if near is not None:
                        spans = segment.near(terms, near)
                    elif len(terms):
                        _, start = segment.phrases(terms[None, :], np.array([len(terms)]))
                        spans = [(s, s + len(terms)) for s in np.sort(start).tolist()]
                    else:
                        spans = []
                    for a, b in spans:
                        k = int(segment.document(np.array([a]))[0])
                        first = int(segment.firsts[k])
                        out.append((row["doc_ids"][k], name, a - first, b - first))
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "phrase", "start", "end"]
                )

    return index.mapInArrow(run, "doc_id long, phrase string, start long, end long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs``: the spans of words in windows of the benchmark, and the items they come from.

    A null or empty text has no words and no hit. Repeated rows are rows of their own. Items without words hit
    nothing; an item without an id hits, but is not among the items of a document; rows of an item's id are united. Only ``doc_id``, ``text``, ``item_id`` and
    ``text`` are read, other columns are ignored. An empty table on either side gives no hits.
    """
    small_batches(docs.sparkSession)
    index = saved(build_index(docs), "postings")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    # A repeated item is one; copies would all fall into one block.
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-int(total) // block_bytes) or 1
    found = None
    for k in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = mine.collect()  # about block_bytes of text
        hits = search(index, *windows_of([r["text"] for r in rows], [r["item_id"] for r in rows], window))
        found = hits if found is None else found.unionByName(hits)
    if blocks > 1:
        united = found.groupBy("segment", "place").agg(
            *[F.first(c).alias(c) for c in ("doc_id", "n_words")],
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")],
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = united.select("segment", "place", "doc_id", "n_words", "starts", "ends", "items")
    return found


def digests(found: DataFrame) -> DataFrame:
    """What the contamination of each document comes to; spans of several blocks can overlap."""
    zero = F.lit(0).cast("long")
    n_hit = F.aggregate(
        F.array_sort(F.arrays_zip("starts", "ends")),
        F.struct(zero.alias("total"), zero.alias("reached")),
        lambda done, span: F.struct(
            (done["total"] + F.greatest(zero, span["ends"] - F.greatest(span["starts"], done["reached"]))).alias("total"),
            F.greatest(done["reached"], span["ends"]).alias("reached"),
        ),
        lambda done: done["total"],
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, whatever they are called.

    Rows of the same id and text are judged alike; null ids and texts count as values. Null and empty texts stay.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    found = digests(contamination(docs.select(key.alias("doc_id"), "text"), benchmark))
    gone = found.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return docs.select(whole_row(docs), key.alias("key")).join(gone, "key", "left_anti").select("row.*")


#: The same in SQL.
SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS place, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k : k + 12], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS k FROM items WHERE len(w) > 0)
), grams AS (
    SELECT place, k, n, array_to_string(w[k : k + n - 1], ' ') AS gram
    FROM (SELECT place, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
    SELECT DISTINCT place, k, n, item_id FROM grams JOIN windows USING (n, gram)
), covered AS (
    SELECT place, count(DISTINCT pos) AS n_hit FROM (SELECT place, unnest(range(k, k + n)) AS pos FROM hits) GROUP BY place
), owners AS (
    SELECT place, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT place, item_id::VARCHAR AS name FROM hits WHERE item_id IS NOT NULL) GROUP BY place
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (place) LEFT JOIN owners USING (place)
"""
