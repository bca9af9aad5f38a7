"""Language of a text by n-gram filters that answer for all languages at once.

Every language has the set of the n-grams (of four bytes, lower-cased, with blanks around words) that make up a
sufficient share of its text. The sets lie in bit-sliced Bloom filters: each place of one array holds a mask with a
bit for every language, and the masks of an n-gram's places, combined by AND, name all languages that contain it.
A text's n-grams are looked up in bulk; the bits of each language are counted, the expected false positives of its
filter are taken off, and the language with the largest rest is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import U64, byte_array, held_out, mix, small_batches, steps

UNKNOWN = "und"
#: Documents of each language that training reads (expected, by a hash of the id).
SAMPLE_DOCUMENTS = 1500
#: Share of a language's n-grams from which on one belongs to its set; so a set has at most 1 / share members.
LEAST_SHARE = 2e-5
#: Places of the filters, and places of an n-gram.
PLACES, HASHES = 1 << 20, 3
MOST_LANGUAGES = 64
_BLANKS = np.frombuffer(b"    ", np.uint32)[0]


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams as numbers, and where those of each text begin (one more at the end)."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    blanks, nothing = (pa.scalar(x, pa.large_string()) for x in ("  ", ""))
    padded = pc.binary_join_element_wise(blanks, lowered, blanks, nothing)
    data, offsets = byte_array(padded)
    other = (data < 97) | ((data > 122) & (data < 128))
    data = np.where(other, 32, data).astype(np.uint32)
    grams = data[:-3] | data[1:-2] << np.uint32(8) | data[2:-1] << np.uint32(16) | data[3:] << np.uint32(24)
    inside = np.ones(len(grams), bool)
    for k in range(3):
        ends = offsets[1:-1] - 1 - k
        inside[ends[ends < len(grams)]] = False
    inside &= grams != _BLANKS
    at = np.concatenate([[0], np.cumsum(inside)])
    return grams[inside], at[np.minimum(offsets, len(inside))]


def _places(grams: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield (mix(grams.astype(U64) + U64((k + 1) << 40)) >> U64(44)).astype(np.int64)


class Filters:
    """The combined array and what it falsely reports for each language."""

    def __init__(self, languages: list[str], array: np.ndarray):
        self.languages, self.array = languages, array
        filled = np.array([np.count_nonzero(array >> U64(k) & U64(1)) for k in range(len(languages))])
        self.false = np.minimum((filled / PLACES) ** HASHES, 0.999)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """For each n-gram, the languages that contain it, a bit each."""
        first, *rest = _places(grams)
        out = self.array[first]
        for places in rest:
            out &= self.array[places]
        return out

    def decide(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        grams, at = ngrams(texts)
        masks, total = self.masks(grams), np.diff(at)
        rest = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            bits = np.concatenate([[0], np.cumsum((masks >> U64(k) & U64(1)).astype(np.int64))])
            found = bits[at[1:]] - bits[at[:-1]]
            rest[:, k] = np.maximum(found - total * self.false[k], 0) / (1 - self.false[k])
        letters = pc.match_substring_regex(texts.fill_null(""), r"\pL").to_numpy(zero_copy_only=False)
        known = letters & bool(self.languages)
        best = rest.argmax(axis=1) if self.languages else np.zeros(len(texts), int)
        share = rest.max(axis=1, initial=0) / np.maximum(rest.sum(axis=1), 1e-9)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, np.where(known, share, 0.0)


def train(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, least_share: float = LEAST_SHARE) -> Filters:
    """Filters from a sample of the rows with text and language that are not held out.

    What reaches the driver is one row for each language and one for each filled place of the filters, both bounded.
    """
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null").where(~held_out())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; a mask has {MOST_LANGUAGES} bits")
    array = np.zeros(PLACES, U64)
    if not languages:
        return Filters([], array)
    limit, number = F.lit(0), F.lit(0)
    for k, language in enumerate(languages):
        limit = F.when(F.col("lang") == language, F.lit(round(min(1.0, sample / counts[language]) * 1_000_000))).otherwise(limit)
        number = F.when(F.col("lang") == language, F.lit(k)).otherwise(number)
    # By id, text and place: rows without an id, or of one, are drawn one by one like any others.
    draw = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(1_000_000))
    chosen = known.where(draw < limit).select(number.alias("language"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            own = batch.column("language").to_numpy()
            grams, at = ngrams(batch.column("text"))
            keys = (np.repeat(own, np.diff(at)).astype(U64) << U64(32)) | grams
            keys, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    grams = chosen.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    totals = grams.groupBy(F.shiftright("key", 32).alias("language")).agg(F.sum("n").alias("total"))
    members = grams.withColumn("language", F.shiftright("key", 32)).join(F.broadcast(totals), "language")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().astype(U64)
            bits = (U64(1) << (keys >> U64(32))).astype(np.int64)
            for places in _places((keys & U64(0xFFFFFFFF)).astype(np.uint32)):
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(bits)], names=["place", "mask"])

    filled = members.where(F.col("n") >= F.col("total") * least_share).select("key").mapInArrow(place, "place long, mask long")
    for r in filled.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow().to_batches():
        array[r.column("place").to_numpy()] = r.column("mask").to_numpy().astype(U64)
    return Filters(languages, array)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row: ``und`` and 0 for a text that is null or has no letter.

    The score is the answer's share of the corrected counts of all languages. Ties go to the language whose name
    comes first. Repeated rows are judged each for itself; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            names, values = shared.value.decide(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(values)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    return predict(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
