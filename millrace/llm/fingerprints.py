"""Order MinHash fingerprints of documents, and likeness that follows edit distance.

Every k-mer of code points is numbered by its occurrence, so repeats count. The numbered k-mers fall into buckets
by their hash; in each bucket the smallest few are selected and, in the order in which they stand in the text,
hashed to one value. Two texts agree in a bucket if they share its smallest k-mers in the same order: moving
passages around changes the fingerprint, other than with a MinHash of sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BASE, U64, mix, powers, saved, small_batches

K = 6
BUCKETS = 64
#: k-mers of one value.
TUPLE = 2
_INVERSE = pow(BASE, -1, 1 << 64)
_EMPTY = np.uint32(0)


def _numbered_kmers(points: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k-mer at every place together with how often it stood before."""
    n = max(len(points) - k + 1, min(len(points), 1))
    if not n:
        return np.zeros(0, U64)
    k = min(k, len(points))
    sums = np.zeros(len(points) + 1, U64)
    np.cumsum(mix(points.astype(U64) + U64(1)) * powers(BASE, len(points)), out=sums[1:])
    hashes = mix((sums[k:] - sums[:-k]) * powers(_INVERSE, n))
    # Hash above, place below: one plain sort brings equal k-mers together in the order of the text.
    bits = U64(max(int(n - 1).bit_length(), 1))
    places = np.arange(n, dtype=U64)
    packed = np.sort((hashes >> bits << bits) | places)
    value = packed >> bits
    place = (packed & ((U64(1) << bits) - U64(1))).astype(np.int64)
    fresh = np.concatenate([[True], value[1:] != value[:-1]])
    before = np.arange(n) - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    repeated = before > 0
    hashes[place[repeated]] += before[repeated].astype(U64) * U64(0xC2B2AE3D27D4EB4F)
    hashes[place[repeated]] = mix(hashes[place[repeated]])
    return hashes


def fingerprint(text: str, k: int = K, buckets: int = BUCKETS, size: int = TUPLE) -> np.ndarray:
    """One 32-bit value for each bucket, 0 for a bucket without a k-mer."""
    hashes = _numbered_kmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), k)
    n, wanted = len(hashes), buckets * size
    # Only small hashes can be selected; widen until every bucket has enough or all are in.
    share = min(1.0, 8 * wanted / max(n, 1))
    while True:
        chosen = np.flatnonzero(hashes <= U64(int(share * (2**64 - 1)))) if share < 1 else np.arange(n)
        bucket = (hashes[chosen] % U64(buckets)).astype(np.int64)
        if share >= 1 or np.bincount(bucket, minlength=buckets).min() >= size:
            break
        share = min(1.0, share * 8)
    order = np.lexsort((chosen, hashes[chosen], bucket))
    chosen, bucket = chosen[order], bucket[order]
    first = np.searchsorted(bucket, np.arange(buckets))
    rank = np.arange(len(bucket)) - first[bucket]
    chosen, bucket = chosen[rank < size], bucket[rank < size]
    order = np.lexsort((chosen, bucket))
    chosen, bucket = chosen[order], bucket[order]
    rank = np.arange(len(bucket)) - np.searchsorted(bucket, np.arange(buckets))[bucket]
    value = np.zeros(buckets, U64)
    for turn in range(size):
        at = rank == turn
        value[bucket[at]] = mix(value[bucket[at]] * U64(BASE) + hashes[chosen[at]])
    out = (value >> U64(32)).astype(np.uint32)
    out[np.unique(bucket)] |= np.uint32(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values among the buckets that either fills; 1 for two empty texts."""
    filled = (a != _EMPTY) | (b != _EMPTY)
    return float((a[filled] == b[filled]).mean()) if filled.any() else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; the fingerprint as hexadecimal digits, eight for a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([_bytes(fingerprint(t)).hex() for t in texts], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string"
    )


def _bytes(value: np.ndarray) -> bytes:
    return value.astype(">u4").tobytes()


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Digests stay bytes until the end, half of what their digits take.
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
#: What a pass over an ordered part leaves: finished rows, and the first and last text of the part.
_DONE, _FIRST, _LAST = 0, 1, 2


def _compared(doc_id, text: str, own: np.ndarray, following: str, its: np.ndarray) -> tuple:
    changed = edited(text, following)
    changed_print = fingerprint(changed)
    return (
        doc_id, len(text), hashlib.sha256(changed.encode()).digest(), _bytes(own), _bytes(changed_print),
        likeness(own, changed_print), likeness(own, its),
    )


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_RESULT_FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, and how like they are to it and to the next row's.

    Rows stand in the order of ``doc_id``, those of one id in the order of a hash of the text; nulls come first; the row after the last is the first. A null
    text is empty. Repeated rows are rows of their own, next to each other. An empty table gives no rows; a single
    row is followed by itself. Columns other than ``doc_id`` and ``text`` are ignored.

    The texts are sorted across tasks once. Only the first and last row of each ordered part meet another part.
    """
    small_batches(docs.sparkSession)
    # By place too: copies of one row may be cut into any number of ranges, and their order does not matter.
    order = ["doc_id", F.xxhash64("text"), "place"]
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("place")
    )
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), *_RESULT_FIELDS, ("text", pa.string())])

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                rows, piece = [], batch.slice(first, 500)
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    own = fingerprint(text)
                    if before is None:
                        rows.append((_FIRST, part, doc_id, *[None] * 6, text))
                    else:
                        rows.append((_DONE, part, *_compared(*before, text, own), None))
                    before = (doc_id, text, own)
                yield _table(rows, schema)
        if before is not None:
            yield _table([(_LAST, part, before[0], *[None] * 6, before[1])], schema)

    passed = saved(ordered.mapInArrow(pass_over, f"kind int, part int, {_RESULT}, text string"), "fingerprints")
    names = [name for name, _ in _RESULT_FIELDS]
    # One small number for each part.
    parts = sorted(r["part"] for r in passed.where(F.col("kind") == _FIRST).select("part").collect())
    following = docs.sparkSession.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next_part int"
    )
    last = passed.where(F.col("kind") == _LAST).select("part", "doc_id", "text")
    first = passed.where(F.col("kind") == _FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    border = last.join(following, "part").join(first, "next_part").select("doc_id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _compared(r["doc_id"], r["text"], fingerprint(r["text"]), r["next_text"], fingerprint(r["next_text"]))
                for r in batch.to_pylist()
            ]
            yield _table(rows, pa.schema(_RESULT_FIELDS))

    found = passed.where(F.col("kind") == _DONE).select(*names).unionByName(border.mapInArrow(finish, _RESULT))
    digests = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return found.withColumns({c: F.lower(F.hex(c)) for c in digests})
