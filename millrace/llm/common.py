"""What the operators of this subpackage share: scratch tables, batches by bytes and hashes of byte runs."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

U64 = np.uint64
#: Bytes of text that one step of a task holds as arrays; a single longer text is a step of its own.
STEP_BYTES = 2 << 20


#: What a task sends to its Python worker at a time; the default takes 10,000 texts, however long.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound batches by bytes, in the session: half of a small executor would else be batches on their way."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Give back to the system what this worker has freed; Arrow and the allocator would keep it from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that releases memory when its task has ended.

    Workers outlive their tasks: those of an executor would else hold the largest of all stages that they have run.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


def released_group(run: Callable) -> Callable:
    """The same for a function of ``applyInArrow`` whose groups are large."""

    def whole(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release_memory()

    return whole


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back, so that later steps start from files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that helpers beside it cannot clash with any of them; ``row.*`` takes it apart."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias(name)


def held_out(doc_id: str = "doc_id"):
    """True for rows that models must not learn labels from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(column: str = "text"):
    """A text column as bytes; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def byte_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary array and the offsets of its rows; null is empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = byte_array(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.ones(1, U64)
        while len(have) < size:
            have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h[i] is the sum of value(byte j) * BASE**j for j < i; runs are compared by ``run_hash``."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_VALUES[data] * powers(BASE, len(data)), out=out[1:])
    return out


def run_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs [start, end), equal for equal bytes wherever they stand."""
    inverse = powers(_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_table(separators: bytes) -> np.ndarray:
    """For each byte, whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of several texts, and the place of each text's first word (one more at the end)."""
    inside = table[data]
    cuts = offsets[1:-1]
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    before[cuts[cuts < len(data)]] = False
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Scatter:
    """Collects columns of numbers and deals them out by the range of a hash, packed into few rows.

    A row is (part, n, blob): ``n`` entries of the columns, one column after the other. ``bits`` of the hash decide
    the part; what reads a part sees about as many entries as any other.
    """

    def __init__(self, bits: int, types: list[str], limit: int = 1 << 19):
        self.bits, self.types, self.limit, self.held, self.n = bits, types, limit, [], 0

    def add(self, hashes: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = (hashes >> U64(64 - self.bits)).astype(np.uint16 if self.bits <= 16 else np.uint32)
        self.held.append((parts, *[c.astype(t) for c, t in zip(columns, self.types, strict=True)]))
        self.n += len(hashes)
        if self.n >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            parts, *columns = (np.concatenate(c) for c in zip(*self.held, strict=True))
            self.held = []
            order = np.argsort(parts, kind="stable")
            parts = parts[order]
            cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]]))
            packed = [c[order] for c in columns]
            blobs = [b"".join(c[a:b].tobytes() for c in packed) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[cuts[:-1]].astype(np.int32)), pa.array(np.diff(cuts).astype(np.int32)), pa.array(blobs, pa.binary())],
                names=["part", "n", "blob"],
            )
        self.held, self.n = [], 0


SCATTERED = "part int, n int, blob binary"


def gathered(table: pa.Table, types: list[str]) -> list[np.ndarray]:
    """The columns of all entries of a part."""
    columns: list[list[np.ndarray]] = [[] for _ in types]
    for n, blob in zip(table.column("n").to_pylist(), table.column("blob").to_pylist(), strict=True):
        at = 0
        for column, t in zip(columns, types, strict=True):
            column.append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(columns, types, strict=True)]


def part_bits(entries: float, each: int) -> int:
    """Bits of a hash for parts of about ``each`` entries."""
    return max(3, int(np.ceil(np.log2(max(entries / each, 1)))))


def groups_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order by the keys (the first counts most) and, in it, where a new combination begins."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, new
