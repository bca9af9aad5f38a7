"""Packing of tokenised documents: every document is cut into pieces of binary lengths.

The length of a document is written in powers of two, the largest allowed as often as it fits; each piece is a
sequence of its own, so none crosses documents and none is padded. No row meets another: there is nothing to shuffle.
Pieces of one length form a bucket, a folder of its own once they are written, and batches are drawn from one bucket
at a time, so that every batch is a full rectangle.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import released, small_batches, steps
from millrace.sources.tables import number_rows

MAX_LENGTH = 2048
#: Appended to every document.
END_ID = 1
#: Words whose ids a worker remembers; beyond it starts afresh.
REMEMBERED = 400_000

PIECES = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"


class Tokenizer:
    """Ids of the byte-level vocabulary, equal to those of the ``tokenizers`` library.

    Between a character and a single space no token is formed, so words cut at single spaces can be encoded apart
    and remembered. Words next to other white space make the text be encoded as a whole.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        with open(json_path, encoding="utf-8") as vocabulary:
            self.special = [t["content"] for t in json.load(vocabulary)["added_tokens"]]
        self.json_path, self._whole = json_path, None
        self.known: dict[str, bytes | None] = {}

    @property
    def whole(self):
        """The library's own tokenizer, loaded for the first text that needs it."""
        if self._whole is None:
            from tokenizers import Tokenizer as Whole

            self._whole = Whole.from_file(self.json_path)
        return self._whole

    def _word(self, word: str) -> bytes | None:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        plain = word and not word[0].isspace() and not word[-1].isspace()
        ids = np.array(self.encoding.encode_ordinary(" " + word), "<u4").tobytes() if plain else None
        if len(word) <= 64:
            self.known[word] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        first, *rest = text.split(" ")
        known, parts = self.known, []
        if first and first[-1].isspace():
            return np.array(self.encoding.encode_ordinary(text), "<u4")
        for word in rest:
            part = known.get(word)
            if part is None:
                part = self._word(word)
                if part is None:
                    return np.array(self.encoding.encode_ordinary(text), "<u4")
            parts.append(part)
        return np.frombuffer(np.array(self.encoding.encode_ordinary(first), "<u4").tobytes() + b"".join(parts), "<u4")


_loaded: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(json_name: str, ranks_name: str) -> Tokenizer:
    """One for each worker process, from the installed vocabularies."""
    if (json_name, ranks_name) not in _loaded:
        import public_tokenizers

        _loaded[json_name, ranks_name] = Tokenizer(
            public_tokenizers.path(json_name), public_tokenizers.path(ranks_name), public_tokenizers.PATTERN
        )
    return _loaded[json_name, ranks_name]


def binary_lengths(n: int, most: int) -> list[int]:
    """``n`` as powers of two up to ``most``, in falling order."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    json_name: str = "byte_bpe_50k.json",
    ranks_name: str = "byte_bpe_50k.tiktoken",
) -> DataFrame:
    """Pieces of every row of ``docs``: its ids, where they start in the document, and their own sequence.

    A null text is empty and gives one piece of the end id alone. Repeated rows are documents of their own; a null
    ``doc_id`` stays null; an empty table gives no pieces; other columns are ignored. The bucket of a piece is its
    ``length``. ``sequence_id`` numbers the pieces of a task after those of the tasks before (2**36 apart).
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length must be a power of two")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(json_name, ranks_name)
        sequence = TaskContext.get().partitionId() << 36
        for batch in steps(batches):
            columns: list[list] = [[] for _ in range(5)]
            flat = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode.ids(text or ""), np.uint32(END_ID))
                flat.append(ids)
                start = 0
                for length in binary_lengths(len(ids), max_length):
                    for column, value in zip(columns, (doc_id, start, length, len(ids), sequence), strict=True):
                        column.append(value)
                    start += length
                    sequence += 1
            doc_ids, starts, lengths, totals, sequences = columns
            cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(flat).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), ids,
                 pa.array(totals, pa.int64()), pa.array(sequences, pa.int64()), pa.array(np.zeros(len(starts), np.int64))],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(released(run), PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces as a table with a folder for each length. Every task writes what it has; nothing is shuffled."""
    pieces.write.partitionBy("length").parquet(path)


def batches(spark: SparkSession, path: str, length: int, size: int, seed: int = 0) -> DataFrame:
    """The bucket of one length in batches: its pieces with ``batch`` and ``place``, from 0.

    Only that bucket's folder is read. Its pieces are put into an order that the seed decides and cut into batches of
    ``size`` rows; the last may be shorter. A length without pieces gives no rows.
    """
    bucket = spark.read.schema(PIECES).parquet(path).where(F.col("length") == length)
    drawn = number_rows(bucket.withColumn("_draw", F.xxhash64("sequence_id", F.lit(seed))), ["_draw", "sequence_id"], "_row").drop("_draw")
    return drawn.select(F.floor(F.col("_row") / size).alias("batch"), (F.col("_row") % size).alias("place"), *[c.split(" ")[0] for c in PIECES.split(", ")])


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids instead of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            cuts = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "start", "length")], pa.array(sums, pa.int64()),
                 *[batch.column(c) for c in ("doc_tokens", "sequence_id", "offset")]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return pieces.mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
