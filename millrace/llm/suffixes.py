"""Removal of repeated byte strings: a depth-limited radix sort of suffixes, most significant digits first.

Suffixes are ordered only through ``LENGTH`` bytes; those that are equal so far are the repeated windows. Sorting
every position would move the corpus many times over, so the first digit is taken where it separates most: each
window has an anchor, the block of ``BLOCK`` bytes with the smallest hash in it, and equal windows have equal
anchors at equal places. The passes are

1. by anchor: blocks that occur once end here, and with them nearly all windows;
2. by context (the bytes of all windows of an anchor): of equal contexts the earliest goes on, all windows of the
   others are repeated;
3. by the digits of the windows themselves: only for anchors with several contexts.

Within a task equal contexts are put together before anything is shuffled, and so are equal windows (eight bytes at a
time); of those only the earliest goes on, so that an anchor or window of very many documents is a few entries for
each task. Across tasks windows are compared by 96-bit hashes; texts of one id are told apart by 64-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    SCATTERED, U64, Scatter, byte_array, gathered, groups_of, mix, part_bits, prefix_hash, run_hash, runs_of, saved, small_batches, steps,
)

LENGTH, BLOCK = 100, 32
#: Entries that a task of the first and of the last pass sorts at a time.
FIRST_PART, LAST_PART = 250_000, 8_000
_STEP = 1 << 19
#: Entries, and windows, that a task puts together at a time; contexts of an anchor that it sends on one by one.
_ENTRIES, _WINDOWS, _SEVERAL = 1 << 19, 1 << 19, 8
#: anchor, context, document, text's hash, start of its first window, number of windows, place of the anchor, state.
_ENTRY = ["<u4", "<u8", "<i8", "<i8", "<u4", "u1", "u1", "u1"]
#: An entry to be compared; the same, its anchor having further contexts; one that is repeated; one to look into.
_PLAIN, _ONE_OF, _AGAIN, _OPEN = range(4)
#: Both parts of a window's hash, document, text's hash, start, and how many windows are repeated, 0 if it is to be compared.
_WINDOW = ["<u8", "<u4", "<i8", "<i8", "<u4", "u1"]
MARKS = "doc_id long, check long, start long, n int, anchor int, again boolean"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, block: int = BLOCK):
    """The anchors of all windows of several texts: hash, place, first and last start of its windows, context's hash.

    Of equal smallest hashes in a window the leftmost is the anchor, which depends on the window's bytes only.
    """
    prefix = prefix_hash(data)
    n = len(data) - block + 1
    if n < length - block + 1:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none, none, none.astype(U64)
    place = np.arange(n)
    hashes = run_hash(prefix, place, place + block)
    bits = U64(max(1, int(n).bit_length()))
    least = sliding_min((hashes >> bits << bits) | place.astype(U64), length - block + 1)
    inside = np.zeros(len(least) + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    least = least[starts]
    cut = np.flatnonzero((least[1:] != least[:-1]) | (np.diff(starts) != 1)) + 1
    first = starts[np.concatenate([[0], cut])] if len(starts) else starts
    last = starts[np.concatenate([cut, [len(starts)]]) - 1] if len(starts) else starts
    place = (least[np.concatenate([[0], cut])] & ((U64(1) << bits) - U64(1))).astype(np.int64) if len(starts) else starts
    return mix(hashes[place] + U64(1)), place, first, last, run_hash(prefix, first, last + length)


def _marks(doc_id, check, start, n, anchor, again) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(t)) for x, t in zip((doc_id, check, start, n, anchor, again), ("<i8", "<i8", "<i8", "<i4", "<i4", bool), strict=True)],
        names=["doc_id", "check", "start", "n", "anchor", "again"],
    )


def _ranked(anchor, context, doc_id, check, start):
    """A sorting order, and in it: the anchor's group, where a context begins, where an entry is its context's first."""
    order, _ = groups_of(anchor, context, doc_id, check, start)
    anchor, context, doc_id, check, start = (x[order] for x in (anchor, context, doc_id, check, start))
    new_anchor, new_context = np.ones(len(order), bool), np.ones(len(order), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_context[1:] = new_anchor[1:] | (context[1:] != context[:-1])
    first = np.maximum.accumulate(np.where(new_context, np.arange(len(order)), 0))
    # The same row twice is one document.
    return order, np.cumsum(new_anchor) - 1, new_context, (doc_id == doc_id[first]) & (check == check[first]) & (start == start[first])


def _together(most: int, anchor, *columns):
    """Entries of a task, put together: hashes by which they are dealt out, and the columns of ``_ENTRY``.

    What is settled here goes anywhere: repeated contexts, and contexts to be looked into because their anchor has
    more than ``most`` in this task. Of the latter one stands for all in the comparison with other tasks.
    """
    order, group, new_context, first = _ranked(anchor, *columns[:4])
    anchor, *columns = (x[order] for x in (anchor, *columns))
    many = np.bincount(group, new_context, minlength=1)[group] > most
    new_anchor = np.ones(len(order), bool)
    new_anchor[1:] = group[1:] != group[:-1]
    state = np.where(~first, _AGAIN, np.where(~many, _PLAIN, np.where(new_anchor, _ONE_OF, _OPEN)))
    wanted = ~first | new_context
    dealt = np.where(state >= _AGAIN, mix(columns[0] ^ mix(columns[1].astype(U64) + columns[3].astype(U64))), anchor)
    return [x[wanted] for x in (dealt, anchor & U64(0xFFFFFFFF), *columns, state)]


def _settled(anchor, context, doc_id, check, start, n, place, state) -> pa.RecordBatch:
    """Marks of entries: ``again`` where an equal context is earlier, not where the context must be looked into."""
    known = state >= _AGAIN
    done = [x[known] for x in (doc_id, check, start, n, place)]
    known_again = state[known] == _AGAIN
    anchor, context, doc_id, check, start, n, place, state = (x[~known] for x in (anchor, context, doc_id, check, start, n, place, state))
    order, group, new_context, first = _ranked(anchor, context, doc_id, check, start)
    several = (np.bincount(group, new_context, minlength=1) > 1) | (np.bincount(group, state[order] == _ONE_OF, minlength=1) > 0)
    wanted = ~first | (new_context & several[group])
    chosen = order[wanted]
    columns = [np.concatenate([a, b[chosen]]) for a, b in zip(done, (doc_id, check, start, n, place), strict=True)]
    return _marks(*columns, np.concatenate([known_again, ~first[wanted]]))


def equal_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Radix sort of the windows at ``starts`` within their groups; returns those that repeat and their class.

    One pass for each eight bytes; a window that is alone drops out.
    """
    words = np.zeros(max(len(data) - 7, 0), U64)
    for k in range(8):
        words |= data[k : len(data) - 7 + k].astype(U64) << U64(8 * (7 - k))
    left = np.arange(len(starts))
    for depth in [*range(0, length - 8, 8), length - 8]:
        order, new = groups_of(group, words[starts[left] + depth])
        left, group = left[order], np.cumsum(new)
        alone = new & np.concatenate([new[1:], [True]]) if len(new) else new
        left, group = left[~alone], group[~alone]
    return left, group


def _window_hashes(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window, of 64 bits and of 32."""
    words = np.zeros(max(len(data) - 7, 0), U64)
    for k in range(8):
        words |= data[k : len(data) - 7 + k].astype(U64) << U64(8 * (7 - k))
    out = np.zeros(len(starts), U64)
    for depth in [*range(0, length - 8, 8), length - 8]:
        out = mix(out * U64(0x9E3779B97F4A7C15) + words[starts + depth])
    return run_hash(prefix_hash(data), starts, starts + length), out >> U64(32)


def _windows(doc_id, check, start, n, contexts: list[bytes]):
    """Windows of contexts, put together: hashes by which they are dealt out, and the columns of ``_WINDOW``.

    Of equal windows the earliest is to be compared with other tasks; the others are repeated, neighbours as one.
    """
    doc_id, check, start, n = (np.array(x, np.int64) for x in (doc_id, check, start, n))
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    entry = np.repeat(np.arange(len(n)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(sizes) - sizes)[entry] + within
    place = start[entry] + within
    left, group = equal_windows(data, at, np.zeros(len(at), np.int64))
    order, _ = groups_of(group, doc_id[entry[left]], check[entry[left]], place[left])
    left, group = left[order], group[order]
    first = left[np.searchsorted(group, group)]
    # The same row twice is one document.
    later = (doc_id[entry[left]] != doc_id[entry[first]]) | (check[entry[left]] != check[entry[first]]) | (place[left] != place[first])
    again = np.sort(left[later])
    # Neighbouring windows of an entry become one mark.
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(again) != 1) | (entry[again][1:] != entry[again][:-1])])) if len(again) else again
    counts = np.diff(np.concatenate([cut, [len(again)]])) if len(again) else again
    marked = again[cut]
    compared = np.ones(len(at), bool)
    compared[left[left != first]] = False
    compared = np.flatnonzero(compared)
    h1, h2 = _window_hashes(data, at[compared])
    anywhere = mix(mix(doc_id[entry[marked]].astype(U64)) + place[marked].astype(U64))
    chosen = np.concatenate([compared, marked])
    none = np.zeros(len(marked), U64)
    return [
        np.concatenate([h1, anywhere]), np.concatenate([h1, none]), np.concatenate([h2, none]),
        doc_id[entry[chosen]], check[entry[chosen]], place[chosen], np.concatenate([np.zeros(len(compared), np.int64), counts]),
    ]


def _repeated(table: pa.Table) -> pa.Table:
    """The last pass over a part: which windows have an earlier equal."""
    h1, h2, doc_id, check, start, n = gathered(table, _WINDOW)
    known = np.flatnonzero(n > 0)
    rest = np.flatnonzero(n == 0)
    order, _ = groups_of(*(x[rest] for x in (h1, h2, doc_id, check, start)))
    order = rest[order]
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (doc_id[order] != doc_id[first]) | (check[order] != check[first]) | (start[order] != start[first])
    again = np.concatenate([known, order[later]])
    zero = np.zeros(len(again), np.int64)
    return pa.Table.from_batches([_marks(doc_id[again], check[again], start[again], np.maximum(n[again], 1), zero, zero == 0)])


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compressed texts (doc_id, check, z), and marks: ``n`` repeated windows from ``start`` on of a document."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).withColumn("check", F.xxhash64("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = part_bits(total * 2 / (LENGTH - BLOCK), FIRST_PART)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = Scatter(bits, _ENTRY, 1), []
        for batch in steps(batches, limit=_STEP):
            doc_id, check = batch.column("doc_id").to_numpy(), batch.column("check").to_numpy()
            data, offsets = byte_array(batch.column("text"))
            hashes, place, start, last, context = anchors(data, offsets)
            row = np.searchsorted(offsets, start, side="right") - 1
            held.append((hashes, context, doc_id[row], check[row], start - offsets[row], (last - start + 1).astype(np.uint8), (place - start).astype(np.uint8)))
            if sum(len(h[0]) for h in held) >= _ENTRIES:
                yield from out.add(*_together(_SEVERAL, *(np.concatenate(c) for c in zip(*held, strict=True))))
                held = []
        if held:
            yield from out.add(*_together(_SEVERAL, *(np.concatenate(c) for c in zip(*held, strict=True))))

    def settle(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_settled(*gathered(table, _ENTRY))])

    marks = saved(rows.mapInArrow(first, SCATTERED).groupBy("part").applyInArrow(settle, MARKS), "anchors")
    texts = rows.mapInArrow(_compressed, "doc_id long, check long, z binary")

    open_ = marks.where("not again")
    last_bits = part_bits(open_.count(), LAST_PART)
    wanted = open_.groupBy("doc_id", "check").agg(F.collect_set(F.struct("start", "n")).alias("wanted"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, out, held, count = zstandard.ZstdDecompressor(), Scatter(last_bits, _WINDOW, 1), [], 0
        for batch in batches:
            for first_row in range(0, batch.num_rows, 200):
                for r in batch.slice(first_row, 200).to_pylist():
                    text = unpack.decompress(r["z"])
                    for w in r["wanted"]:
                        at, n = w["start"], w["n"]
                        held.append((r["doc_id"], r["check"], at, n, text[at : at + n - 1 + LENGTH]))
                        count += n
                        if count >= _WINDOWS:
                            yield from out.add(*_windows(*(list(c) for c in zip(*held, strict=True))))
                            held, count = [], 0
        if held:
            yield from out.add(*_windows(*(list(c) for c in zip(*held, strict=True))))

    looked_into = texts.join(wanted, ["doc_id", "check"]).mapInArrow(contexts, SCATTERED).groupBy("part").applyInArrow(_repeated, MARKS)
    again = marks.where("again").unionByName(looked_into).select("doc_id", "check", "start", "n")
    return texts, again


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=5)
    for batch in steps(batches):
        z = [pack.compress(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("check"), pa.array(z, pa.binary())], names=["doc_id", "check", "z"])


def removed_runs(n_bytes: int, starts: list[int], counts: list[int], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under the marked windows."""
    edges = np.zeros(n_bytes + 1, np.int64)
    np.add.at(edges, np.array(starts, np.int64), 1)
    np.add.at(edges, np.array(starts, np.int64) + np.array(counts, np.int64) - 1 + length, -1)
    return runs_of(np.cumsum(edges[:-1]) > 0)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: (doc_id, text, starts, ends), the text as bytes and the byte runs to be removed from it.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a row of a smaller ``doc_id``
    (null is the smallest), or before in the same text. A null text is empty. The same row twice is one document and
    has one result twice; different texts of one id stand in the order of a hash. An empty table gives no rows. Other
    columns are ignored.
    """
    return _marked(docs).mapInArrow(_finish, _ROWS)


_ROWS = "doc_id long, text binary, starts array<long>, ends array<long>"


def _marked(docs: DataFrame) -> DataFrame:
    texts, again = find(docs)
    grouped = again.groupBy("doc_id", "check").agg(F.collect_list("start").alias("s"), F.collect_list("n").alias("c"))
    return texts.join(grouped, ["doc_id", "check"], "left")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            rows = []
            for r in batch.slice(first, 200).to_pylist():
                text = unpack.decompress(r["z"])
                a, b = removed_runs(len(text), r["s"] or [], r["c"] or [])
                rows.append((None if r["doc_id"] == -(2**63) else r["doc_id"], text, a.tolist(), b.tolist()))
            columns, runs = zip(*rows, strict=True), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.binary(), runs, runs), strict=True)],
                names=["doc_id", "text", "starts", "ends"],
            )


_DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            out = []
            for r in batch.slice(first, 200).to_pylist():
                kept, at, text = hashlib.sha256(), 0, r["text"]
                for a, b in zip(r["starts"], r["ends"], strict=True):
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                out.append((r["doc_id"], len(text), sum(r["ends"]) - sum(r["starts"]), len(r["starts"]), kept.hexdigest()))
            columns, number = zip(*out, strict=True), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (number, number, number, number, pa.string()), strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def digests(rows: DataFrame) -> DataFrame:
    """What :func:`deduplicated` comes to, by document."""
    return rows.mapInArrow(_digest, _DIGESTS)


def deduplicated_digests(docs: DataFrame) -> DataFrame:
    """The same as ``digests(deduplicated(docs))``, by one worker of each task."""
    return _marked(docs).mapInArrow(lambda batches: _digest(_finish(batches)), _DIGESTS)


#: The same in SQL.
SQL = """
WITH texts AS (
    SELECT row_number() OVER () AS place, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
    SELECT *, length(h) // 2 AS n FROM texts
), starts AS (
    SELECT place, doc_id, pos, substr(h, 2 * pos + 1, 200) AS bytes FROM (SELECT *, unnest(range(n - 99)) AS pos FROM sized WHERE n >= 100)
), again AS (
    SELECT place, pos FROM starts QUALIFY row_number() OVER (PARTITION BY bytes ORDER BY doc_id, pos) > 1
), runs AS (
    SELECT place, min(pos) AS a, max(pos) + 100 AS b FROM (
        SELECT place, pos, sum(CASE WHEN pos - before <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY place ORDER BY pos) AS run
        FROM (SELECT place, pos, lag(pos) OVER (PARTITION BY place ORDER BY pos) AS before FROM again)
    ) GROUP BY place, run
), gone AS (
    SELECT place, list([a, b] ORDER BY a) AS spans, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY place
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE array_to_string(list_transform(range(len(spans) + 1), lambda k: substr(h,
        CASE WHEN k = 0 THEN 1 ELSE 2 * spans[k][2] + 1 END,
        CASE WHEN k = len(spans) THEN length(h) ELSE 2 * (spans[k + 1][1] - CASE WHEN k = 0 THEN 0 ELSE spans[k][2] END) END)), '') END)) AS kept_sha256
FROM sized LEFT JOIN gone USING (place)
"""
