"""Near-duplicate documents: an exact join of sets of word shingles with a Jaccard similarity of 0.75 or more.

Two sets of t <= s members that are similar enough differ in at most (t + s) / 7 members, and s <= 4t / 3. The
universe of shingles is cut into segments by a hash, more of them than there can be differences; by the pigeonhole
principle similar sets agree in the subset of some segment. Documents are signed by those subsets, for the band of
their size and for the band below, in which a smaller partner can lie. How a band is signed is a matter of cost:

* ``segments``: subsets of the segments, with spare segments in place of those that are empty or hold only shingles
  that very many documents share;
* ``deletions``: where one difference is allowed, the whole set and every set with one member left out;
* ``tokens``: the first quarter of the shingles, rare ones before those that many documents share. It also covers
  what segments cannot: documents with more empty segments than there are spare ones.

Documents with a signature in common are candidates. Candidates need not be paired with each other: first each one
is compared with the smallest of its signature's documents. Where that leaves several components, small parity
sketches bound how different two documents are at least. Documents that they leave a partner in another component
meet with their sets, group by group, and pairs are verified there, nearest first, until none is left that would join
two components. So no step hands on more rows than its groups have documents, and only documents with the same
signature are ever compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    U64, Scatter, byte_array, gathered, groups_of, lower_ascii, mix, part_bits, prefix_hash, released, released_group, run_hash, saved,
    small_batches, steps, whole_row, word_table, words_of,
)
from millrace.llm.graphs import components

SHINGLE = 5
#: Similar: NUMERATOR * union <= 100 * intersection.
PERCENT = 75
_TABLE = word_table(b" \t\n\r\x0b\x0c")
_STEP = 1 << 20
#: Signatures that a task looks through at a time; documents of one run of signatures.
PART, RUN_DOCUMENTS = 500_000, 60_000
#: Documents compared with each other in one go where a signature has several components, or with one hub.
BLOCK, HUB_BLOCK = 2048, 256
#: Rows of several small groups that are compared in one task.
CELL_ROWS = 20_000
#: Bytes of compressed texts that one task settles.
CELL_BYTES = 8 << 20
#: Classes of a sketch for each member, of one that is made within a task only, and at most in all.
_CLASSES, _FINE, _WIDEST = 4, 4, 1 << 17
#: Shingles are counted in so many classes of their hashes, to tell rare ones from common ones; a class is hot with
#: so many times the mean, and a few documents more.
COUNTED, HOT, FEW = 1 << 20, 4, 64


def similar(both: int, a: int, b: int) -> bool:
    return both > 0 and 100 * both >= PERCENT * (a + b - both)


def differences(t: int) -> int:
    """How many members a set of ``t`` and a similar one that is not smaller can have different."""
    return (t + t * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT)


@lru_cache(maxsize=None)
def band(k: int) -> tuple[int, int, str, int, int]:
    """Smallest and largest size of band ``k``, how it is signed, and its segments, spare ones among them."""
    low = 1 if k == 0 else band(k - 1)[1] + 1
    high = max(low, -(-low * 100 // PERCENT) - 1)
    allowed = differences(high)
    # Single shingles of a passage that many documents share bring far more candidates than subsets do.
    costs = {"tokens": (12.0 * (high // 4 + 1), 0)}
    if allowed <= 1:
        costs["deletions"] = (high + 1.0, 0)
    spare = 0
    for _ in range(60):
        m = allowed + 1 + spare
        # Empty segments that the smallest and the largest set of the band expect, and two deviations more.
        empty = max((differences(n) + 1 + spare) * math.exp(-n / m) for n in (low, high)) if m > 1 else 0.0
        wanted = math.ceil(empty + 2 * math.sqrt(empty))
        if wanted <= spare:
            costs["segments"] = (m * (1 + 4 * math.exp(-low / m)), spare)
            break
        spare = wanted
        if m > high:
            break
    kind = min(costs, key=lambda c: costs[c][0])
    return low, high, kind, allowed + 1 + costs[kind][1], costs[kind][1]


@lru_cache(maxsize=1 << 16)
def bands_of(n: int) -> tuple[int, ...]:
    """The bands for which a set of ``n`` is signed: its own, and the one below if a partner can lie there."""
    k = 0
    while band(k)[1] < n:
        k += 1
    return (k, k - 1) if k and 100 * band(k - 1)[1] >= PERCENT * n else (k,)


def signatures(members: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
    """64-bit signatures of a set of hashes (sorted): similar sets have one in common.

    ``common`` says how common the shingles of each class of hashes are, as powers of two above what is hot: where a
    prefix is taken, rare ones come first, and subsets of hot ones alone are like empty ones. Any such table gives a
    right answer, as long as all sets are signed by the same.
    """
    n, out = len(members), []
    for k in bands_of(n):
        low, high, kind, m, spare = band(k)
        salt = mix(np.array([k + 1], U64) << U64(40))
        tokens = kind == "tokens"
        if kind == "deletions":
            total = mix(members + salt).sum(dtype=U64)
            out.append(mix(np.concatenate([[total], total - mix(members + salt)])))
        elif not tokens:
            segment = ((members >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)
            sums = np.zeros(m, U64)
            np.add.at(sums, segment, mix(members + salt))
            filled = np.zeros(m, bool)
            filled[segment if common is None else segment[common[_classes(members)] == 0]] = True
            # A smaller set needs fewer segments: as many as it can have differences, and the spare ones.
            used = differences(min(n, high)) + 1 + spare
            chosen = np.flatnonzero(filled[:used])
            out.append(mix(sums[chosen] + mix(chosen.astype(U64) + salt)))
            tokens = used - len(chosen) > spare
        if tokens:
            # Of n members at least PERCENT are shared, so one of the first few in any common order is.
            size = n - -(-PERCENT * n // 100) + 1
            first = members[:size]
            if common is not None:
                first = members[np.lexsort((members, common[_classes(members)]))[:size]]
            out.append(mix(first ^ (salt * U64(3))))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U64)


def _classes(members: np.ndarray) -> np.ndarray:
    return (members & U64(COUNTED - 1)).astype(np.int64)


def how_common(rows: DataFrame) -> np.ndarray:
    """For each class of shingles: 0 if it is not hot, else how many documents it occurs in, as a power of two.

    Every task counts all its documents into one array; what is summed and sent is a number for each class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTED, np.int64)
        for batch in steps(batches, limit=_STEP):
            sets = shingle_sets(*byte_array(batch.column("text")))
            counts += np.bincount(_classes(np.concatenate(sets)), minlength=COUNTED)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(counts[filled])], names=["place", "n"])

    summed = saved(rows.select("text").mapInArrow(released(run), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")), "counted")
    # A number of at most 63 for each class: a megabyte at any size of the corpus.
    mean = summed.agg(F.sum("n")).first()[0] or 0
    hot = summed.where(F.col("n") >= HOT * mean / COUNTED + FEW)
    powers = hot.select("place", F.floor(F.log2("n")).cast("int").alias("power")).toArrow()
    out = np.zeros(COUNTED, np.uint8)
    out[powers.column("place").to_numpy()] = powers.column("power").to_numpy()
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    data = lower_ascii(data)
    starts, ends, firsts = words_of(data, offsets, _TABLE)
    words = run_hash(prefix_hash(data), starts, ends)
    multiplier, sums = U64(0x9E3779B97F4A7C15), np.zeros(max(len(words) - SHINGLE + 1, 0), U64)
    for k in range(SHINGLE):
        sums = sums * multiplier + words[k : k + len(sums)]
    shingles, out = mix(sums), []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(shingles[a : b - SHINGLE + 1]))
        else:
            value = U64(b - a)
            for w in words[a:b]:
                value = mix(np.array([value], U64) * multiplier + w)[0]
            out.append(np.array([value], U64)[: b - a])
    return out


def sketch(members: np.ndarray, classes: int = _CLASSES) -> bytes:
    """Parities of how many members fall into each of a power of two of classes."""
    width = min(max(64, classes << max(len(members) - 1, 0).bit_length()), _WIDEST)
    return np.packbits((np.bincount((members & U64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches of narrower width, from wider ones: parities of classes that fall together."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_link(n_a: np.ndarray, n_b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Not excluded by sizes or by the classes in which two sets differ: each difference changes one parity."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * small >= PERCENT * large) & (distance * (100 + PERCENT) <= (small + large) * (100 - PERCENT))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing classes of each row of ``a`` with each of ``b``; rows are whole 64-bit words."""
    p, q = (np.ascontiguousarray(x).view(U64) for x in (a, b))
    out = np.zeros((len(p), len(q)), np.int32)
    for word in range(p.shape[1]):
        out += np.bitwise_count(p[:, word, None] ^ q[None, :, word])
    return out


_PASS = "part int, flush long, n int, blob binary, node long, doc_id long, check long, size int, digest binary, sketch binary"
_FOUND = "kind int, a long, b long, members array<long>, doc_id long, check long, size int, digest binary, sketch binary"
_PAIR, _BUCKET, _MEMBER = 0, 1, 2


def _batch(schema: str, count: int, /, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(count, kinds[kind]) for name, kind in fields],
        names=[name for name, _ in fields],
    )


def _sign(bits: int, common=None):
    """``common`` is a broadcast of :func:`how_common`, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = TaskContext.get().partitionId() << 24
        out, known, rows = Scatter(bits, ["<u4", "<u2"], 1 << 62), {}, []

        def close() -> Iterator[pa.RecordBatch]:
            for batch in out.flush():
                yield _batch(_PASS, batch.num_rows, part=batch.column("part"), flush=[flush] * batch.num_rows, n=batch.column("n"), blob=batch.column("blob"))
            if rows:
                names = ("node", "doc_id", "check", "size", "digest", "sketch")
                columns = dict(zip(names, zip(*rows, strict=True), strict=True))
                yield _batch(_PASS, len(rows), part=[k % (1 << bits) for k in range(len(rows))], **{k: list(v) for k, v in columns.items()})

        for batch in steps(batches, limit=_STEP):
            sets = shingle_sets(*byte_array(batch.column("text")))
            for members, doc_id, check in zip(sets, batch.column("doc_id").to_pylist(), batch.column("check").to_pylist(), strict=True):
                # Within a step too: the documents of a run are numbered in 16 bits.
                if out.n >= PART or len(rows) >= RUN_DOCUMENTS:
                    yield from close()
                    out, known, rows, flush = Scatter(bits, ["<u4", "<u2"], 1 << 62), {}, [], flush + 1
                if not len(members):
                    rows.append((None, doc_id, check, 0, None, None))
                    continue
                digest = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
                # Equal sets of this run are one node already.
                fresh = digest not in known
                local = known.setdefault(digest, len(known))
                rows.append((flush << 16 | local, doc_id, check, len(members), digest, sketch(members) if fresh else None))
                if fresh:
                    signed = signatures(members, common.value if common is not None else None)
                    list(out.add(signed, signed & U64(0xFFFFFFFF), np.full(len(signed), local)))
        yield from close()

    return run


def _look_through(table: pa.Table) -> pa.Table:
    """Documents that share a signature: pairs with the smallest of them, and all of three or more."""
    part = table.column("part")[0].as_py()
    members = table.filter(pa.compute.is_valid(table.column("size")))
    signed = table.filter(pa.compute.is_valid(table.column("blob")))
    signature, local = gathered(signed, ["<u4", "<u2"])
    flush = np.repeat(signed.column("flush").to_numpy(), signed.column("n").to_numpy()) if signed.num_rows else np.zeros(0, np.int64)
    node = (flush << 16) | local
    order = np.argsort(signature, kind="stable")
    same = signature[order][1:] == signature[order][:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    signature, node = signature[order], node[order]
    order, _ = groups_of(signature, node)
    signature, node = signature[order], node[order]
    new = np.concatenate([[True], signature[1:] != signature[:-1]]) if len(order) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(order)))
    a, b = node[first][group][~new], node[~new]
    order, fresh = groups_of(a, b)
    a, b = a[order][fresh], b[order][fresh]
    out = [_batch(_FOUND, len(a), kind=np.full(len(a), _PAIR, np.int32), a=a, b=b)]
    lists, ids = [], []
    for g in np.flatnonzero(sizes >= 3):
        for at in range(first[g], first[g] + sizes[g], 4096):
            lists.append(node[at : min(at + 4096, first[g] + sizes[g])].tolist())
            ids.append(part << 32 | int(g))
    out.append(_batch(_FOUND, len(ids), kind=[_BUCKET] * len(ids), a=ids, members=lists))
    n = members.num_rows
    names = ("doc_id", "check", "size", "digest", "sketch")
    out.append(_batch(_FOUND, n, kind=[_MEMBER] * n, a=members.column("node").combine_chunks(), **{c: members.column(c).combine_chunks() for c in names}))
    return pa.Table.from_batches(out)


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and sketches do not exclude."""
    own = nodes.select("node", "size", "sketch")
    joined = pairs.join(own.toDF("a", "size_a", "sketch_a"), "a").join(own.toDF("b", "size_b", "sketch_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy()
            for x, y in zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True):
                width = min(len(x), len(y))
                p, q = (_folded(np.frombuffer(z, np.uint8)[None], width) for z in (x, y))
                keep.append(int(_distance(p, q)[0, 0]))
            chosen = pa.array(may_link(*sizes, np.array(keep, np.int64)))
            yield batch.select(["a", "b"]).filter(chosen)

    return joined.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(released(run), "a long, b long")


def _verify(table: pa.Table) -> pa.Table:
    """A hub's text and those of its candidates: which sets are similar."""
    unpack = zstandard.ZstdDecompressor()
    hub = table.column("a")[0].as_py()
    nodes, texts = table.column("b").to_pylist(), table.column("z").to_pylist()

    def members(z: bytes) -> np.ndarray:
        data = unpack.decompress(z)
        return shingle_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]

    own = members(texts[nodes.index(hub)])
    linked = []
    for node, z in dict(zip(nodes, texts, strict=True)).items():
        if node != hub:
            other = members(z)
            both = len(np.intersect1d(own, other, assume_unique=True))
            if similar(both, len(own), len(other)):
                linked.append(node)
    return pa.table({"u": pa.array([hub] * len(linked), pa.int64()), "v": pa.array(linked, pa.int64())})


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs whose sets are similar; a hub with many partners is split into blocks."""
    size = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(size, "a").withColumn("salt", F.expr(f"cast(pmod(xxhash64(b), (n + {HUB_BLOCK - 1}) div {HUB_BLOCK}) as int)"))
    wanted = dealt.select("a", "salt", "b").unionByName(
        size.select("a", F.explode(F.expr(f"sequence(0, cast((n + {HUB_BLOCK - 1}) div {HUB_BLOCK} as int) - 1)")).alias("salt"), F.col("a").alias("b"))
    )
    wanted = saved(wanted, "wanted")
    return wanted.join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "z").groupBy("a", "salt").applyInArrow(_verify, "u long, v long")


def _near(sketches: list[bytes], size: np.ndarray, component: np.ndarray, side: np.ndarray | None, narrower: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the pairs of different components that sketches do not exclude, the nearest first.

    ``side`` tells the two blocks of a group apart, whose pairs within a block are looked at elsewhere. A first look at
    sketches folded to ``narrower`` ones excludes most pairs for a fraction of the words.
    """
    width = np.array([len(z) for z in sketches])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for w in np.unique(width):
        # Each width with itself and the double, folded to it: similar sizes are at most one width apart.
        for v in (w, 2 * w):
            i, j = np.flatnonzero(width == w), np.flatnonzero(width == v)
            if not len(i) or not len(j):
                continue
            p, q = (np.stack([np.frombuffer(sketches[k], np.uint8) for k in part]) for part in (i, j))
            q = _folded(q, w)
            keep = component[i][:, None] != component[j][None, :]
            if v == w:
                keep &= i[:, None] < j[None, :]
            if side is not None:
                keep &= side[i][:, None] != side[j][None, :]
            narrow = max(8, w // narrower)
            keep &= may_link(size[i][:, None], size[j][None, :], _distance(_folded(p, narrow), _folded(q, narrow)))
            k, m = np.nonzero(keep)
            wide_p, wide_q = (np.ascontiguousarray(x).view(U64) for x in (p, q))
            distance = np.zeros(len(k), np.int64)
            for at in range(0, len(k), 8192):
                part = slice(at, at + 8192)
                distance[part] = np.bitwise_count(wide_p[k[part]] ^ wide_q[m[part]]).sum(axis=1)
            near = may_link(size[i[k]], size[j[m]], distance)
            found.append((i[k][near], j[m][near], distance[near]))
    left, right, distance = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.argsort(distance, kind="stable")
    return left[order], right[order], distance[order]


def _spanning(left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Places of pairs, given the nearest first, that join each component to its nearest other one."""
    across = np.flatnonzero(label[left] != label[right])
    ends, places = np.concatenate([label[left[across]], label[right[across]]]), np.concatenate([across, across])
    order = np.lexsort((places, ends))
    first = np.concatenate([[True], ends[order][1:] != ends[order][:-1]]) if len(order) else np.zeros(0, bool)
    return np.unique(places[order][first])


def _joined(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labels after joining pairs one by one, and which pairs joined two components."""
    values, dense = np.unique(label, return_inverse=True)
    parent = list(range(len(values)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    fresh = np.zeros(len(left), bool)
    for n, (a, b) in enumerate(zip(dense[left].tolist(), dense[right].tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            fresh[n] = True
    return np.array([root(k) for k in range(len(values))], np.int64)[dense], fresh


def _groups(table: pa.Table) -> Iterator[tuple[np.ndarray, bool]]:
    """The rows of each group of a cell, and whether it is one of two blocks."""
    bucket, x, y = (table.column(c).to_numpy() for c in ("bucket", "x", "y"))
    order, new = groups_of(bucket, x, y)
    cuts = np.append(np.flatnonzero(new), len(order))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield order[a:b], bool(x[order[a]] != y[order[a]])


def _pairs_in(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each group of a cell: its rows, and the pairs of :func:`_near` as places among them."""
    side, size, component = (table.column(c).to_numpy() for c in ("side", "size", "component"))
    raw = table.column("sketch").combine_chunks()
    for rows, two in _groups(table):
        left, right, _ = _near([raw[int(k)].as_py() for k in rows], size[rows], component[rows], side[rows] if two else None)
        if len(left):
            yield rows, left, right


def _undecided(table: pa.Table) -> pa.Table:
    """The documents of each group that have a possible partner in another component."""
    chosen = [np.zeros(0, np.int64)]
    for rows, left, right in _pairs_in(table):
        chosen.append(rows[np.unique(np.concatenate([left, right]))])
    return table.select(["bucket", "x", "y", "side", "node", "component"]).take(pa.array(np.concatenate(chosen)))


_UNDECIDED = "bucket long, x long, y long, side long, node long, component long"


def _settle(table: pa.Table) -> pa.Table:
    """Links that join components of a group, verified on the sets, the nearest pairs first."""
    unpack = zstandard.ZstdDecompressor()
    node, component, side = (table.column(c).to_numpy() for c in ("node", "component", "side"))
    raw = table.column("z").combine_chunks()
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, two in _groups(table):
        sets = []
        for k in rows:
            data = unpack.decompress(raw[int(k)].as_py())
            sets.append(shingle_sets(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])
        size = np.array([len(x) for x in sets])
        label = component[rows]
        left, right, _ = _near([sketch(x, _FINE) for x in sets], size, label, side[rows] if two else None, _FINE)
        while len(places := _spanning(left, right, label)):
            both = [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left[places].tolist(), right[places].tolist(), strict=True)]
            linked = np.array([similar(n, size[a], size[b]) for n, a, b in zip(both, left[places], right[places], strict=True)], bool)
            good = places[linked]
            label, fresh = _joined(label, left[good], right[good])
            u.append(node[rows[left[good[fresh]]]])
            v.append(node[rows[right[good[fresh]]]])
            # What was looked at is done with, whatever came of it.
            rest = np.ones(len(left), bool)
            rest[places] = False
            left, right = left[rest], right[rest]
    return pa.table({"u": np.concatenate(u).astype(np.int64), "v": np.concatenate(v).astype(np.int64)})


def _open_groups(shared: DataFrame, parts: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """The documents of signatures that span several components, in groups of bounded size; None if there are none."""
    placed = shared.join(parts, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    # Many signatures have the very same documents: one of those is enough.
    open_ = saved(
        placed.groupBy("bucket")
        .agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("h1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("h2"),
        )
        .where("low != high")
        .groupBy("n", "h1", "h2")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "n", F.expr(f"(n + {BLOCK // 2 - 1}) div {BLOCK // 2}").alias("blocks")),
        "open",
    )
    compared = open_.agg(F.sum(F.expr("n * blocks"))).first()[0]
    if not compared:
        return None
    # A large group is cut into blocks, and each pair of blocks is a group of bounded size.
    return (
        placed.join(open_, "bucket")
        .join(nodes.select("node", "size", "sketch"), "node")
        .withColumn("side", F.expr("pmod(xxhash64(node), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("bucket", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "node", "component", "size", "sketch")
        .withColumn("cell", F.pmod(F.xxhash64("bucket", "x", "y"), F.lit(1 + int(compared) // CELL_ROWS)))
    )


def _settled(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """The links that still join components, each group with the sets of its undecided documents."""
    undecided = saved(open_.groupBy("cell").applyInArrow(released_group(_undecided), _UNDECIDED), "undecided")
    sizes = texts.select("node", F.octet_length("z").alias("n"))
    total = undecided.join(sizes, "node").agg(F.sum("n")).first()[0] or 0
    cell = F.pmod(F.xxhash64("bucket", "x", "y"), F.lit(1 + int(total) // CELL_BYTES))
    return undecided.withColumn("cell", cell).join(texts, "node").groupBy("cell").applyInArrow(released_group(_settle), "u long, v long")


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in steps(batches):
        z = [pack.compress(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("check"), pa.array(z, pa.binary())], names=["doc_id", "check", "z"])


_NO_ID = -(2**63)


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, check, size, component, smallest) of every row: the node of its component, null without words, and the component's id."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).withColumn("check", F.xxhash64("text"))
    # About one signature for two words of six bytes.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = part_bits(total / 10, PART)
    common = docs.sparkSession.sparkContext.broadcast(how_common(rows))
    found = saved(rows.mapInArrow(released(_sign(bits, common)), _PASS).groupBy("part").applyInArrow(released_group(_look_through), _FOUND), "signatures")
    members = found.where(F.col("kind") == _MEMBER)
    # Equal sets of different runs become one node.
    nodes = saved(
        members.where("sketch is not null")
        .groupBy("digest")
        .agg(F.min_by(F.struct("a", "doc_id", "check", "size", "sketch"), "a").alias("r"))
        .select("digest", F.col("r.a").alias("node"), "r.doc_id", "r.check", "r.size", "r.sketch"),
        "nodes",
    )
    names = saved(
        members.where("sketch is not null").select("digest", F.col("a").alias("alias"))
        .join(nodes.select("digest", "node"), "digest").select("alias", "node"), "names",
    )

    def named(df: DataFrame, column: str) -> DataFrame:
        return df.join(names.toDF(column, f"_{column}"), column).drop(column).withColumnRenamed(f"_{column}", column)

    pairs = named(named(found.where(F.col("kind") == _PAIR).select("a", "b").distinct(), "a"), "b")
    pairs = pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = saved(_bounded(pairs, nodes), "pairs")
    # Equal sets of several runs are one node now, and count once in a signature.
    shared = saved(
        named(found.where(F.col("kind") == _BUCKET).select(F.col("a").alias("bucket"), F.explode("members").alias("node")), "node").distinct(),
        "shared",
    )
    # One text for each node that has a candidate, whatever the number of its copies; written once. Copies of a row
    # are combined before the shuffle, and the join reads what that has brought together.
    asked = first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node"))).unionByName(shared.select("node")).distinct()
    chosen = nodes.join(asked, "node", "left_semi").select("node", "doc_id", "check")
    packed = rows.mapInArrow(released(_compressed), "doc_id long, check long, z binary").groupBy("doc_id", "check").agg(F.first("z").alias("z"))
    texts = saved(packed.join(chosen, ["doc_id", "check"]).select("node", "z"), "texts")
    links = saved(_linked(first, texts), "links")
    parts = saved(components(links), "components")
    open_ = _open_groups(shared, parts, nodes)
    if open_ is not None:
        links = links.unionByName(saved(_settled(open_, texts), "links"))
        parts = saved(components(links), "components")

    known = members.join(nodes.select("digest", "node"), "digest", "left").join(parts, "node", "left")
    known = known.select("doc_id", "check", "size", "node", F.coalesce("component", "node").alias("component"))
    smallest = known.where("component is not null").groupBy("component").agg(
        F.coalesce(F.min(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id"))), F.lit(_NO_ID)).alias("smallest")
    )
    return known.join(smallest, "component", "left")


def join(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: (doc_id, check, n_shingles, component_id); ``check`` is a hash of the text.

    Rows without words have no shingles and are linked with nothing: their component is their own id. Fewer than
    five words are one shingle. Equal sets are linked. Repeated rows are rows of their own with the same result; the
    smallest id counts, and null ids only where there is no other. Other columns are ignored; an empty table gives
    no rows. Shingles and sets are compared by 64-bit and 128-bit hashes.
    """
    answer = _grouped(docs)
    own = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return answer.select(
        own("doc_id").alias("doc_id"), "check", F.col("size").cast("long").alias("n_shingles"),
        F.coalesce(own("smallest"), own("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id, with all its columns, whatever they are called.

    Null ids count only where there is no other; of different texts of one id the one of the smallest hash stays, and
    of repeated rows one. Rows without words stay.
    """
    rows = _grouped(docs)
    first = F.min(F.struct(F.col("doc_id") == _NO_ID, "doc_id", "check")).alias("r")
    kept = rows.where("size > 0").groupBy("component").agg(first).select("r.doc_id", "r.check", F.lit(False).alias("wordless"))
    kept = kept.unionByName(rows.where("size = 0").select("doc_id", "check", F.lit(True).alias("wordless")).distinct())
    marked = docs.select(
        whole_row(docs),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("check"),
    )
    matched = marked.join(kept, ["doc_id", "check"])
    wordless = matched.where("wordless").select("row.*")
    # Any of several rows of one id and text: they may differ in their other columns only.
    return wordless.unionByName(matched.where("not wordless").dropDuplicates(["doc_id", "check"]).select("row.*"))


#: The same in SQL.
SQL = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS place, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT place, array_to_string(w[k : k + 4], ' ') AS shingle
    FROM (SELECT place, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT place, count(*) AS n FROM shingles GROUP BY place
), shared AS (
    SELECT a.place AS a, b.place AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle) WHERE a.place <> b.place GROUP BY ALL
), links AS (
    SELECT s.a, s.b FROM shared s JOIN sizes x ON x.place = s.a JOIN sizes y ON y.place = s.b WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
), reached(a, b) AS (
    SELECT place, place FROM words
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM words w LEFT JOIN sizes USING (place) JOIN reached r ON r.a = w.place JOIN words o ON o.place = r.b
GROUP BY w.place, w.doc_id
"""
