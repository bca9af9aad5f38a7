"""The prefix trie of conversations, measured along its Euler tour.

A node is a distinct sequence of first turns. It has an arc that enters it and one that leaves it, and the arcs in the
order of a depth-first walk are a linked list: the tour. The list is ranked by contraction. In every round the arcs
whose hash is smaller than those of both neighbours leave the list, a third of them, each remembering its place behind
its neighbour; a short rest is ranked at once, and the arcs come back in the reverse order. With the arcs at their
places, running sums of leaves and savings along the tour give every subtree as a difference, from enter to exit.

Work and shuffles are in proportion to the turns and nodes. A conversation or a node may hold any share of them:
turns, siblings and members are numbered by ranges of rows, not by groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved, small_batches
from millrace.llm.scans import running

#: A conversation borrows its first turns, fewer than this, from the first conversation of its family.
BORROWED = 9
FAMILY = 5
#: Arcs that are ranked at once, on the driver, when contraction has left no more.
RANKED_AT_ONCE = 1 << 14

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, digest, n_bytes): turns from 0 in order; equal turn numbers by role, then text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))))
    rows = rows.withColumns({"n_bytes": F.octet_length("text").cast("long"), "one": F.lit(1).cast("long")})
    numbered = running(rows, ["turn", "role", "text"], sums=["one"], key="conv_id", drop=["turn", "role", "text"])
    return numbered.select("conv_id", F.col("one_before").alias("at"), "digest", "n_bytes")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations, (conv_id, length), and their turns, (conv_id, at, digest, n_bytes)."""
    turns = saved(numbered_turns(conversations), "turns")
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    own = saved(own.select("conv_id", "n", F.coalesce(head, F.lit(0)).alias("head"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("source")), "conversations")
    sources = own.select(F.col("conv_id").alias("source"), F.col("n").alias("have"))
    plan = own.join(sources, "source", "left").select(
        "conv_id", "source", "head", F.least("head", F.coalesce("have", F.lit(0))).alias("taken"), F.greatest(F.col("n") - F.col("head"), F.lit(0)).alias("rest")
    )
    plan = saved(plan, "plan")
    later = turns.withColumnsRenamed({"conv_id": "_conv", "at": "_at"}).join(plan, F.col("_conv").eqNullSafe(F.col("conv_id")))
    later = later.where("_at >= head").select("conv_id", (F.col("_at") - F.col("head") + F.col("taken")).alias("at"), "digest", "n_bytes")
    first = turns.where((F.col("at") < BORROWED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "source")
    first = first.join(plan, "source").where("at < head").select("conv_id", "at", "digest", "n_bytes")
    return plan.select("conv_id", (F.col("taken") + F.col("rest")).alias("length")), later.unionByName(first)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_bytes): the keys of each first sequence and of the one before it.

    A key is 128 bits, the exclusive or of a hash of each turn with its place.
    """
    place = [F.xxhash64(F.lit(seed), F.col("at"), F.col("digest")) for seed in (1, 2)]
    hashed = turns.select("conv_id", "at", "n_bytes", place[0].alias("h1"), place[1].alias("h2"))
    keyed = running(hashed, ["at"], xors=["h1", "h2"], key="conv_id")
    return keyed.select(
        "conv_id",
        (F.col("at") + 1).alias("depth"),
        F.col("h1").bitwiseXOR(F.col("h1_before")).alias("k1"),
        F.col("h2").bitwiseXOR(F.col("h2_before")).alias("k2"),
        F.col("h1_before").alias("p1"),
        F.col("h2_before").alias("p2"),
        "n_bytes",
    )


def _ends(members: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) from (depth, k1, k2, conv_id): the digest of the ids that end at a node.

    The ids are sorted in ranges and joined to runs of text there; the runs of a node then pass one hash in order,
    which never holds more than a batch.
    """
    key = ["depth", "k1", "k2"]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for *node, conv in zip(*(batch.column(c).to_pylist() for c in [*key, "conv_id"]), strict=True):
                if not rows or rows[-1][0] != node:
                    rows.append([node, conv, []])
                rows[-1][2].append(str(conv))
            if rows:
                columns = [*zip(*(node for node, _, _ in rows), strict=True), [first for _, first, _ in rows], [",".join(ids) for _, _, ids in rows]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())], names=[*key, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            for *node, ids in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"]), strict=True):
                if node == now:
                    state.update(b",")
                else:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield _batch(out)
                out = []
        if now is not None:
            yield _batch([(*now, state.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], names=[*key, "ends_sha256"])

    small_batches(members.sparkSession)
    known = members.where("conv_id IS NOT NULL")
    ranged = known.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    texts = ranged.mapInArrow(runs, "depth long, k1 long, k2 long, first long, ids string")
    return texts.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def tree(keyed: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes, numbered so that siblings are neighbours: (g, conv_id, depth, k1, k2, p1, p2, parent_conv_id, n_convs, n_bytes)."""
    nodes = keyed.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("n_bytes"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = saved(nodes.unionByName(root), "nodes")
    # Both sides are read straight from exchanges, so that a node with very many children can be split.
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    above = nodes.join(parents, ["depth", "p1", "p2"], "left").withColumn("one", F.lit(1).cast("long"))
    numbered = running(above, ["depth", "p1", "p2", "conv_id"], sums=["one"]).withColumnRenamed("one_before", "g").drop("one")
    return saved(numbered, "tree")


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with ``n_children``, and the arcs (id, prev, next): node g is entered by 2g and left by 2g + 1."""
    children = nodes.where("depth > 0").groupBy("depth", "p1", "p2").agg(F.min("g").alias("first"), F.max("g").alias("last"), F.count(F.lit(1)).alias("n_children"))
    children = children.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "first", "last", "n_children")
    linked = nodes.join(children, ["depth", "k1", "k2"], "left")
    linked = saved(linked.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "linked")
    none = F.lit(None).cast("long")
    inner = linked.where("n_children > 0")
    above = inner.select(F.col("first").alias("g"), F.col("g").alias("begins"), none.alias("ends"))
    above = above.unionByName(inner.select(F.col("last").alias("g"), none.alias("begins"), F.col("g").alias("ends")))
    above = above.groupBy("g").agg(F.max("begins").alias("begins"), F.max("ends").alias("ends"))
    rows = linked.select("g", "depth", "first", "last").join(above, "g", "left")
    enter, leave = F.col("g") * 2, F.col("g") * 2 + 1
    root = F.col("depth") == 0
    arcs = rows.select(
        F.explode(
            F.array(
                F.struct(
                    enter.alias("id"),
                    F.when(root, none).otherwise(F.coalesce(F.col("begins") * 2, enter - 1)).alias("prev"),
                    F.coalesce(F.col("first") * 2, leave).alias("next"),
                ),
                F.struct(
                    leave.alias("id"),
                    F.coalesce(F.col("last") * 2 + 1, enter).alias("prev"),
                    F.when(root, none).otherwise(F.coalesce(F.col("ends") * 2 + 1, leave + 1)).alias("next"),
                ),
            )
        ).alias("arc")
    ).select("arc.*")
    return linked, arcs


def ranked(arcs: DataFrame, at_once: int = RANKED_AT_ONCE) -> DataFrame:
    """(id, at): the place of every element of a doubly linked list (id, prev, next), from 0.

    No two neighbours leave in one round, and the ends never do; each round is one aggregation by id.
    """
    spark = arcs.sparkSession
    now = saved(arcs.select("id", "prev", "next", F.lit(1).cast("long").alias("gap")), "arcs")
    gone: list[DataFrame] = []
    while now.count() > at_once:
        draw = [F.xxhash64(F.lit(len(gone)), F.col(c)) for c in ("prev", "id", "next")]
        leaves = F.col("prev").isNotNull() & F.col("next").isNotNull() & (draw[1] < draw[0]) & (draw[1] < draw[2])
        left = now.where(leaves)
        none = F.lit(None).cast("long")
        changes = (
            now.where(~leaves).select("id", "prev", "next", "gap", none.alias("new_prev"), none.alias("new_next"))
            .unionByName(left.select(F.col("prev").alias("id"), none.alias("prev"), none.alias("next"), F.lit(0).cast("long").alias("gap"), none.alias("new_prev"), F.col("next").alias("new_next")))
            .unionByName(left.select(F.col("next").alias("id"), none.alias("prev"), none.alias("next"), "gap", F.col("prev").alias("new_prev"), none.alias("new_next")))
        )
        shorter = changes.groupBy("id").agg(
            F.coalesce(F.max("new_prev"), F.max("prev")).alias("prev"), F.coalesce(F.max("new_next"), F.max("next")).alias("next"), F.sum("gap").alias("gap")
        )
        gone.append(left.select("id", "prev", "gap"))
        now = saved(shorter, "arcs")
    # What is left is short, whatever the input's size.
    rest = {r["id"]: (r["prev"], r["next"], r["gap"]) for r in now.collect()}
    at = next((i for i, (prev, _, _) in rest.items() if prev is None), None)
    places, place = [], 0
    while at is not None:
        places.append((at, place))
        at = rest[at][1]
        place += rest[at][2] if at is not None else 0
    known = spark.createDataFrame(places, "id long, at long")
    for left in reversed(gone):
        before = known.select(F.col("id").alias("prev"), F.col("at").alias("_at"))
        back = left.join(before, "prev").select("id", (F.col("_at") + F.col("gap")).alias("at"))
        known = saved(known.unionByName(back), "places")
    return known


def trie(conversations: DataFrame, at_once: int = RANKED_AT_ONCE) -> DataFrame:
    """One row for each node: ``COLUMNS``.

    Turns stand in the order of their number, null first, then of role and text; a null role or text is empty, and a
    repeated row is a further turn. A null conv_id is a conversation of its own: it borrows nothing, counts as a
    member, and has no decimal in any digest; it is the smallest member only where it is the only one. An empty table
    has no nodes. Other columns are ignored.
    """
    whole, turns = rebuilt(conversations)
    whole = saved(whole, "lengths")
    keyed = saved(prefixes(turns), "prefixes")
    nodes, arcs = tour(tree(keyed, whole))
    at = ranked(arcs, at_once)
    # Only entering a node counts; the running sums at its exit hold all that was entered in between.
    value = nodes.select(
        (F.col("g") * 2).alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saving")
    )
    zero = F.lit(0).cast("long")
    steps = at.join(value, "id", "left").select("id", "at", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("saving", zero).alias("saving"))
    sums = running(steps, ["at"], sums=["leaf", "saving"], drop=["at"])
    sign = F.when(F.col("id") % 2 == 1, 1).otherwise(-1)
    below = sums.groupBy(F.shiftright("id", 1).alias("g")).agg(F.sum(F.col("leaf_before") * sign).alias("n_leaves"), F.sum(F.col("saving_before") * sign).alias("saved_tokens"))
    # Conversations end at their last prefix; those without turns at the root.
    lengths = whole.where("length > 0").select(F.col("conv_id").alias("_conv"), F.col("length").alias("depth"))
    last = keyed.join(lengths, F.col("conv_id").eqNullSafe(F.col("_conv")) & (keyed["depth"] == lengths["depth"]), "left_semi")
    members = last.select("depth", "k1", "k2", "conv_id").unionByName(whole.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    out = nodes.join(below, "g").join(_ends(members), ["depth", "k1", "k2"], "left")
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))).select(*COLUMNS)


#: The same in SQL; subtrees by the smallest member of each node below.
SQL = """
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS byte
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations
), own AS (
    SELECT conv_id, n, conv_id - conv_id % 5 AS source, coalesce(xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, byte[(xor(c, b) & 255) + 1])), 4294967295) % 9, 0) AS head
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc
), plan AS (
    SELECT own.*, least(own.head, coalesce(s.n, 0)) AS taken FROM own LEFT JOIN own s ON s.conv_id = own.source
), rebuilt AS (
    SELECT p.conv_id, t.place - p.head + p.taken AS place, role, text FROM turns t JOIN plan p ON t.conv_id IS NOT DISTINCT FROM p.conv_id WHERE t.place >= p.head
    UNION ALL
    SELECT p.conv_id, t.place, role, text FROM turns t JOIN plan p ON t.conv_id = p.source WHERE t.place < p.head
), prefixes AS (
    SELECT conv_id, place + 1 AS depth, strlen(text) AS n_bytes,
        md5(string_agg(md5(length(role) || ':' || role || ':' || text), '') OVER (PARTITION BY conv_id ORDER BY place)) AS node
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM own
), nodes AS (
    SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS saving FROM prefixes GROUP BY depth, node
), lines AS (
    SELECT b.depth, b.node, a.depth AS below, n.conv_id, n.saving
    FROM nodes n JOIN prefixes a ON a.depth = n.depth AND a.node = n.node AND a.conv_id IS NOT DISTINCT FROM n.conv_id
    JOIN prefixes b ON b.conv_id IS NOT DISTINCT FROM n.conv_id AND b.depth <= n.depth
), children AS (
    SELECT depth, node, count(*) AS n_children FROM lines WHERE below = depth + 1 GROUP BY depth, node
), sums AS (
    SELECT l.depth, l.node, sum(l.saving) AS saved_tokens, count(*) FILTER (c.n_children IS NULL) AS n_leaves
    FROM lines l JOIN prefixes e ON e.conv_id IS NOT DISTINCT FROM l.conv_id AND e.depth = l.below LEFT JOIN children c ON c.depth = e.depth AND c.node = e.node
    GROUP BY l.depth, l.node
), ended AS (
    SELECT depth, node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT conv_id, max(depth) AS depth, arg_max(node, depth) AS node FROM prefixes GROUP BY conv_id) GROUP BY depth, node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (depth, node) LEFT JOIN children c USING (depth, node) LEFT JOIN ended e USING (depth, node)
LEFT JOIN (
    SELECT DISTINCT c.depth, c.node, p.conv_id FROM prefixes c JOIN prefixes q ON q.conv_id IS NOT DISTINCT FROM c.conv_id AND q.depth = c.depth - 1
    JOIN nodes p ON p.depth = q.depth AND p.node = q.node
) parent ON parent.depth = n.depth AND parent.node = n.node
"""
