"""The trie of shared conversation beginnings, with totals of every subtree by parallel tree contraction.

A node is a distinct sequence of first turns. Its identity is a chained digest: that of its parent and of its
last turn, so turns are read once, in order, and texts go no further than the first pass. What a node has of
its own (conversations through it, bytes, children, conversations that end in it) are plain aggregates.

Totals over subtrees come from contraction. Each round rakes (leaves give their value to their parent and go)
and compresses (in chains of nodes with one child, nodes with a coin of 1 below a parent with a coin of 0 go;
their child moves up and carries their value on its edge). Both are joins on all nodes at once; a chain of n
turns and a bushy tree take O(log n) rounds. Then the rounds are undone from the last to the first: a node
that was compressed has its own value plus the total of the child that took its place.

No group is collected: beginnings that countless conversations share are counted with partial aggregation,
and the ids of conversations that end together are joined in blocks of 1024 before one stream hashes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_BITS = 10  # 1024 neighbouring conversation ids are joined before they are hashed
NO_TEXT = hashlib.sha256(b"").hexdigest()
ROOT = b""


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn_digest, n_bytes): the turns of each conversation from 1 on, by turn (null first), then
    role and text. Null role or text is empty. Rows without conv_id belong to no conversation and are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length("role"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32))
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("position"), digest.alias("turn_digest"),
                       F.octet_length("text").cast("long").alias("n_bytes"))


def beginnings(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, n_bytes, is_last) for each turn: digests of the sequences up to it and before it.

    Turns stream through in order, so a long conversation takes no more memory than a short one."""
    schema = "conv_id long, depth long, node binary, parent binary, n_bytes long, is_last boolean"
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    names = ["conv_id", "depth", "node", "parent", "n_bytes", "is_last"]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, until it is known whether its conversation goes on
        for batch in batches:
            rows = []
            for conv, digest, n_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                goes_on = held is not None and held[0] == conv
                if held is not None:
                    rows.append((*held, not goes_on))
                depth, parent = (held[1], held[2]) if goes_on else (0, ROOT)
                held = (conv, depth + 1, hashlib.blake2b(parent + digest, digest_size=16).digest(), parent, n_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*held, True), kinds, strict=True)], names)

    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "turn_digest", "n_bytes")
    return rows.mapInArrow(chain, schema)


def id_hashes(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): SHA-256 of the ids in ascending order, comma-joined."""
    blocks = ends.groupBy("node", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
    blocks = blocks.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node", "ends_sha256"])

    ordered = blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "ids")
    return ordered.mapInArrow(stream, "node binary, ends_sha256 string")


def _coin(node: str, salt: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(F.col(node), F.lit(salt)), 7), F.lit(2))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values): sums of the values over each node's subtree, itself included.

    ``tree`` has node (long), parent (null: a root) and the values (long, not null); several roots are several
    trees, an empty tree gives an empty result. The nodes must form trees.
    """
    carried = [f"edge_{v}" for v in values]
    active = tree.select("node", "parent", *values, *(F.lit(0).cast("long").alias(c) for c in carried))
    active, raked, spliced, salt = cut(active), [], [], 0
    while not active.isEmpty():
        salt += 1
        kids = active.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("kids"))
        state = cut(active.join(kids, F.col("node") == F.col("of"), "left").drop("of").fillna(0, ["kids"]))
        # Rake: leaves are final and add to their parents.
        leaves = state.filter("kids = 0")
        raked.append(leaves.select("node", *values))
        gain = leaves.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("of"))
        gain = gain.agg(F.count(F.lit(1)).alias("gone"), *(F.sum(F.col(v) + F.col(c)).alias(f"gain_{v}") for v, c in zip(values, carried, strict=True)))
        rest = state.filter("kids > 0").join(gain, F.col("node") == F.col("of"), "left")
        rest = rest.select("node", "parent", (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"), *carried,
                           *((F.col(v) + F.coalesce(f"gain_{v}", F.lit(0))).alias(v) for v in values))
        # Compress: no two neighbours in a chain go at once.
        goes = F.col("parent").isNotNull() & (F.col("kids") == 1) & (_coin("node", salt) == 1) & (_coin("parent", salt) == 0)
        rest = rest.withColumn("goes", F.coalesce(goes, F.lit(False)))
        out = rest.filter("goes").select(F.col("node").alias("middle"), F.col("parent").alias("above"),
                                         *(F.col(v).alias(f"middle_{v}") for v in values), *(F.col(c).alias(f"middle_{c}") for c in carried))
        moved = cut(rest.filter("NOT goes").join(out, F.col("parent") == F.col("middle"), "left"))
        # A compressed node's total: its own, what lay on the edge below it, and the total of the child.
        through = [(F.col(f"middle_{v}") + F.col(c)).alias(v) for v, c in zip(values, carried, strict=True)]
        spliced.append(moved.filter("middle IS NOT NULL").select(F.col("middle").alias("node"), F.col("node").alias("child"), *through))
        active = moved.select("node", F.when(F.col("middle").isNull(), F.col("parent")).otherwise(F.col("above")).alias("parent"), *values,
                              *((F.col(c) + F.coalesce(F.col(f"middle_{v}") + F.col(f"middle_{c}"), F.lit(0))).alias(c) for v, c in zip(values, carried, strict=True)))
    totals = tree.select("node", *values).limit(0)
    for part in raked:
        totals = totals.union(part)
    for part in reversed(spliced):
        if not part.isEmpty():
            below = totals.select(F.col("node").alias("at"), *(F.col(v).alias(f"below_{v}") for v in values))
            found = part.join(below, F.col("child") == F.col("at")).select("node", *((F.col(v) + F.col(f"below_{v}")).alias(v) for v in values))
            totals = totals.union(cut(found))
    return totals


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the conversations in ``conversations`` (conv_id), whose turns are ``turns`` as from ``numbered``.

    Columns: conv_id (smallest conversation through the node), depth, parent_conv_id (that of the parent; root: null),
    n_convs, n_children, n_leaves (nodes without children in the subtree), saved_tokens (bytes of last texts that are
    stored once instead of n_convs times, over the subtree), ends_sha256 (of the ids of conversations that end here).
    Conversations without turns pass through and end in the root (depth 0). Without conversations there are no nodes.
    Positions order the turns of a conversation; equal conversations share all nodes.
    """
    convs = cut(conversations.select("conv_id").distinct())
    paths = cut(beginnings(turns))
    nodes = paths.groupBy("node", "parent", "depth", "n_bytes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
                       F.lit(0).cast("long").alias("n_bytes"), "conv_id", "n_convs")
    nodes = cut(nodes.unionByName(root).withColumn("number", F.monotonically_increasing_id()))
    parents = nodes.select(F.col("node").alias("parent"), F.col("number").alias("parent_number"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(parents, "parent", "left")
    children = nodes.filter("parent_number IS NOT NULL").groupBy(F.col("parent_number").alias("number")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, "number", "left").fillna(0, ["n_children"]))
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    totals = subtree_totals(nodes.select(F.col("number").alias("node"), F.col("parent_number").alias("parent"),
                                         (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved_tokens")),
                            ["n_leaves", "saved_tokens"]).withColumnRenamed("node", "number")
    lasts = paths.filter("is_last").select("conv_id", "node")
    ends = convs.join(lasts, "conv_id", "left").select(F.coalesce("node", F.lit(ROOT)).alias("node"), "conv_id")
    found = nodes.join(totals, "number").join(id_hashes(ends), "node", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(NO_TEXT)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table (conv_id, turn, role, text) as it stands; see ``numbered`` and ``trie``."""
    return trie(numbered(conversations), conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")))


def with_shared_beginnings(turns: DataFrame, heads: DataFrame, most: int) -> DataFrame:
    """Each conversation rebuilt: the first turns of another one, then its own from there on.

    ``heads`` has conv_id, base and shared (at most ``most``): the first ``shared`` turns come from conversation ``base``
    (all if it has fewer, none if it is absent) and replace as many own turns. ``turns`` are as from ``numbered``.
    """
    first = turns.filter(F.col("position") <= most).withColumnRenamed("conv_id", "base")
    lead = heads.join(first, "base").filter("position <= shared")
    own = turns.join(heads, "conv_id").filter("position > shared")
    columns = ("conv_id", "position", "turn_digest", "n_bytes")
    return lead.select(*columns).union(own.select(*columns))
