"""Prefix trie of conversations: one row a distinct prefix, with sums over its subtree.

A prefix is named by a chained digest of its turns. The rows of all prefixes are added up
by digest, which gives each node its members. Sums over subtrees are made in shards: a
shard gives its nodes slots by a minimal perfect hash, keeps the digests at their slots to
verify every lookup, scatters the counts into flat arrays, and adds them up through the
array of parent slots, the deepest nodes first.

A shard is a whole subtree. Every node carries labels of its ancestors in the depths
`CUTS`; it goes with the first of them whose subtree has at most `SHARD_NODES` nodes, so a
first turn that most conversations share is cut further down. What is left above the cuts
is the crown: at most depth x nodes / `SHARD_NODES` of them in the depths up to 16, which
one more shard adds up from the sums of the subtrees below. Labels of subtrees too large
are broadcast and have the same bound.

The digest of all conversations that end in a node is made from pieces: ids are sorted by
range and joined to pieces of text in all tasks, and only the pieces of a node are hashed
in order by one task.

Turns of a conversation are walked in order by one task that holds one batch and the first
turns of the conversation; texts themselves are not shuffled, only their digests. Two
different prefixes with one digest would be found, and are an error.

Defined results: a null role or text is empty; turns of equal number stand in order of
role, then of the digest of the text, a null number first; a null id is a conversation of
its own that borrows no turns, never the smallest member while another is there, and is
not named in digests; rows that repeat are turns of their own; an empty table gives no
rows, not even a root. The operator runs jobs when called and writes to the shared folder.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.perfect_hash import PerfectHash
from reviewlens.sources.staging import stage

ROOT = bytes(16)
SHARD_NODES = 1_000_000
#: Depths in which the trie can be cut.
CUTS = (*range(1, 17), *(1 << k for k in range(5, 31)))
# The label of nodes in the crown.
CROWN = 0
# Ids are joined to pieces of about this many, and rows handed on this many at once.
IDS_AT_ONCE = 50_000
ROWS_AT_ONCE = 8192
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_WALKED = "conv_id bigint, depth bigint, digest binary, parent binary, turn_digest binary, bytes bigint, ends boolean, cuts array<bigint>"


def borrowed_turns(conv_id: int | None, most: int) -> int:
    """How many of its first turns a conversation takes from the first of its group."""
    return 0 if conv_id is None else zlib.crc32(str(conv_id).encode()) % most


def turns(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, turn_digest, bytes) of every row; no text is left."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    # The length of the role keeps role and text apart.
    said = F.concat(F.length(value(role)).cast("string"), F.lit(":"), value(role), value(text))
    return conversations.select(
        F.col(key).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), value(role).alias("role"),
        F.unhex(F.sha2(said, 256)).alias("turn_digest"),
        F.octet_length(value(text)).cast("bigint").alias("bytes"),
    )


class _Rows:
    """Rows of one schema, handed on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        if len(self.rows) >= ROWS_AT_ONCE:
            yield self.rest()

    def rest(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def prefixes(said: DataFrame, group: int = 0, most: int = 1) -> DataFrame:
    """One row for every prefix of every conversation in ``said`` (see `turns`).

    (conv_id, depth, digest, parent, turn_digest, bytes, ends, cuts); ``ends`` marks the
    whole conversation, ``cuts`` are the labels of the ancestors (itself included) in the
    depths CUTS. With ``group``, conversation c is rebuilt first: its first h turns are
    those of conversation c - c % group, all if that has fewer and none if it is absent,
    with h = crc32 of c % ``most``; its own turns after its first h follow.
    """
    first = F.col("conv_id") - F.col("conv_id") % group if group else F.col("conv_id")
    rows = said.select(first.alias("first"), *said.columns)
    in_order = ["first", F.col("conv_id") != F.col("first"), "conv_id", "turn", "role", "turn_digest"]
    # A group of conversations stands together, the one that lends its turns in front.
    ordered = rows.repartition("first").sortWithinPartitions(*in_order)
    cut_depths = frozenset(CUTS)
    schema = pa.schema([
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.binary()), ("parent", pa.binary()),
        ("turn_digest", pa.binary()), ("bytes", pa.int64()), ("ends", pa.bool_()), ("cuts", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        lender, lent = object(), []
        conv, place, skip, last = object(), 0, 0, None

        def grow(node, turn_digest, size):
            """The prefix one turn longer than ``node`` (conv, depth, digest, …)."""
            depth, digest = node[1] + 1, hashlib.sha256(node[2] + turn_digest).digest()[:16]
            cuts = node[7]
            if depth in cut_depths:
                # Never the label of the crown.
                cuts = [*cuts, int.from_bytes(digest[:8], "little", signed=True) or 1]
            return (node[0], depth, digest, node[2], turn_digest, size, False, cuts)

        for first, conv_id, turn_digest, size in _rows_of(batches):
            if conv_id != conv:
                if last is not None:
                    yield from out.add(*last[:6], True, last[7])
                if first != lender:
                    lender, lent = first, []
                conv, place = conv_id, 0
                borrows = bool(group) and conv_id is not None and conv_id != first
                skip = borrowed_turns(conv_id, most) if borrows else 0
                last = (conv_id, 0, ROOT, None, None, 0, False, [])
                for turn in lent[:skip]:
                    yield from out.add(*last)
                    last = grow(last, *turn)
            if conv_id == first and len(lent) < most:
                lent.append((turn_digest, size))
            if place >= skip:
                yield from out.add(*last)
                last = grow(last, turn_digest, size)
            place += 1
        if last is not None:
            yield from out.add(*last[:6], True, last[7])
        yield out.rest()

    return ordered.select("first", "conv_id", "turn_digest", "bytes").mapInArrow(run, _WALKED)


def nodes(walked: DataFrame) -> DataFrame:
    """One row a distinct prefix: (digest, parent, depth, bytes, conv_id, n_convs, cuts).

    Written to the shared folder. Members of a node must agree in all that makes a prefix.
    """
    same = F.struct("depth", "parent", "turn_digest", "bytes")
    found = walked.groupBy("digest").agg(
        F.min(same).alias("low"), F.max(same).alias("high"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.min("cuts").alias("cuts"),
    )
    kept = stage(
        found.select(
            "digest", "low.parent", "low.depth", "low.bytes", "conv_id", "n_convs", "cuts",
            (~F.col("low").eqNullSafe(F.col("high"))).alias("clash"),
        ),
        "nodes",
    )
    if not kept.where("clash").isEmpty():
        raise ValueError("two prefixes of conversations have one digest")
    return kept.drop("clash")


def _shard(found: DataFrame, shard_nodes: int) -> DataFrame:
    """``found`` with the label of its subtree, CROWN for nodes above all cuts."""
    sizes = found.select(F.explode("cuts").alias("cut")).groupBy("cut").agg(F.count("*").alias("n"))
    large = {r["cut"] for r in sizes.where(F.col("n") > shard_nodes).select("cut").collect()}
    shared = found.sparkSession.sparkContext.broadcast(large)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [next((c for c in cuts if c not in shared.value), CROWN) for cuts in batch.column(6).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(labels, pa.int64())], names=names)

    names = [*found.columns[:6], "shard"]
    kinds = "digest binary, parent binary, depth bigint, bytes bigint, conv_id bigint, n_convs bigint, shard bigint"
    return found.mapInArrow(run, kinds)


_SUMMED = (
    "digest binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, "
    "parent_conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, inside boolean"
)


def _digests(column: pa.Array) -> np.ndarray:
    """Digests of 16 bytes as rows of two numbers; null (above the root) as zeros."""
    flat = b"".join(d if d is not None else ROOT for d in column.to_pylist())
    return np.frombuffer(flat, np.uint64).reshape(-1, 2)


def add_up(table: pa.Table) -> pa.RecordBatch:
    """Sums over the subtrees of whole shards.

    ``table`` has the columns of `_shard`, and children, leaves and saved: what subtrees
    in other shards add to a node. ``inside`` says whether the parent is in the table.
    """
    number = lambda name: table.column(name).to_numpy()
    column = lambda name: table.column(name).combine_chunks()
    n = table.num_rows
    keys = _digests(column("digest"))
    hashed = PerfectHash(keys)
    slot = hashed.find(keys)
    has_parent = column("parent").is_valid().to_numpy(zero_copy_only=False)
    above = np.where(has_parent, hashed.find(_digests(column("parent"))), -1)
    depth, children, leaves, saved, parent = (np.zeros(n, np.int64) for _ in range(5))
    depth[slot] = number("depth")
    np.add.at(children, above[above >= 0], 1)
    children[slot] += number("children")
    childless = children == 0
    leaves[slot] = number("leaves")
    leaves[childless] += 1
    saved[slot] = number("saved") + (number("n_convs") - 1) * number("bytes")
    parent[slot] = above
    order = np.argsort(-depth, kind="stable")
    borders = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, borders):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    smallest, known = np.zeros(n, np.int64), np.zeros(n, bool)
    known[slot] = column("conv_id").is_valid().to_numpy(zero_copy_only=False)
    smallest[slot] = column("conv_id").fill_null(0).to_numpy(zero_copy_only=False)
    named = np.where(above >= 0, known[above], False)
    parent_ids = pa.array(np.where(named, smallest[above], 0), mask=~named)
    return pa.RecordBatch.from_arrays(
        [
            *(column(c) for c in ("digest", "parent", "depth", "conv_id", "n_convs")), parent_ids,
            *(pa.array(x[slot]) for x in (children, leaves, saved)), pa.array(above >= 0),
        ],
        names=["digest", "parent", "depth", "conv_id", "n_convs", "parent_conv_id", "n_children", "n_leaves", "saved_tokens", "inside"],
    )


def _summed(sharded: DataFrame, at_once: int) -> DataFrame:
    """`add_up` over rows that stand sorted by shard; several small shards go together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, last = 0, None
        for batch in batches:
            labels = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            starts = np.flatnonzero(np.diff(labels)) + 1
            first = 0
            for end in (*starts.tolist(), batch.num_rows):
                if rows >= at_once and labels[first] != last:
                    yield add_up(pa.Table.from_batches(held))
                    held, rows = [], 0
                held.append(batch.slice(first, end - first))
                rows, last, first = rows + end - first, labels[end - 1], end
        if held:
            yield add_up(pa.Table.from_batches(held))

    return sharded.mapInArrow(run, _SUMMED)


def subtree_sums(found: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The columns of `_SUMMED` for every node of `nodes`."""
    sharded = stage(_shard(found, shard_nodes), "sharded")
    nothing = [F.lit(0).cast("bigint").alias(c) for c in ("children", "leaves", "saved")]
    light = sharded.where(F.col("shard") != CROWN).repartition("shard").sortWithinPartitions("shard")
    below = stage(_summed(light.select("*", *nothing), shard_nodes), "subtrees")
    # What the cut subtrees of a crown node add up to.
    given = below.where("not inside").groupBy("parent").agg(
        F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    ).withColumnRenamed("parent", "digest")
    crown = sharded.where(F.col("shard") == CROWN).join(given, "digest", "left")
    crown = crown.select(*sharded.columns, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("children", "leaves", "saved")))
    top = stage(_summed(crown.repartition(1), shard_nodes), "crown")
    owners = top.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above_id"))
    # The crown is small: see the bound above.
    cut = below.where("not inside").join(F.broadcast(owners), "parent").withColumn("parent_conv_id", F.col("above_id"))
    return below.where("inside").unionByName(cut.select(*below.columns)).unionByName(top)


def end_digests(walked: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the nodes in which conversations end.

    Ids are sorted by range, so a node that holds most of them is dealt over many tasks.
    """
    ends = walked.where(F.col("ends") & F.col("conv_id").isNotNull()).select("digest", "conv_id")
    ranged = ends.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    piece_schema = pa.schema([("digest", pa.binary()), ("first_id", pa.int64()), ("piece", pa.string())])
    hash_schema = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(piece_schema)
        last, ids = None, []
        for digest, conv_id in _rows_of(batches):
            if ids and (digest != last or len(ids) >= IDS_AT_ONCE):
                yield from out.add(last, ids[0], ",".join(map(str, ids)))
                ids = []
            last = digest
            ids.append(conv_id)
        if ids:
            yield from out.add(last, ids[0], ",".join(map(str, ids)))
        yield out.rest()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(hash_schema)
        last, state = None, None
        for digest, _, piece in _rows_of(batches):
            if digest != last:
                if state is not None:
                    yield from out.add(last, state.hexdigest())
                last, state = digest, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if state is not None:
            yield from out.add(last, state.hexdigest())
        yield out.rest()

    joined = ranged.mapInArrow(pieces, "digest binary, first_id bigint, piece string")
    ordered = joined.repartition("digest").sortWithinPartitions("digest", "first_id")
    return ordered.mapInArrow(hashes, "digest binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    group: int = 0,
    most: int = 1,
    shard_nodes: int = SHARD_NODES,
) -> DataFrame:
    """One row for every distinct prefix of the conversations, the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): the smallest member, the number of turns, the parent's smallest member,
    members, children, childless nodes in the subtree, bytes that the subtree's shared
    prefixes save (a node's members but one, times the bytes of its last text), and the
    digest of the ids of the members that end here. ``group`` and ``most`` rebuild the
    conversations as `prefixes` says.
    """
    walked = stage(prefixes(turns(conversations, key, turn, role, text), group, most), "prefixes")
    sums = subtree_sums(nodes(walked), shard_nodes)
    counts = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    digest: Column = F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    return sums.join(end_digests(walked), "digest", "left").select("conv_id", "depth", "parent_conv_id", *counts, digest)
