"""N-gram Jaccard join with signature trees, and its connected components.

Sets that reach the similarity share most shingles, hence also some of the rarest ones of
either: every set keeps only as many of its rarest shingles as no similar set can miss.
Which are rare is counted over all documents, so a passage that many texts share ties
nothing together while the rest of a text is its own. Shingles are counted twice: by cells
of their hashes, in a table of fixed size, which tells the third or so of a set that is
dealt out; and these one by one. Sets that share a kept shingle, directly or through
others, form a cluster, and no link leaves a cluster. Clusters are cut into blocks of sets.
Neighbouring blocks meet first; after that a pair of blocks meets only if it holds sets of
different components and its size ranges allow a link. Where blocks meet, signature trees
are traversed in pairs and every candidate left is checked on the sets.

A set is a set of 64-bit shingle hashes. Equal sets are one class from the start. Two
sets that are connected already are not compared again: components are whole, but
their edges are not listed in full.

Defined results: null and empty texts, and texts of blanks, have an empty set and are
linked with nothing; rows that share an id are one document, linked by any of its texts;
a row without id takes the component of its equals that have one, else null; an empty
table gives no rows. The id must be an integer; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from reviewlens.llm.common import ROWS_AT_ONCE, map_texts, narrow, unused
from reviewlens.llm.components import components
from reviewlens.llm.signature_tree import Tree, join_trees
from reviewlens.operators.indexing import contiguous_index
from reviewlens.sources.staging import stage

SHINGLE_WORDS, PERCENT = 3, 90
# Sets of a cluster that meet in one task, and twice that for two blocks of a cluster.
BLOCK_SETS = 1024
REMEMBERED = 300_000
# Shingles in more sets than this are the most frequent class, whatever their number.
HOT_ROWS = 4096
HOT_CLASS = 13
# Shingles are counted in 2 ** CELL_BITS cells, which tasks give in slots.
CELL_BITS, SLOT_CELLS = 20, 1 << 13
# Long numbers of 64 bits in the filter of ids.
FILTER_WORDS = 1 << 18

_K1 = np.uint64(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers word hashes while it lives."""

    def __init__(self, n: int = SHINGLE_WORDS):
        self.n = n
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        return np.unique(self.hashes(text))

    def hashes(self, text: str) -> np.ndarray:
        """A hash for each place of a shingle."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.n:
            # A short text is one shingle, marked by its length.
            short = xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))
            return np.array([short], np.uint64)
        if len(self.words) > REMEMBERED:
            self.words = {}
        known = self.words
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = len(words) - self.n + 1
        mixed = np.zeros(size, np.uint64)
        for i in range(self.n):
            mixed = _scramble((mixed + hashes[i : i + size]) * _K1 + np.uint64(i))
        return mixed


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def cell_counts(rows: DataFrame, n: int) -> np.ndarray:
    """How many shingles of all texts fall into each cell of their hashes.

    The counts only order the shingles of a set, so a task may stop at 255 a cell.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(n), np.zeros(1 << CELL_BITS, np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                for text in batch.column(0).slice(start, ROWS_AT_ONCE).to_pylist():
                    np.add.at(counts, _cells(shingler.hashes(text)), 1)
        slots = np.minimum(counts, 255).astype(np.uint8).reshape(-1, SLOT_CELLS)
        for slot in np.flatnonzero(slots.any(1)).tolist():
            yield _slot(slot, slots[slot])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(slot, np.zeros(SLOT_CELLS, np.uint32))
                sums[slot] += np.frombuffer(cells.as_buffer(), np.uint8)
        for slot, total in sums.items():
            yield _slot(slot, total)

    fields = "slot int, cells binary"
    counts = np.zeros(1 << CELL_BITS, np.uint32).reshape(-1, SLOT_CELLS)
    for r in rows.select("text").mapInArrow(count, fields).repartition("slot").mapInArrow(add, fields).collect():
        counts[r.slot] = np.frombuffer(r.cells, np.uint32)
    return counts.ravel()


def _slot(slot: int, cells: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([slot], pa.int32()), pa.array([cells.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "cells"])


def _shared(sizes, percent: int):
    """Least number of shingles that a set of a size shares with any similar set."""
    return -(-percent * sizes // 100)


def needed(sizes, percent: int):
    """Least number of `set_keys` that a set of a size shares with any similar set."""
    shared = _shared(sizes, percent)
    return shared - shared * 3 // 4


def set_keys(
    shingles: np.ndarray, percent: int = PERCENT, counts: np.ndarray | None = None
) -> np.ndarray:
    """The first shingles of a set by count and hash; similar sets share `needed` of them or more.

    A set of s shingles shares at least o = percent * s / 100, rounded up, with a similar
    one. Leaving the last 3 / 4 of o of either out costs as many shared ones at most, and
    this bound grows with s, so each of two sets may use its own. Any order will do that
    all sets share, so the counts need not be exact.
    """
    size = len(shingles)
    if 100 * size // percent == size:
        return shingles[:0]  # one shingle more or less is too much
    if counts is not None:
        shingles = shingles[np.argsort(counts[_cells(shingles)], kind="stable")]
    return shingles[: size - _shared(size, percent) * 3 // 4]


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def described(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, node, lead, keys) of (doc_id, text) rows.

    A task gives the keys of equal sets once as a rule, so copies do not multiply them.
    ``lead`` is the smallest shingle.
    """
    counts = rows.sparkSession.sparkContext.broadcast(cell_counts(rows, n))

    def make():
        shingler = Shingler(n)
        seen: set[bytes] = set()

        def keys(known: bytes | None, shingles: np.ndarray):
            if known is None or known in seen:
                return None
            if len(seen) > REMEMBERED:
                seen.clear()
            seen.add(known)
            return set_keys(shingles, percent, counts.value).view(np.int64)

        def each(texts: list[str]):
            sets = [shingler(t) for t in texts]
            ids = [set_id(s) if len(s) else None for s in sets]
            return [
                [len(s) for s in sets], ids,
                [int.from_bytes(i[:8], "little", signed=True) if i else None for i in ids],
                [int(s[:1].view(np.int64)[0]) if len(s) else None for s in sets],
                [keys(i, s) for i, s in zip(ids, sets)],
            ]

        return each

    fields = "n_shingles bigint, set_id binary, node bigint, lead bigint, keys array<bigint>"
    return map_texts(rows, make, fields)


def _shared_keys(sets: DataFrame) -> DataFrame:
    """(node, rank) of the keys that several sets have; rarer keys have smaller ranks.

    A rank is the order of magnitude of the number of sets, then the key. One range sort by
    key and set, so the sets of a frequent key spread over several partitions. The first and
    last key of a partition may go on in others and count as most frequent everywhere: any
    order that all sets share is right, and these are two keys a partition.
    """
    pairs = sets.where("keys is not null").select(F.explode("keys").alias("key"), "node")
    ordered = pairs.repartitionByRange("key", "node").sortWithinPartitions("key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        hot: list[int] = []

        def ranked(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(starts, len(keys)))
            most = np.isin(keys[starts], hot) | (counts > HOT_ROWS)
            kind = np.where(most, HOT_CLASS, np.log2(counts).astype(np.int64))
            rank = np.repeat(kind << 58, counts) | (keys.view(np.uint64) >> np.uint64(6)).view(np.int64)
            shared = np.repeat(most | (counts > 1), counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes[shared]), pa.array(rank[shared])], names=["node", "rank"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(1).to_numpy()])
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
            keys, nodes = keys[new], nodes[new]
            if not hot:
                hot.append(keys[0])
            # The last key may go on in the next batch.
            done = int(np.searchsorted(keys, keys[-1]))
            if len(keys) - done > HOT_ROWS:
                hot.append(keys[-1])
                done = len(keys) - 1
            if done:
                yield ranked(keys[:done], nodes[:done])
                keys, nodes = keys[done:], nodes[done:]
        if len(keys):
            hot.append(keys[-1])
            yield ranked(keys, nodes)

    return ordered.mapInArrow(run, "node bigint, rank bigint")


def rare_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node): the rarest keys of every set, of which similar sets share one.

    Of the keys of two similar sets at least ``m`` are the same, so all but the m - 1 most
    frequent ones are enough; a set with fewer than m shared keys has no partner.
    """
    # A negative rank brings the size of a set before its keys.
    sizes = sets.groupBy("node").agg((-F.min("n_shingles")).alias("rank"))
    rows = _shared_keys(sets).unionByName(sizes)
    ordered = rows.repartition("node").sortWithinPartitions("node", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, ranks = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def chosen(nodes: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
            counts = np.diff(np.append(starts, len(nodes)))
            keep = counts - needed(-ranks[starts], percent)
            at = np.arange(len(nodes)) - np.repeat(starts, counts)
            kept = (at > 0) & (at <= np.repeat(keep, counts))
            return pa.RecordBatch.from_arrays(
                [pa.array(ranks[kept]), pa.array(nodes[kept])], names=["key", "node"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.concatenate([nodes, batch.column(0).to_numpy()])
            ranks = np.concatenate([ranks, batch.column(1).to_numpy()])
            done = int(np.searchsorted(nodes, nodes[-1]))
            if done:
                yield chosen(nodes[:done], ranks[:done])
                nodes, ranks = nodes[done:], ranks[done:]
        if len(nodes):
            yield chosen(nodes, ranks)

    return stage(ordered.mapInArrow(run, "key bigint, node bigint"), "rare")


def _key_edges(pairs: DataFrame) -> DataFrame:
    """(a, b): every set that shares a key is tied to the first set with that key.

    One range sort by key and set, so the sets of a frequent key spread over several
    partitions; the keys at the borders of partitions are tied together afterwards.
    """
    ordered = pairs.repartitionByRange("key", "node").sortWithinPartitions("key", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "key"]
        first, last_key, lead = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.concatenate([[True], keys[1:] != keys[:-1]])
            at = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), 0))
            leads = nodes[at]
            if last_key is not None and keys[0] == last_key:
                leads = np.where(at == 0, lead, leads)
            if first is None:
                first = (int(keys[0]), int(nodes[0]))
            last_key, lead = keys[-1], leads[-1]
            tied = np.flatnonzero(leads != nodes)
            if len(tied):
                ends = np.unique(np.stack([nodes[tied], leads[tied]]), axis=1)
                columns = [pa.array(ends[0]), pa.array(ends[1]), pa.nulls(ends.shape[1], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if first is not None:
            border = {int(last_key): int(lead), first[0]: first[1]}
            columns = [pa.array(list(border.values()), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(border), pa.int64())], names=names)

    tied = stage(ordered.mapInArrow(run, "a bigint, b bigint, key bigint"), "ties")
    border = tied.where("key is not null").select("key", "a")
    leads = border.groupBy("key").agg(F.min("a").alias("b"))
    across = border.join(leads, "key").select("a", "b")
    return tied.where("key is null").select("a", "b").unionByName(across)


def cluster_members(sets: DataFrame, percent: int) -> DataFrame:
    """(root, set_id, rep, size, lead): different sets that may have links, by cluster."""
    clusters = components(_key_edges(rare_keys(sets, percent)))
    members = (
        sets.join(clusters, "node").where("doc_id is not null").groupBy("root", "set_id")
        .agg(
            F.min("doc_id").alias("rep"), F.min("n_shingles").alias("size"), F.min("lead").alias("lead")
        )
    )
    return stage(members, "members")


def _blocks(members: DataFrame, first: str) -> DataFrame:
    """``members`` of clusters of two sets or more, with ``own`` block and number of ``blocks``.

    Blocks are cut along the order of ``first`` and size.
    """
    placed = contiguous_index(members, ["root", first, "size", "set_id"], "at")
    clusters = placed.groupBy("root").agg(F.min("at").alias("start"), F.count("*").alias("sets"))
    clusters = clusters.where("sets > 1").select(
        "root", "start", F.ceil(F.col("sets") / BLOCK_SETS).cast("int").alias("blocks")
    )
    own = F.floor((F.col("at") - F.col("start")) / BLOCK_SETS).cast("int").alias("own")
    return placed.join(clusters, "root").select(*members.columns, "blocks", own)


def block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """(root, x, y): blocks of a cluster that may hold similar sets of different components.

    Blocks inside the component with most blocks of a cluster are the main ones; no two of
    those need to meet, so only the others are joined with all blocks of their cluster.
    """
    blocks = stage(
        placed.groupBy("root", "own").agg(
            F.min("size").alias("low"), F.max("size").alias("high"),
            F.min("label").alias("label"), F.max("label").alias("last"),
        ),
        "blocks",
    )
    most = (
        blocks.where("label = last").groupBy("root", "label").count()
        .groupBy("root").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    )
    known = blocks.join(most, "root", "left").withColumn(
        "main", F.coalesce((F.col("label") == F.col("last")) & (F.col("label") == F.col("main")), F.lit(False))
    )
    one, two = known.where("not main").alias("one"), known.alias("two")
    meets = (
        (F.col("one.root") == F.col("two.root"))
        & (F.col("two.main") | (F.col("one.own") <= F.col("two.own")))
        & (100 * F.col("one.high") >= percent * F.col("two.low"))
        & (100 * F.col("two.high") >= percent * F.col("one.low"))
        & (
            (F.col("one.label") != F.col("one.last"))
            | (F.col("two.label") != F.col("two.last"))
            | (F.col("one.label") != F.col("two.label"))
        )
    )
    return one.join(two, meets).select(
        "one.root", F.least("one.own", "two.own").alias("x"), F.greatest("one.own", "two.own").alias("y")
    )


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows that are not in the one column of ``ids``.

    One bit a hash of an id, in a broadcast table of at most FILTER_WORDS rows.
    """

    def bit(name: str):
        return F.pmod(F.xxhash64(name), F.lit(64 * FILTER_WORDS))

    at = F.expr("cast(bit & 63 as int)")
    marks = (
        ids.select(bit(ids.columns[0]).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    )
    known = docs.withColumn("bit", bit("doc_id")).withColumn("word", F.shiftright("bit", 6))
    return known.join(F.broadcast(marks), "word").where(F.getbit("bits", at) == 1).select(*docs.columns)


def _compare(docs: DataFrame, meeting: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links between the sets that meet, of different labels, up to connection.

    ``meeting`` has (root, x, y, side, rep, set_id, label). Where x = y the sets of side 0
    meet one another too, otherwise only those of the other side.
    """
    # Members grow with the documents, so they are joined by key at every size.
    texts = _with_ids(docs, meeting.select("rep")).join(meeting.hint("merge"), F.col("doc_id") == F.col("rep")).select(
        "root", "x", "y", "side", "rep", "set_id", "label", "text"
    )
    ordered = texts.repartition("root", "x", "y").sortWithinPartitions("root", "x", "y", "side", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)

        def rows():
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        for (_, x, y), group in groupby(rows(), key=lambda r: r[:3]):
            sides: tuple[list, list] = ([], [])
            for _, _, _, side, rep, known, label, text in group:
                shingles = shingler(text)
                # Rows may share an id; the wanted one has the set that is known.
                if set_id(shingles) == known:
                    sides[side].append((int(shingles[0]), rep, shingles, label))
            found = list(_tree_links(sides, x == y, percent))
            columns = [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return stage(ordered.mapInArrow(run, "a bigint, b bigint"), "similar")


def _tree_links(sides, within: bool, percent: int) -> Iterator[tuple[int, int]]:
    # Similar sets mostly share their smallest hash, so they stand together in the tree.
    left, right = (sorted(s, key=lambda m: (m[0], len(m[2]), m[1])) for s in sides)
    one, two = Tree([m[2] for m in left]), Tree([m[2] for m in right])
    labels = np.unique([m[3] for m in left + right], return_inverse=True)[1]
    if within:
        for i, j in join_trees(one, None, percent, labels[: len(left)]):
            yield left[i][1], left[j][1]
    if right:
        for i, j in join_trees(one, two, percent, labels):
            yield left[i][1], right[j][1]


def _links(docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): pairs of first ids that connect all similar sets of a cluster."""
    members = cluster_members(sets, percent)
    placed = stage(_blocks(members, "lead"), "placed")
    # A block meets itself and the next one; that is all for clusters of two blocks.
    groups = F.when(F.col("own") > 0, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))
    near = placed.select("*", F.explode(groups).alias("x")).select(
        "root", "x", F.col("x").alias("y"), (F.col("own") - F.col("x")).alias("side"),
        "rep", "set_id", F.col("rep").alias("label"),
    )
    links = _compare(docs, near, n, percent)
    large = placed.where("blocks > 2").drop("own", "blocks")
    if large.isEmpty():
        return links
    labels = components(links)
    large = large.join(labels, F.col("rep") == F.col("node"), "left").select(
        placed["root"], "set_id", "rep", "size", F.coalesce(labels["root"], "rep").alias("label")
    )
    placed = stage(_blocks(large, "label"), "placed")
    pairs = stage(block_pairs(placed, percent), "pairs")
    sides = pairs.select("*", F.col("x").alias("own"), F.lit(0).alias("side")).unionByName(
        pairs.where("x < y").select("*", F.col("y").alias("own"), F.lit(1).alias("side"))
    )
    far = placed.join(sides, ["root", "own"]).select("root", "x", "y", "side", "rep", "set_id", "label")
    return links.unionByName(_compare(docs, far, n, percent))


def similar_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``."""
    rows = narrow(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sets = stage(described(rows, n, percent), "sets")
    links = _links(rows, sets.where("set_id is not null"), n, percent)
    roots = components(links)
    firsts = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    named = firsts.join(roots, F.col("rep") == F.col("node"), "left").select(
        "set_id", F.coalesce("root", "rep").alias("component_id")
    )
    alone = sets.where("set_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return sets.join(named, "set_id").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def drop_similar(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Rows of ``docs`` whose id names their component; the others go.

    A row without id stays: nothing can stand for it.
    """
    gone = unused(docs, "similar_id")
    found = similar_components(docs, key, text, n, percent)
    leaving = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(leaving.hint("merge"), F.col(key) == F.col(gone), "left_anti")
