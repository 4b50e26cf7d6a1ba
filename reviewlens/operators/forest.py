"""Random forests of all grid points and folds, grown together on sparse rows.

The trees are those of MLlib's RandomForestClassifier: same candidate thresholds, same
bootstrap weights, same feature subsets, same splits. MLlib fits one forest at a time and
keeps a row as one number per feature; here one pass over sparse rows serves a level of
every forest, and of forests that differ in depth alone only the deepest is grown.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.operators.draws import JavaRandom, Poissons, Sampler, XorShift, subsets

# Executors need not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Batches = Iterator[pa.RecordBatch]
Task = Callable[[Batches], Batches]

# Cells of a chunk of rows written out densely, rows and features gathered at once,
# nodes that are split in one pass, and trees' nodes that are sent out at once.
_CELLS, _GATHER, _NODES, _SENT = 1 << 24, 1 << 17, 1 << 17, 1 << 20
# Seeds of which the driver draws the feature subsets itself, and those of a task.
_FEW, _BLOCK = 2048, 4096
_EPSILON = 2.0**-52
# Up to here the order in which a Scala map lists trees is known, see `_listed`.
_MOST_TREES = 16
_CHUNK_SCHEMA = "labels binary, folds binary, starts binary, places binary, codes binary, bags binary"
_PART_SCHEMA = "bucket int, nodes binary, sizes binary, totals binary, cells binary, counts binary"
_BEST_SCHEMA = "nodes binary, features binary, bins binary, totals binary, lefts binary"


@dataclass(frozen=True)
class Settings:
    """What is the same for all forests."""

    folds: int
    trees: tuple[int, ...]
    classes: int
    width: int
    seed: int
    max_bins: int
    least_rows: int
    least_gain: float
    memory: int

    @property
    def subset(self) -> int:
        """Features tried at a node."""
        return int(np.ceil(np.sqrt(self.width)))

    def sample_fraction(self, rows: int) -> float:
        needed = max(self.max_bins**2, 10000)
        return needed / rows if needed < rows else 1.0


def _place_type(settings: Settings) -> str:
    return "uint16" if settings.width <= 1 << 16 else "int32"


def can_grow(learner, points: Sequence[dict], rows: DataFrame) -> bool:
    """Whether the forests of these grid points can be grown here."""
    if type(learner) is not RandomForestClassifier:
        return False
    fields = {f.name: f for f in rows.schema}
    attributes = fields[learner.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    trees = [p.get(learner.numTrees, learner.getNumTrees()) for p in points]
    return (
        learner.getImpurity() == "gini" and learner.getFeatureSubsetStrategy() in ("auto", "sqrt")
        and learner.getSubsamplingRate() == 1.0 and learner.getBootstrap()
        and learner.getMinWeightFractionPerNode() == 0.0 and learner.getMaxBins() <= 256
        and not learner.isDefined(learner.weightCol) and not learner.isDefined(learner.thresholds)
        and set(attributes) <= {"numeric"}
        and {p.name for point in points for p in point} <= {"maxDepth", "numTrees"}
        and 2 <= min(trees) and max(trees) <= _MOST_TREES
    )


def _sparse(batch: pa.RecordBatch, settings: Settings) -> tuple[np.ndarray, ...]:
    """Labels, folds, starts of rows, places and values of the entries of a batch."""
    vectors = batch.column(batch.schema.get_field_index("features"))
    labels = batch.column(batch.schema.get_field_index("label"))
    if vectors.null_count or labels.null_count:
        raise ValueError("there must be labels and features")
    labels = labels.to_numpy(zero_copy_only=False)
    if (labels != np.floor(labels)).any() or (labels < 0).any() or (labels >= settings.classes).any():
        raise ValueError(f"labels must be 0 to {settings.classes - 1}")
    folds = batch.column(batch.schema.get_field_index("fold")).to_numpy(zero_copy_only=False)
    indices, values = vectors.field("indices"), vectors.field("values")
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
    entries = values.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if indices.null_count:
        places = np.concatenate([
            np.asarray(i if i is not None else range(n), "int64")
            for i, n in zip(indices.to_pylist(), lengths)
        ])
    else:
        places = indices.flatten().to_numpy(zero_copy_only=False).astype("int64")
    if not np.isfinite(entries).all():
        raise ValueError("features must be finite numbers")
    return labels.astype("int64"), folds.astype("int64"), np.concatenate([[0], np.cumsum(lengths)]), places, entries


def _sampled(settings: Settings, sizes: Sequence[int]) -> Task:
    """(feature, value, n0, n1, …): entries of the rows that each fold's thresholds are taken from."""
    seed = XorShift(settings.seed).integer()
    fractions = [settings.sample_fraction(n) for n in sizes]

    def run(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        own = int(JavaRandom(seed).longs(part + 1)[0][-1])
        samplers = [Sampler(own, f) for f in fractions]
        for batch in batches:
            if not batch.num_rows:
                continue
            _, folds, starts, places, values = _sparse(batch, settings)
            taken = np.zeros((len(folds), settings.folds), "int64")
            for fold, sampler in enumerate(samplers):
                for row in np.flatnonzero(folds != fold):
                    taken[row, fold] = sampler.take()
            row = np.repeat(np.arange(len(folds)), np.diff(starts))
            there = (values != 0.0) & taken.any(axis=1)[row]
            row, places, values = row[there], places[there], values[there]
            order = np.lexsort((values, places))
            row, places, values = row[order], places[order], values[order]
            if not len(row):
                continue
            new = np.concatenate([[True], (np.diff(places) != 0) | (np.diff(values) != 0)])
            counts = np.add.reduceat(taken[row], np.flatnonzero(new), axis=0)
            columns = {"feature": places[new].astype("int32"), "value": values[new]}
            columns |= {f"n{f}": counts[:, f] for f in range(settings.folds)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _thresholds_of(values: np.ndarray, counts: np.ndarray, rows: int, settings: Settings) -> np.ndarray:
    """MLlib's candidate thresholds of a feature, from its sampled values other than 0."""
    expected = settings.sample_fraction(rows) * rows
    found = counts.sum()
    if expected - found > _EPSILON * found * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype("float64"), at, expected - found)
    most = min(settings.max_bins, rows) - 1
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2.0
    stride = expected / (most + 1)
    chosen, current, target = [], float(counts[0]), stride
    for i in range(1, len(values)):
        before, current = current, current + float(counts[i])
        if abs(before - target) < abs(current - target):
            chosen.append((values[i - 1] + values[i]) / 2.0)
            target += stride
    return np.array(chosen)


def _thresholds(settings: Settings, sizes: Sequence[int]) -> Task:
    """(fold, feature, thresholds) of rows (feature, value, n0, …) sorted by feature and value."""

    def of(feature: int, values: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        for fold, rows in enumerate(sizes):
            there = counts[:, fold] > 0
            if there.any():
                found = _thresholds_of(values[there], counts[there, fold], rows, settings)
                if len(found):
                    yield fold, feature, found.tobytes()

    def run(batches: Batches) -> Batches:
        last, values, counts = None, [], []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            features, every = columns[0], np.stack(columns[2:], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(features)) + 1, [len(features)]])
            found: list[tuple] = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if last is not None and features[a] != last:
                    found += of(last, np.concatenate(values), np.concatenate(counts))
                    values, counts = [], []
                last = int(features[a])
                values.append(columns[1][a:b])
                counts.append(every[a:b])
            if found:
                yield _batch(["fold", "feature", "thresholds"], found)
        if last is not None:
            if found := list(of(last, np.concatenate(values), np.concatenate(counts))):
                yield _batch(["fold", "feature", "thresholds"], found)

    return run


def _batch(names: Sequence[str], rows: Sequence[tuple]) -> pa.RecordBatch:
    columns = dict(zip(names, map(list, zip(*rows))))
    types = {"fold": pa.int32(), "feature": pa.int32(), "bucket": pa.int32()}
    return pa.RecordBatch.from_pydict({n: pa.array(c, types.get(n, pa.binary())) for n, c in columns.items()})


@dataclass(frozen=True)
class Bins:
    """Thresholds of all features for one fold, and in which bin the value 0 is."""

    starts: np.ndarray
    values: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts) + 1

    def of(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The number of thresholds of its feature below each value."""
        low, high = self.starts[places], self.starts[places + 1]
        first = low.copy()
        padded = np.append(self.values, np.inf)
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            above = open_ & (padded[middle] < values)
            low = np.where(above, middle + 1, low)
            high = np.where(open_ & ~above, middle, high)
        return low - first

    @property
    def zero(self) -> np.ndarray:
        return self.of(np.arange(len(self.starts) - 1), np.zeros(len(self.starts) - 1))


def _chunks(settings: Settings, bins) -> Task:
    """Sparse chunks of rows with the bins of their entries and their bootstrap weights.

    A code is a bin counted from that of the value 0, so that it is 0 wherever a row has
    no entry. The weights are those that MLlib draws partition by partition.
    """

    def run(batches: Batches) -> Batches:
        every = bins.value
        zeros, sizes = [b.zero for b in every], [b.sizes for b in every]
        drawn = Poissons(settings.seed + TaskContext.get().partitionId() + 1)
        seen = np.zeros(settings.folds, "int64")
        most = min(4096, max(64, _CELLS // settings.width))
        for batch in (b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)):
            labels, folds, starts, places, values = _sparse(batch, settings)
            codes = np.empty((settings.folds, len(places)), "uint8")
            bags = np.zeros((settings.folds, len(labels), sum(settings.trees)), "uint8")
            for fold in range(settings.folds):
                codes[fold] = (every[fold].of(places, values) - zeros[fold][places]) % sizes[fold][places]
                rows = np.flatnonzero(folds != fold)
                at = 0
                for trees in settings.trees:
                    begin, end = seen[fold] * trees, (seen[fold] + len(rows)) * trees
                    bags[fold, rows, at : at + trees] = drawn.between(begin, end).reshape(-1, trees)
                    at += trees
                seen[fold] += len(rows)
            yield pa.RecordBatch.from_pydict({
                "labels": [labels.astype("int32").tobytes()], "folds": [folds.astype("int32").tobytes()],
                "starts": [starts.astype("int32").tobytes()], "places": [places.astype(_place_type(settings)).tobytes()],
                "codes": [codes.tobytes()], "bags": [bags.tobytes()],
            })

    return run


class _Chunk:
    """A chunk of rows as it is read back."""

    def __init__(self, row: dict, settings: Settings):
        self.labels, self.folds = np.frombuffer(row["labels"], "int32"), np.frombuffer(row["folds"], "int32")
        starts = np.frombuffer(row["starts"], "int32")
        places = np.frombuffer(row["places"], _place_type(settings))
        self.width = settings.width
        self.at = np.repeat(np.arange(len(self.labels)) * self.width, np.diff(starts)) + places
        self.codes = np.frombuffer(row["codes"], "uint8").reshape(settings.folds, -1)
        self.bags = np.frombuffer(row["bags"], "uint8").reshape(settings.folds, len(self.labels), -1)
        self.dense = np.zeros(len(self.labels) * self.width, "uint8")

    def of_fold(self, fold: int) -> np.ndarray:
        """Codes of all cells, row after row; no other fold's may be in use."""
        self.dense[self.at] = self.codes[fold]
        return self.dense


def _chunks_of(batches: Batches, settings: Settings) -> Iterator[_Chunk]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _Chunk(row, settings)


@dataclass
class _Forest:
    """One forest as it grows; children of a node stand side by side."""

    fold: int
    trees: int
    depth: int
    settings: Settings
    tree: np.ndarray = field(init=False)
    level: np.ndarray = field(init=False)
    left: np.ndarray = field(init=False)
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)
    stack: np.ndarray = field(init=False)
    cut: bool = False

    def __post_init__(self):
        n = self.trees
        self.random = JavaRandom(self.settings.seed)
        self.tree, self.level = np.arange(n), np.zeros(n, "int64")
        self.left, self.feature = np.full(n, -1, "int32"), np.zeros(n, _place_type(self.settings))
        self.bin = np.zeros(n, "uint8")
        self.counts = np.zeros((n, self.settings.classes))
        self.stack = np.arange(n)[::-1]
        self.group, self.subsets = self.stack[:0], None

    def choose(self, drawn: np.ndarray, states: np.ndarray, sizes: np.ndarray) -> None:
        """Take the next nodes off the stack, as many as MLlib's memory allows.

        ``drawn`` are the subsets of all nodes of the stack, ``states`` those of the random
        numbers after each; a node that does not fit is drawn for again later.
        """
        used = np.cumsum(self.settings.classes * 8 * sizes[drawn].sum(axis=1))
        n = max(1, int(np.searchsorted(used, self.settings.memory, "right")))
        if n < len(self.stack):
            self.cut, self.random.state = True, states[n]
        self.group, self.stack, self.subsets = self.stack[:n], self.stack[n:], drawn[:n]

    def grow(self, feature: np.ndarray, bin_: np.ndarray, totals: np.ndarray, lefts: np.ndarray) -> None:
        """Split the nodes of the group (feature -1: none is good), in MLlib's order."""
        roots = self.level[self.group] == 0
        self.counts[self.group[roots]] = totals[roots]
        trees = self.tree[self.group]
        rank = np.zeros(self.trees, "int64")
        listed = _listed(np.unique(trees).tolist())
        rank[listed] = np.arange(len(listed))
        order = np.argsort(rank[trees], kind="stable")
        order = order[feature[order] >= 0]
        nodes, left = self.group[order], lefts[order]
        children = len(self.tree) + 2 * np.arange(len(nodes))
        self.left[nodes], self.feature[nodes], self.bin[nodes] = children, feature[order], bin_[order]
        counts = np.stack([left, totals[order] - left], axis=1).reshape(-1, self.settings.classes)
        level = np.repeat(self.level[nodes] + 1, 2)
        self.tree = np.concatenate([self.tree, np.repeat(self.tree[nodes], 2)])
        self.level = np.concatenate([self.level, level])
        self.counts = np.concatenate([self.counts, counts])
        for name in ("left", "feature", "bin"):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, np.full(len(counts), -1 if name == "left" else 0, old.dtype)]))
        going = (level < self.depth) & (np.abs(_gini(counts)) >= _EPSILON)
        new = (np.repeat(children, 2) + np.tile([0, 1], len(nodes)))[going]
        self.stack = np.concatenate([new[::-1], self.stack])

    def leaves(self, depth: int) -> np.ndarray:
        """For each node the one that votes for its rows where the trees end at ``depth``.

        A node whose children are leaves of one class is a leaf instead of them.
        """
        guess = self.counts.argmax(axis=1)
        inner = np.flatnonzero(self.left >= 0)
        leaf = np.ones(len(self.tree), bool)
        leaf[inner] = self.level[inner] >= depth
        by_level = [inner[self.level[inner] == n] for n in range(self.depth)]
        for nodes in reversed(by_level[:depth]):
            a, b = self.left[nodes], self.left[nodes] + 1
            leaf[nodes] = leaf[a] & leaf[b] & (guess[a] == guess[b])
        own = np.arange(len(self.tree), dtype="int32")
        for nodes in by_level:
            ended = nodes[leaf[nodes] | (own[nodes] != nodes)]
            own[self.left[ended]] = own[self.left[ended] + 1] = own[ended]
        return own


def _listed(trees: Sequence[int]) -> list[int]:
    """Trees in the order of an immutable Scala map: by a trie of their hashes, from five on."""

    def hashed(tree: int) -> int:
        h = (tree + ~(tree << 9)) & 0xFFFFFFFF
        h ^= h >> 14
        h = (h + (h << 4)) & 0xFFFFFFFF
        return h ^ (h >> 10)

    def below(some: Sequence[int], shift: int) -> list[int]:
        slots: dict[int, list[int]] = {}
        for tree in some:
            slots.setdefault(hashed(tree) >> shift & 31, []).append(tree)
        single = [slots[s][0] for s in sorted(slots) if len(slots[s]) == 1]
        return single + [t for s in sorted(slots) if len(slots[s]) > 1 for t in below(slots[s], shift + 5)]

    return sorted(trees) if len(trees) <= 4 else below(trees, 0)


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1)
    impurity = np.ones(len(counts))
    for k in range(counts.shape[1]):
        share = counts[:, k] / np.where(total == 0, 1, total)
        impurity -= share * share
    return np.where(total == 0, 0.0, impurity)


def _narrow(values: np.ndarray) -> bytes:
    """The bytes of numbers from 0 on, in the smallest type for them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype("int64")


def _sums(settings: Settings, sent, nodes: int, buckets: int) -> Task:
    """Class weights of the nodes in ``sent``, in all and by bin of each of their features.

    Only cells with entries are written; the rest of a node's weight is where 0 is. Each
    task sums up its rows.
    """
    size, classes, most = settings.subset, settings.classes, settings.max_bins
    bounds = -(-np.arange(buckets + 1) * nodes // buckets)

    def of(forest: dict, chunk: _Chunk, dense: np.ndarray) -> Iterator[tuple]:
        bag = chunk.bags[forest["fold"], :, forest["column"] : forest["column"] + forest["trees"]]
        row, at = np.nonzero(bag)
        weight = bag[row, at]
        inner = np.ones(len(row), bool)
        at = at.astype("int32")
        while len(going := np.flatnonzero(inner)):
            down = forest["left"][at[going]]
            inner[going] = more = down >= 0
            going, down = going[more], down[more]
            if len(going):
                cell = dense[row[going] * settings.width + forest["feature"][at[going]]]
                at[going] = down + _right(cell, forest, at[going])
        node = forest["place"][at]
        there = np.flatnonzero(node >= 0)
        if not len(there):
            return
        row, node, weight = row[there], node[there], weight[there].astype("int64")
        label = chunk.labels[row]
        cells, counts, owners = [], [], []
        step = max(1, _GATHER // size)
        # In the order of rows, so that the cells of a row are near at hand.
        for i in range(0, len(row), step):
            base = row[i : i + step] * settings.width
            found = dense[base[:, None] + forest["subsets"][node[i : i + step]]].ravel()
            full = np.flatnonzero(found.view(bool))
            pair = full // size
            cells.append(((full - pair * size) * most + found[full]) * classes + label[i + pair])
            counts.append(weight[i + pair])
            owners.append(node[i + pair])
        cells, counts, owners = map(np.concatenate, (cells, counts, owners))
        span = size * most * classes
        n = len(forest["subsets"])
        if n * span <= 16 * len(cells):
            summed = np.bincount(owners * span + cells, counts, n * span).astype("int64")
            key = np.flatnonzero(summed)
            owners, cells, counts = key // span, key % span, summed[key]
        else:
            order = np.argsort(owners.astype(np.min_scalar_type(n)), kind="stable")
            owners, cells, counts = owners[order], cells[order], counts[order]
        totals = np.bincount(node * classes + label, weight, n * classes).reshape(n, classes).astype("int64")
        sizes = np.bincount(owners, minlength=n)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        first, last = forest["first"], forest["first"] + n
        for b in range(np.searchsorted(bounds, first, "right") - 1, np.searchsorted(bounds, last)):
            low, high = max(bounds[b], first) - first, min(bounds[b + 1], last) - first
            own = low + np.flatnonzero(totals[low:high].any(axis=1))
            if len(own):
                part = slice(ends[low], ends[high])
                yield (
                    int(b), (first + own).astype("int32").tobytes(), _narrow(sizes[own]), _narrow(totals[own]),
                    _narrow(cells[part]), _narrow(counts[part]),
                )

    def run(batches: Batches) -> Batches:
        forests = sent.value["forests"]
        for chunk in _chunks_of(batches, settings):
            for fold in sorted({f["fold"] for f in forests}):
                dense = chunk.of_fold(fold)
                for forest in forests:
                    if forest["fold"] == fold:
                        if rows := list(of(forest, chunk, dense)):
                            yield _batch(["bucket", "nodes", "sizes", "totals", "cells", "counts"], rows)

    return run


def _right(cell: np.ndarray, forest: dict, at: np.ndarray) -> np.ndarray:
    """1 where the code of a row's cell lies beyond the threshold of its node."""
    if forest["plain"]:
        return cell > forest["bin"][at]
    feature = forest["feature"][at]
    return (cell.astype("int64") + forest["zero"][feature]) % forest["sizes"][feature] > forest["bin"][at]


def _best(settings: Settings, sent, nodes: int, buckets: int) -> Task:
    """The best split of each node (feature -1: none), its class weights and those of its left child."""
    size, classes, most = settings.subset, settings.classes, settings.max_bins
    bounds = -(-np.arange(buckets + 1) * nodes // buckets)

    def of(low: int, high: int, rows: list[dict]) -> tuple:
        n = high - low
        tried, width, zero = np.empty((n, size), "int64"), np.empty((n, size), "int64"), np.empty((n, size), "int64")
        for forest in sent.value["forests"]:
            a, b = max(low, forest["first"]), min(high, forest["first"] + len(forest["subsets"]))
            if a < b:
                tried[a - low : b - low] = own = forest["subsets"][a - forest["first"] : b - forest["first"]]
                width[a - low : b - low], zero[a - low : b - low] = forest["sizes"][own], forest["zero"][own]
        ends = np.cumsum(width.ravel())
        starts, all_ = ends - width.ravel(), int(ends[-1])
        hist, totals = np.zeros(all_ * classes), np.zeros((n, classes))
        for row in rows:
            own = np.frombuffer(row["nodes"], "int32") - low
            sizes = _wide(row["sizes"], len(own))
            np.add.at(totals, own, _wide(row["totals"], len(own) * classes).reshape(-1, classes))
            if m := int(sizes.sum()):
                owner, cells = np.repeat(own, sizes), _wide(row["cells"], m)
                j, code = cells // (most * classes), cells // classes % most
                at = starts[owner * size + j] + (code + zero[owner, j]) % width[owner, j]
                np.add.at(hist, at * classes + cells % classes, _wide(row["counts"], m))
        hist = hist.reshape(all_, classes)
        hist[starts + zero.ravel()] += np.repeat(totals, size, axis=0) - np.add.reduceat(hist, starts, axis=0)
        left = np.cumsum(hist, axis=0)
        left -= np.repeat(left[starts] - hist[starts], width.ravel(), axis=0)
        open_ = np.ones(all_, bool)
        open_[ends - 1] = False
        owner = np.repeat(np.arange(n), width.sum(axis=1))
        lefts = left.sum(axis=1)
        whole = totals.sum(axis=1)[owner]
        open_ &= (lefts >= settings.least_rows) & (whole - lefts >= settings.least_rows)
        at = np.flatnonzero(open_)
        owner, left, lefts, whole = owner[at], left[at], lefts[at], whole[at]
        rights = whole - lefts
        gain = _gini(totals)[owner] - lefts / whole * _gini(left) - rights / whole * _gini(totals[owner] - left)
        good = (gain >= settings.least_gain) & (gain > 0)
        at, owner, left, gain = at[good], owner[good], left[good], gain[good]
        feature, bin_, lefts = np.full(n, -1, "int64"), np.zeros(n, "int64"), np.zeros((n, classes))
        if len(at):
            there, first = np.unique(owner, return_index=True)
            highest = np.zeros(n)
            highest[there] = np.maximum.reduceat(gain, first)
            top = np.flatnonzero(gain == highest[owner])
            there, first = np.unique(owner[top], return_index=True)
            top = top[first]
            place = np.searchsorted(ends, at[top], "right")
            feature[there], bin_[there], lefts[there] = tried.ravel()[place], at[top] - starts[place], left[top]
        return (
            np.arange(low, high, dtype="int32").tobytes(), feature.astype("int32").tobytes(),
            bin_.astype("uint8").tobytes(), totals.tobytes(), lefts.tobytes(),
        )

    def run(batches: Batches) -> Batches:
        found: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                found.setdefault(row["bucket"], []).append(row)
        for bucket in sorted(found):
            best = of(int(bounds[bucket]), int(bounds[bucket + 1]), found.pop(bucket))
            yield _batch(["nodes", "features", "bins", "totals", "lefts"], [best])

    return run


def _right_ones(settings: Settings, sent, depths: Sequence[int]) -> Task:
    """(forest, d0, d1, …): rows of its fold that a forest labels rightly at each depth."""

    def run(batches: Batches) -> Batches:
        forests = sent.value["forests"]
        found = np.zeros((len(forests), len(depths)), "int64")
        for chunk in _chunks_of(batches, settings):
            for fold in sorted({f["fold"] for f in forests}):
                held_out = np.flatnonzero(chunk.folds == fold)
                if not len(held_out):
                    continue
                dense, labels = chunk.of_fold(fold), chunk.labels[held_out]
                for i, forest in enumerate(forests):
                    if forest["fold"] != fold:
                        continue
                    trees = forest["trees"]
                    row, at = np.repeat(held_out, trees), np.tile(np.arange(trees, dtype="int32"), len(held_out))
                    going = np.arange(len(at))
                    while len(going):
                        down = forest["left"][at[going]]
                        going, down = going[down >= 0], down[down >= 0]
                        cell = dense[row[going] * settings.width + forest["feature"][at[going]]]
                        at[going] = down + _right(cell, forest, at[going])
                    for d, (owners, shares) in enumerate(forest["votes"]):
                        votes = shares[owners[at]].reshape(len(held_out), trees, -1)
                        raw = np.zeros((len(held_out), settings.classes))
                        for t in range(trees):
                            raw += votes[:, t]
                        found[i, d] += (raw.argmax(axis=1) == labels).sum()
        yield pa.RecordBatch.from_pydict(
            {"forest": pa.array(range(len(forests)), pa.int32())} | {f"d{d}": found[:, d] for d in range(len(depths))}
        )

    return run


class _Grower:
    """Grows forests over chunks of rows, level by level."""

    def __init__(self, spark: SparkSession, chunks: DataFrame, settings: Settings, bins: Sequence[Bins]):
        self.spark, self.chunks, self.settings = spark, chunks, settings
        self.sizes, self.zeros = [b.sizes for b in bins], [b.zero for b in bins]

    def _subsets(self, seeds: np.ndarray) -> np.ndarray:
        width, size = self.settings.width, self.settings.subset
        if len(seeds) <= _FEW:
            return subsets(seeds, width, size)
        blocks = -(-len(seeds) // _BLOCK)

        def run(batches: Batches) -> Batches:
            for batch in batches:
                for block in batch.column(0).to_pylist():
                    drawn = subsets(seeds[block * _BLOCK : (block + 1) * _BLOCK], width, size)
                    yield pa.RecordBatch.from_pydict({"block": [block], "drawn": [drawn.astype("int32").tobytes()]})

        found = self.spark.range(0, blocks, 1, blocks).mapInArrow(run, "block bigint, drawn binary").collect()
        parts = [np.frombuffer(r["drawn"], "int32") for r in sorted(found, key=lambda r: r["block"])]
        return np.concatenate(parts).reshape(-1, size)

    def _sent(self, forest: _Forest) -> dict:
        columns = np.concatenate([[0], np.cumsum(self.settings.trees)])
        return {
            "fold": forest.fold, "trees": forest.trees, "left": forest.left, "feature": forest.feature, "bin": forest.bin,
            "column": int(columns[self.settings.trees.index(forest.trees)]),
            "zero": self.zeros[forest.fold], "sizes": self.sizes[forest.fold],
            "plain": not self.zeros[forest.fold].any(),
        }

    def _level(self, forests: Sequence[_Forest]) -> None:
        settings = self.settings
        drawn = [f.random.longs(len(f.stack)) for f in forests]
        every = self._subsets(np.concatenate([seeds for seeds, _ in drawn]))
        at, sent = 0, []
        for forest, (seeds, states) in zip(forests, drawn):
            forest.choose(every[at : at + len(seeds)], states, self.sizes[forest.fold])
            at += len(seeds)
        nodes = 0
        for forest in forests:
            place = np.full(len(forest.tree), -1, "int32")
            place[forest.group] = np.arange(len(forest.group))
            sent.append(self._sent(forest) | {"place": place, "subsets": forest.subsets.astype(forest.feature.dtype), "first": nodes})
            nodes += len(forest.group)
        buckets = max(-(-nodes // 512), min(nodes, 2 * int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        payload = self.spark.sparkContext.broadcast({"forests": sent})
        try:
            parts = self.chunks.mapInArrow(_sums(settings, payload, nodes, buckets), _PART_SCHEMA)
            best = parts.repartition("bucket").mapInArrow(_best(settings, payload, nodes, buckets), _BEST_SCHEMA)
            found = best.collect()
        finally:
            payload.destroy()
        feature, bin_ = np.full(nodes, -1), np.zeros(nodes, "uint8")
        totals, lefts = np.zeros((nodes, settings.classes)), np.zeros((nodes, settings.classes))
        for row in found:
            own = np.frombuffer(row["nodes"], "int32")
            feature[own] = np.frombuffer(row["features"], "int32")
            bin_[own] = np.frombuffer(row["bins"], "uint8")
            totals[own] = np.frombuffer(row["totals"]).reshape(len(own), -1)
            lefts[own] = np.frombuffer(row["lefts"]).reshape(len(own), -1)
        for forest, part in zip(forests, sent):
            own = slice(part["first"], part["first"] + len(forest.group))
            forest.grow(feature[own], bin_[own], totals[own], lefts[own])

    def grow(self, forests: Sequence[_Forest]) -> None:
        while any(len(f.stack) for f in forests):
            waiting = [f for f in forests if len(f.stack)]
            ends = np.cumsum([len(f.stack) for f in waiting])
            self._level(waiting[: max(1, int(np.searchsorted(ends, _NODES, "right")))])

    def right_ones(self, forests: Sequence[_Forest], depths: Sequence[int]) -> np.ndarray:
        """How many rows of its fold each forest labels rightly, cut at each depth."""
        found = np.zeros((len(forests), len(depths)), "int64")
        ends = np.cumsum([len(f.tree) for f in forests])
        begin = 0
        while begin < len(forests):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + _SENT, "right")))
            sent = []
            for forest in forests[begin:end]:
                total = forest.counts.sum(axis=1, keepdims=True)
                shares = np.divide(forest.counts, total, out=np.zeros_like(forest.counts), where=total > 0)
                sent.append(self._sent(forest) | {"votes": [(forest.leaves(d), shares) for d in depths]})
            payload = self.spark.sparkContext.broadcast({"forests": sent})
            try:
                schema = "forest int, " + ", ".join(f"d{d} bigint" for d in range(len(depths)))
                parts = self.chunks.mapInArrow(_right_ones(self.settings, payload, depths), schema)
                sums = parts.groupBy("forest").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(len(depths))])
                for row in sums.collect():
                    found[begin + row["forest"]] = row[1:]
            finally:
                payload.destroy()
            begin = end
        return found


def _bins(rows: DataFrame, settings: Settings, sizes: Sequence[int]) -> list[Bins]:
    counts = [f"n{f}" for f in range(settings.folds)]
    schema = "feature int, value double, " + ", ".join(f"{n} bigint" for n in counts)
    sampled = rows.mapInArrow(_sampled(settings, sizes), schema)
    summed = sampled.groupBy("feature", "value").agg(*[F.sum(n).alias(n) for n in counts])
    # With a number of partitions Spark does not put this small table into a single task.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = summed.repartition(tasks, "feature").sortWithinPartitions("feature", "value")
    found = sorted_.mapInArrow(_thresholds(settings, sizes), "fold int, feature int, thresholds binary")
    by = [[np.empty(0)] * settings.width for _ in range(settings.folds)]
    for row in found.collect():
        by[row["fold"]][row["feature"]] = np.frombuffer(row["thresholds"])
    return [Bins(np.concatenate([[0], np.cumsum([len(x) for x in own])]), np.concatenate(own)) for own in by]


def forest_accuracies(
    learner: RandomForestClassifier, points: Sequence[dict], rows: DataFrame, folds: int
) -> list[list[float]]:
    """Accuracy of every grid point (inner lists) on every fold, fitted on the other folds.

    Rows are (label, features, fold). Where MLlib's memory for a level cuts the forest short,
    the random numbers of lower levels depend on the depth, and every depth is grown alone.
    """
    spark = rows.sparkSession
    plain = rows.select(
        F.col(learner.getLabelCol()).cast("double").alias("label"),
        F.unwrap_udt(learner.getFeaturesCol()).alias("features"), F.col("fold"),
    )
    found = plain.groupBy("fold").agg(F.count("*").alias("n"), F.max("label").alias("most")).collect()
    held_out = {r["fold"]: r["n"] for r in found}
    known = sum(n for fold, n in held_out.items() if fold is not None)
    plain = plain.where(F.col("fold").isNotNull())
    depths = sorted({p.get(learner.maxDepth, learner.getMaxDepth()) for p in points})
    settings = Settings(
        folds=folds, trees=tuple(sorted({p.get(learner.numTrees, learner.getNumTrees()) for p in points})),
        classes=max(2, int(max((r["most"] for r in found if r["most"] is not None), default=0)) + 1),
        width=rows.select(learner.getFeaturesCol()).first()[0].size, seed=learner.getSeed(),
        max_bins=learner.getMaxBins(), least_rows=learner.getMinInstancesPerNode(),
        least_gain=learner.getMinInfoGain(), memory=learner.getMaxMemoryInMB() * 1024 * 1024,
    )
    bins = _bins(plain, settings, [known - held_out[f] for f in range(folds)])
    sent = spark.sparkContext.broadcast(bins)
    chunks = plain.mapInArrow(_chunks(settings, sent), _CHUNK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    right: dict[tuple[int, int, int], int] = {}
    try:
        grower = _Grower(spark, chunks, settings, bins)
        left = depths
        keys = [(fold, trees) for fold in range(folds) for trees in settings.trees]
        forests = [_Forest(*key, depths[-1], settings) for key in keys]
        while forests:
            grower.grow(forests)
            counts = grower.right_ones(forests, left)
            again = []
            for forest, own in zip(forests, counts):
                for depth, n in zip(left, own):
                    if depth == forest.depth or (depth < forest.depth and not forest.cut):
                        right.setdefault((forest.fold, forest.trees, depth), int(n))
                if forest.cut and (lower := [d for d in depths if d < forest.depth]):
                    again.append(_Forest(forest.fold, forest.trees, lower[-1], settings))
            forests = again
    finally:
        chunks.unpersist()
        sent.destroy()
    return [
        [
            right[f, p.get(learner.numTrees, learner.getNumTrees()), p.get(learner.maxDepth, learner.getMaxDepth())]
            / held_out[f]
            for p in points
        ]
        for f in range(folds)
    ]
