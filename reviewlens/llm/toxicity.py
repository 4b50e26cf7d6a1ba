"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is a row of words; a word enters with an embedding of its own and the mean
embedding of its letter groups, so unseen words speak through their letters. Overlapping
windows cover the whole text; in each, a recurrent pass in both directions is pooled by
attention, and the text scores as its most toxic window.

Training is numpy on the driver, on a bounded sample of labelled rows: at most ``SAMPLE``
documents of class 0 and of class 1, each of at most ``SAMPLE_CHARS`` characters, chosen
by a hash of their id. Nothing else is bounded: every window of every text is scored, inside the tasks.

Defined results: null and empty texts, and texts without a word, score 0; rows without a
label of 0 or 1 train nothing; without rows of both classes every score is the share of
class 1; rows that repeat are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import ROWS_AT_ONCE, map_texts, narrow, shared_values

FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.5
SAMPLE, SAMPLE_CHARS = (4500, 1500), 6_000
# Half a window: passages of up to 17 words stand whole in some window.
WINDOW, STRIDE = 32, 16
WORD_DIM, LETTER_DIM, HIDDEN, ATTENTION = 6, 6, 8, 8
GROUP, MIN_WORD_DOCS, MIN_GROUP_DOCS = 4, 4, 6
STEPS, BATCH, RATE, SEED = 300, 256, 0.01, 7
# Documents that a feature is seen in, in addition, in each class.
PRIOR_DOCS = 2
WINDOWS_AT_ONCE, REMEMBERED = 4096, 200_000

# ASCII marks become blanks, so that words stand alone.
_BLANKED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    data = text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED)
    return data.decode("utf-8", "surrogatepass").split()


def letter_groups(word: str) -> list[str]:
    """Groups of four letters, with marks for the word's ends, and its first five letters."""
    marked = f"^{word}$"
    groups = [marked[i : i + GROUP] for i in range(max(1, len(marked) - GROUP + 1))]
    return list(dict.fromkeys([*groups, marked[: GROUP + 2]]))


def windows(size: int) -> range:
    """Starts of the overlapping windows that cover ``size`` words."""
    return range(0, max(size - WINDOW + STRIDE, 1), STRIDE)


@dataclass
class Network:
    """Parameters, and the vocabularies of the two embeddings (0: unknown)."""

    words: dict[str, int]
    groups: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)
    # Score of every text, where there was nothing to learn from.
    constant: float | None = None

    def inputs(self, word: str) -> tuple[int, list[int]]:
        known = self.groups.get
        return self.words.get(word, 0), [known(x, 0) for x in letter_groups(word)]

    def vectors(self, words: list[str]) -> np.ndarray:
        """Input of each word to the gates of both directions, biases included."""
        inputs = [self.inputs(w) for w in words]
        counts = np.array([len(g) for _, g in inputs])
        letters = self.p["groups"][[x for _, g in inputs for x in g]]
        means = np.add.reduceat(letters, np.cumsum(counts) - counts) / counts[:, None]
        x = np.concatenate([self.p["words"][[w for w, _ in inputs]], means], 1)
        return x.astype(np.float32) @ self.p["into"] + self.p["bias"]

    def logits(self, gates: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of windows given as (window, word, gate) inputs and a mask of real words."""
        return forward(self.p, gates, mask)[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _direction(gates, recur, order):
    """States of one direction, and what its backward pass needs."""
    n, size = gates.shape[0], HIDDEN
    states = np.zeros((n, gates.shape[1], size), np.float32)
    state, tape = np.zeros((n, size), np.float32), []
    for t in order:
        h = state @ recur
        zr = _sigmoid(gates[:, t, : 2 * size] + h[:, : 2 * size])
        z, r = zr[:, :size], zr[:, size:]
        new = np.tanh(gates[:, t, 2 * size :] + r * h[:, 2 * size :])
        tape.append((t, state, zr, new, h[:, 2 * size :]))
        state = new + z * (state - new)
        states[:, t] = state
    return states, tape


def forward(p, gates, mask):
    """(logits, everything the backward pass needs)."""
    length, size = gates.shape[1], 3 * HIDDEN
    ahead, tape_a = _direction(gates[:, :, :size], p["ahead"], range(length))
    back, tape_b = _direction(gates[:, :, size:], p["back"], range(length - 1, -1, -1))
    states = np.concatenate([ahead, back], 2)
    keys = np.tanh(states @ p["look"] + p["look_bias"])
    weight = np.where(mask, keys @ p["ask"], -1e9)
    weight = np.exp(weight - weight.max(1, keepdims=True)) * mask
    weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
    pooled = (weight[:, :, None] * states).sum(1)
    logits = pooled @ p["out"] + p["out_bias"][0]
    return logits, (states, keys, weight, pooled, tape_a, tape_b)


def _direction_back(d_states, tape, recur, d_gates, d_recur):
    carry = np.zeros_like(d_states[:, 0])
    size = HIDDEN
    for t, before, zr, new, h_new in reversed(tape):
        d = d_states[:, t] + carry
        z, r = zr[:, :size], zr[:, size:]
        d_new = d * (1 - z) * (1 - new**2)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * h_new * r * (1 - r)
        d_gates[:, t] = np.concatenate([d_z, d_r, d_new], 1)
        d_h = np.concatenate([d_z, d_r, d_new * r], 1)
        d_recur += before.T @ d_h
        carry = d * z + d_h @ recur.T


def gradients(p, gates, mask, wanted):
    """Gradients of the mean log loss by parameter, and by gate input."""
    logits, (states, keys, weight, pooled, tape_a, tape_b) = forward(p, gates, mask)
    d_logits = ((_sigmoid(logits) - wanted) / len(wanted)).astype(np.float32)
    g = {"out": pooled.T @ d_logits, "out_bias": d_logits.sum(keepdims=True)}
    d_pooled = d_logits[:, None] * p["out"]
    d_weight = (states * d_pooled[:, None, :]).sum(2)
    d_ask = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
    g["ask"] = np.einsum("nta,nt->a", keys, d_ask)
    d_keys = d_ask[:, :, None] * p["ask"] * (1 - keys**2)
    g["look"] = np.einsum("nth,nta->ha", states, d_keys)
    g["look_bias"] = d_keys.sum((0, 1))
    d_states = weight[:, :, None] * d_pooled[:, None, :] + d_keys @ p["look"].T
    d_gates = np.zeros_like(gates)
    for name, tape, at in (("ahead", tape_a, 0), ("back", tape_b, 1)):
        g[name] = np.zeros_like(p[name])
        part = slice(at * 3 * HIDDEN, (at + 1) * 3 * HIDDEN)
        states_part = d_states[:, :, at * HIDDEN : (at + 1) * HIDDEN]
        _direction_back(states_part, tape, p[name], d_gates[:, :, part], g[name])
    return g, d_gates


def _log_odds(documents: Iterable[set], labels: np.ndarray, least: int) -> dict:
    """Feature -> smoothed log odds of standing in a document of class 1."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for found, label in zip(documents, labels):
        counts[label].update(found)
    totals = [max(1, int((labels == k).sum())) for k in (0, 1)]
    kept = {f for c in counts for f in c if counts[0][f] + counts[1][f] >= least}
    return {
        f: np.log(counts[1][f] / totals[1] + PRIOR_DOCS / sum(totals))
        - np.log(counts[0][f] / totals[0] + PRIOR_DOCS / sum(totals))
        for f in sorted(kept)
    }


def train(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = SEED) -> Network:
    """Fit the network on labelled texts.

    A label belongs to a text, not to a window. Log odds of words and letter groups
    start the embeddings and pick the windows to learn from: of a toxic text the most
    suspicious one, of a clean text the three most suspicious ones and two others.
    """
    wanted = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return Network({}, {}, constant=float(wanted.mean()) if len(wanted) else 0.0)
    rng = np.random.default_rng(seed)
    same: dict[str, str] = {}  # one object per distinct word, one per letter group
    same_group: dict[str, str] = {}
    words = [[same.setdefault(w, w) for w in words_of(t)] for t in texts]
    word_odds = _log_odds(map(set, words), wanted, MIN_WORD_DOCS)
    memo = {w: tuple(same_group.setdefault(g, g) for g in letter_groups(w)) for w in same}
    grouped = (set().union(*(memo[x] for x in set(w))) for w in words)
    group_odds = _log_odds(grouped, wanted, MIN_GROUP_DOCS)
    net = Network(
        {w: i for i, w in enumerate(word_odds, 1)}, {g: i for i, g in enumerate(group_odds, 1)}
    )
    net.p = _first_parameters(word_odds, group_odds, rng)
    chosen, targets = _training_windows(words, wanted, word_odds, group_odds, memo, rng)
    _descend(net, chosen, targets, steps, rng)
    return net


def _first_parameters(word_odds, group_odds, rng) -> dict[str, np.ndarray]:
    def random(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {
        "words": random(len(word_odds) + 1, WORD_DIM, scale=0.05),
        "groups": random(len(group_odds) + 1, LETTER_DIM, scale=0.05),
        "into": random(WORD_DIM + LETTER_DIM, 6 * HIDDEN, scale=0.3),
        "bias": np.zeros(6 * HIDDEN, np.float32),
        "ahead": random(HIDDEN, 3 * HIDDEN, scale=0.3),
        "back": random(HIDDEN, 3 * HIDDEN, scale=0.3),
        "look": random(2 * HIDDEN, ATTENTION, scale=0.3),
        "look_bias": np.zeros(ATTENTION, np.float32),
        "ask": random(ATTENTION, scale=0.5),
        "out": random(2 * HIDDEN, scale=0.5),
        "out_bias": np.zeros(1, np.float32),
    }
    p["words"][0] = p["groups"][0] = 0
    p["words"][1:, 0] = np.array(list(word_odds.values())) / 3
    p["groups"][1:, 0] = np.array(list(group_odds.values())) / 3
    return p


def _training_windows(words, labels, word_odds, group_odds, memo, rng):
    """Windows to learn from and their labels."""
    suspicion: dict[str, float] = {}

    def suspicious(word: str) -> float:
        if word not in suspicion:
            known = [group_odds[g] for g in memo[word] if g in group_odds]
            letters = sum(sorted(known)[-4:]) / 4 if known else 0.0
            suspicion[word] = max(word_odds.get(word, 0.0), letters, 0.0) ** 2
        return suspicion[word]

    chosen, targets = [], []
    for found, label in zip(words, labels.tolist()):
        if not found:
            continue
        sums = np.concatenate([[0.0], np.cumsum([suspicious(w) for w in found])])
        starts = np.array(windows(len(found)))
        mass = sums[np.minimum(starts + WINDOW, len(found))] - sums[starts]
        picked = {int(starts[mass.argmax()])}
        if not label:
            picked |= {int(at) for at in rng.choice(starts, 2)}
            picked |= {int(at) for at in starts[np.argsort(mass)[-3:]]}
        for at in sorted(picked):
            chosen.append(found[at : at + WINDOW])
            targets.append(label)
    return chosen, np.array(targets, np.float32)


def _descend(net: Network, chosen, targets, steps: int, rng) -> None:
    """Adam over shuffled batches of windows."""
    index: dict[str, int] = {}
    ids = np.full((len(chosen), WINDOW), -1, np.int64)
    for i, window in enumerate(chosen):
        ids[i, : len(window)] = [index.setdefault(w, len(index)) for w in window]
    inputs = [net.inputs(w) for w in index]
    own = np.array([w for w, _ in inputs])
    group_count = np.array([len(g) for _, g in inputs])
    group_flat = np.array([x for _, g in inputs for x in g], np.int64)
    group_start = np.concatenate([[0], np.cumsum(group_count)])
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    p, step = net.p, 0
    while step < steps and len(chosen):
        order = rng.permutation(len(chosen))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            mask = ids[batch] >= 0
            present, place = np.unique(np.where(mask, ids[batch], 0), return_inverse=True)
            place = place.reshape(mask.shape)
            x = np.zeros((len(present), WORD_DIM + LETTER_DIM), np.float32)
            x[:, :WORD_DIM] = p["words"][own[present]]
            parts = [group_flat[group_start[i] : group_start[i + 1]] for i in present.tolist()]
            counts = group_count[present]
            rows = np.repeat(np.arange(len(present)), counts)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            share = np.maximum(counts, 1)[:, None].astype(np.float32)
            np.add.at(x[:, WORD_DIM:], rows, p["groups"][flat])
            x[:, WORD_DIM:] /= share
            gates = (x @ p["into"])[place] * mask[:, :, None] + p["bias"]
            g, d_gates = gradients(p, gates.astype(np.float32), mask, targets[batch])
            g["bias"] = d_gates.sum((0, 1))
            d_x_gates = np.zeros((len(present), 6 * HIDDEN), np.float32)
            np.add.at(d_x_gates, place[mask], d_gates[mask])
            g["into"] = x.T @ d_x_gates
            d_x = d_x_gates @ p["into"].T
            g["words"], g["groups"] = np.zeros_like(p["words"]), np.zeros_like(p["groups"])
            np.add.at(g["words"], own[present], d_x[:, :WORD_DIM])
            np.add.at(g["groups"], flat, (d_x[:, WORD_DIM:] / share)[rows])
            g["words"][0] = g["groups"][0] = 0
            step += 1
            for k, grad in g.items():
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad**2 - second[k])
                ahead = first[k] / (1 - 0.9**step)
                p[k] -= (RATE * ahead / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


class Scorer:
    """Scores texts; remembers the inputs of words while it lives."""

    def __init__(self, net: Network):
        self.net = net
        if net.constant is None:
            self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        # Row 0 stands for the place behind the last word.
        self.rows = np.zeros((1024, 6 * HIDDEN), np.float32)
        self.rows[0] = self.net.p["bias"]

    def _numbers(self, words: list[str]) -> np.ndarray:
        index = self.index
        new = [w for w in dict.fromkeys(words) if w not in index]
        if new:
            used = len(index) + 1
            need = used + len(new)
            if need > len(self.rows):
                grown = np.zeros((max(need, 2 * len(self.rows)), 6 * HIDDEN), np.float32)
                grown[:used] = self.rows[:used]
                self.rows = grown
            self.rows[used:need] = self.net.vectors(new)
            index.update(zip(new, range(used, need)))
        return np.fromiter(map(index.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list[str]) -> list[float]:
        if self.net.constant is not None:
            return [self.net.constant if words_of(t) else 0.0 for t in texts]
        if len(self.index) > REMEMBERED:
            self._forget()
        tokens = [words_of(t) for t in texts]
        lengths = np.array([len(t) for t in tokens])
        flat = np.concatenate([self._numbers(t) for t in tokens] + [np.zeros(WINDOW, np.int64)])
        begins = np.cumsum(lengths) - lengths
        per_text = [np.array(windows(n)) if n else np.zeros(0, np.int64) for n in lengths.tolist()]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in per_text])
        starts = np.concatenate([*per_text, np.zeros(0, np.int64)]).astype(np.int64) + begins[owner]
        ends = (begins + lengths)[owner]
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(starts), WINDOWS_AT_ONCE):
            part = slice(at, at + WINDOWS_AT_ONCE)
            place = starts[part, None] + np.arange(WINDOW)
            mask = place < ends[part, None]
            gates = self.rows[np.where(mask, flat[np.minimum(place, len(flat) - 1)], 0)]
            np.maximum.at(best, owner[part], self.net.logits(gates, mask))
        scores = 1 / (1 + np.exp(-np.clip(best, -60, 60)))
        return np.where(lengths > 0, scores, 0.0).tolist()


def held_out(key: Column, folds: int = FOLDS, fold: int = HELD_FOLD) -> Column:
    """Whether the remainder of crc32 of the id as text is the one kept from training."""
    number = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return number % folds == fold


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str = "toxic",
    most: tuple[int, int] = SAMPLE, most_chars: int = SAMPLE_CHARS,
) -> tuple[list[str], list[int]]:
    """Texts and labels, at most ``most`` of class 0 and of class 1, to the driver."""
    known = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    usable = docs.where(F.length("text") <= most_chars).select("doc_id", "text")
    # Ids alone meet the labels; the texts of those chosen, a bounded number, come after.
    drawn = (
        usable.where(~held_out(F.col("doc_id"))).select("doc_id").distinct()
        .join(known, F.col("doc_id") == F.col("label_id"))
        .select("label_id", "label", F.xxhash64("label_id").alias("draw"))
    )
    first = [
        drawn.where(F.col("label") == k).orderBy("draw", "label_id").limit(most[k]) for k in (0, 1)
    ]
    chosen = first[0].unionByName(first[1])
    texts = (
        usable.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .groupBy("label", "draw", "label_id").agg(F.min("text").alias("text"))
    )
    found = sorted(texts.collect(), key=lambda r: (r["label"], r["draw"], r["label_id"]))
    return [r["text"] for r in found], [r["label"] for r in found]


def score_toxicity(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its text alone."""
    shared = shared_values(docs.sparkSession, net)

    def make():
        scorer = Scorer(Network(**shared.value))

        def each(texts: list[str]):
            scores = scorer(texts)
            return [scores, [int(s >= threshold) for s in scores]]

        return each

    rows = narrow(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return map_texts(rows, make, "score double, predicted int", ("doc_id", "held_out"))


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """The network trained on the sample of labelled rows outside the held-out part."""
    return train(*training_sample(docs, labels))


def drop_toxic(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = shared_values(docs.sparkSession, net)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network(**shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                scores = scorer([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array([s < threshold for s in scores]))

    # Whole rows go through the network's tasks once; columns are told apart by place.
    return docs.mapInArrow(run, docs.schema)
