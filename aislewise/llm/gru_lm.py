"""Log-likelihood of documents by a gated recurrent language model."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm import tokens
from aislewise.llm.common import bounded_batches, hashed_sample, stage

U64 = np.uint64
#: The token that ends every text; also what the model reads before the first word.
END = U64(0xE0D0_F7E1_7000_0001)
#: Rows that are worked out at once, as many as a core's cache holds.
ROWS = 1000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class GruSettings:
    """Shape and training of the model.

    The model's own vocabulary is the end, the `words` most frequent words and `clusters` of
    all other words by their first two bytes. `classes` factor the softmax. `head` words have
    their counts sent to the tasks, others are counted by a join. Training starts on the driver with
    about `sample` tokens, in stretches of at most `stretch`, by `streams` side by side and `window`
    steps back. Then all tokens are learned in `rounds`: each task trains on its texts, whole, by
    `wide` streams, and the weights are averaged.
    """

    words: int = 1500
    clusters: int = 64
    classes: int = 40
    hidden: int = 24
    head: int = 1 << 18
    sample: int = 500_000
    stretch: int = 2000
    streams: int = 64
    rounds: int = 1
    wide: int = 256
    window: int = 24
    epochs: int = 2
    rate: float = 0.08
    seed: int = 1
    #: Tokens that a task gathers before it scores them, long and short texts side by side.
    buffer: int = 3_000_000


@dataclass
class Gru:
    """Weights: `gates` per input token, `back` from the state, two softmax layers."""

    gates: np.ndarray
    back: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray

    @property
    def per_class(self) -> int:
        return self.word_bias.shape[1]


def new_gru(size: int, s: GruSettings) -> Gru:
    """Random weights for `size` tokens; slots of the last class beyond them can't occur."""
    rng = np.random.default_rng(s.seed)
    classes = max(1, min(s.classes, size))
    per = -(-size // classes)
    classes = -(-size // per)
    h = s.hidden
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    bias = np.zeros((classes, per), np.float32)
    bias.reshape(-1)[size:] = -1e9
    return Gru(
        draw(size, 3 * h), draw(h, 3 * h), draw(h, classes), np.zeros(classes, np.float32),
        draw(classes, h, per), bias,
    )


def _step(gru: Gru, token: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state, and what its gradient needs, turned: both gates, the candidate, its state part."""
    after, *rest = _advance(gru.gates.take(token, 0), h @ gru.back, h.T)
    return after.T, *rest


def _advance(x: np.ndarray, b: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """A step from the token's and the state's part of the gates.

    States and results are turned, one row for each of the few columns, since numpy is slow along short rows.
    """
    n = len(h)
    both = np.ascontiguousarray((x + b)[:, : 2 * n].T)
    np.negative(both, out=both)
    np.exp(both, out=both)
    both += 1
    np.divide(1, both, out=both)
    z, r = both[:n], both[n:]
    part = np.ascontiguousarray(b[:, 2 * n :].T)
    c = r * part
    c += x[:, 2 * n :].T
    np.tanh(c, out=c)
    after = h - c
    after *= z
    after += c
    return after, z, r, c, part


def _next_states(gru: Gru, token: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The states after a step of many texts, worked out some at a time, which stay in the cache."""
    b = h @ gru.back
    out = np.empty_like(h)
    for at in range(0, len(h), ROWS):
        rows = slice(at, at + ROWS)
        out[rows] = _advance(gru.gates.take(token[rows], 0), b[rows], h[rows].T)[0].T
    return out


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Sums of columns, rounded as numpy rounds the sum of a row: in eight strands."""
    whole = len(x) // 8 * 8
    if not whole:
        return x.sum(0)
    sums = x[:8].copy()
    for at in range(8, whole, 8):
        sums += x[at : at + 8]
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    for row in x[whole:]:
        sums += row
    return sums[0]


def _softmax(x: np.ndarray) -> None:
    """Turns rows of logits into probabilities, in place."""
    for at in range(0, len(x), ROWS):
        part = np.ascontiguousarray(x[at : at + ROWS].T)
        part -= part.max(0)
        np.exp(part, out=part)
        part /= _column_sums(part)
        x[at : at + ROWS] = part.T


def _log_softmax_at(x: np.ndarray, bias: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log softmax of each row of logits and bias at its column."""
    out = np.empty(len(x), x.dtype)
    for at in range(0, len(x), ROWS):
        part = np.add(x[at : at + ROWS].T, bias[:, None], order="C")
        part -= part.max(0)
        chosen = part[column[at : at + ROWS], np.arange(part.shape[1])]
        np.exp(part, out=part)
        out[at : at + ROWS] = chosen - np.log(_column_sums(part))
    return out


def _stable_order(keys: np.ndarray, most: int) -> np.ndarray:
    """The stable order of keys up to `most`; numpy sorts small types by radix."""
    return np.argsort(keys.astype(np.min_scalar_type(most)), kind="stable")


def log_likelihoods(gru: Gru, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target after its state: of its class, then within it."""
    per = gru.per_class
    classes = targets // per
    out = _log_softmax_at(states @ gru.to_class, gru.class_bias, classes)
    order = _stable_order(classes, len(gru.word_bias))
    states, within = states.take(order, 0), (targets % per).take(order)
    cuts = np.searchsorted(classes.take(order), np.arange(len(gru.word_bias) + 1))
    logs = np.empty_like(out)
    for c in np.flatnonzero(np.diff(cuts)):
        rows = slice(cuts[c], cuts[c + 1])
        logs[rows] = _log_softmax_at(states[rows] @ gru.to_word[c], gru.word_bias[c], within[rows])
    out[order] += logs
    return out


def score_texts(gru: Gru, texts: list[np.ndarray], window: int = 64) -> np.ndarray:
    """Natural log probability of each whole text of token numbers, the last being the end (0).

    All texts run side by side, the longest first, and the state is carried from window to
    window to the end of each; outputs are worked out a window at a time.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate(texts) if texts else np.empty(0, np.int64)
    begins = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    sums = np.zeros(len(texts))
    h = np.zeros((len(texts), gru.back.shape[0]), np.float32)
    for t0 in range(0, int(lengths[0]) if len(texts) else 0, window):
        states, targets, owners, held = [], [], [], 0
        for t in range(t0, min(t0 + window, int(lengths[0]))):
            live = int(np.searchsorted(-lengths, -t))
            read = flat[begins[:live] + t - 1] if t else np.zeros(live, flat.dtype)
            h = _next_states(gru, read, h[:live])
            states.append(h)
            targets.append(flat[begins[:live] + t])
            owners.append(np.arange(live))
            held += live
            if held > 1 << 17 or t + 1 == min(t0 + window, int(lengths[0])):
                logs = log_likelihoods(gru, np.concatenate(states), np.concatenate(targets))
                sums += np.bincount(np.concatenate(owners), logs, len(texts))
                states, targets, owners, held = [], [], [], 0
    out = np.empty(len(texts))
    out[order] = sums
    return out


def train_gru(texts: list[np.ndarray], size: int, s: GruSettings) -> tuple[Gru, dict]:
    """Truncated backpropagation through time with Adagrad on streams of texts laid end to end.

    Returns the weights and the sums of squared gradients.
    """
    gru = new_gru(size, s)
    squares = {k: np.full_like(v, 1e-3) for k, v in vars(gru).items()}
    rng = np.random.default_rng(s.seed)
    for epoch in range(s.epochs if texts else 0):
        flat = np.concatenate([texts[k] for k in rng.permutation(len(texts))])
        _learn(gru, squares, flat, s.streams, s.rate / (1 + epoch), s)
    return gru, squares


def _learn(
    gru: Gru, squares: dict, flat: np.ndarray, streams: int, rate: float, s: GruSettings
) -> None:
    """One pass over texts laid end to end, changing the weights in place. No token is left out:
    the last stream is filled with ends."""
    streams = min(streams, len(flat))
    flat = np.append(flat, np.zeros(-len(flat) % streams, flat.dtype)).reshape(streams, -1)
    h = np.zeros((streams, s.hidden), np.float32)
    for at in range(0, flat.shape[1], s.window):
        target = flat[:, at : at + s.window]
        read = flat[:, at - 1 : at - 1 + target.shape[1]] if at else np.concatenate(
            [np.zeros((streams, 1), flat.dtype), target[:, :-1]], 1
        )
        h, grads = _gradients(gru, read, target, h)
        powers = {k: g * g for k, g in grads.items()}
        total = math.sqrt(sum(float(p.sum()) for p in powers.values()))
        scale = min(1.0, 5.0 / (total + 1e-9))
        for k, g in grads.items():
            power = powers[k]
            if scale < 1:
                g *= scale
                np.multiply(g, g, out=power)
            squares[k] += power
            np.sqrt(squares[k], out=power)
            g *= rate
            g /= power
            vars(gru)[k] -= g


def _gradients(
    gru: Gru, read: np.ndarray, target: np.ndarray, h: np.ndarray
) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The state after a window and the mean gradients in it. An end read clears the state first."""
    n, (streams, steps) = h.shape[1], read.shape
    h = h.T
    kept = []
    states = np.empty((streams, steps, n), np.result_type(h, gru.gates))
    for t in range(steps):
        fresh = (read[:, t] != 0).astype(np.float32)
        before = h * fresh
        state, z, r, c, b = _step(gru, read[:, t], before.T)
        kept.append((before, fresh, z, r, c, b))
        states[:, t] = state
        h = state.T
    grads = {k: np.zeros_like(v) for k, v in vars(gru).items()}
    down = _output_gradients(gru, states.reshape(-1, n), target.reshape(-1), grads).reshape(states.shape)
    later = np.zeros_like(h)
    gates = np.empty((steps, streams, 3 * n), states.dtype)
    for t in reversed(range(steps)):
        before, fresh, z, r, c, b = kept[t]
        d = later + down[:, t].T
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (before - c) * z * (1 - z)
        dr = dc * b * r * (1 - r)
        at_back = np.concatenate([dz, dr, dc * r])
        gates[t, :, : 2 * n] = at_back[: 2 * n].T
        gates[t, :, 2 * n :] = dc.T
        grads["back"] += before @ at_back.T
        later = (d * z + (at_back.T @ gru.back.T).T) * fresh
    _add_by_token(grads["gates"], read.T.reshape(-1), gates.reshape(-1, 3 * n))
    return h.T, grads


def _add_by_token(sums: np.ndarray, token: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to its token's, rounded as by `np.add.reduceat`, which is slow for the many rare tokens."""
    order = _stable_order(token, len(sums))
    ordered = token[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    found, sizes = ordered[first], np.diff(first, append=len(order))
    often = sizes > 8
    if often.any():
        many = sizes[often]
        some = rows.take(order[np.repeat(often, sizes)], 0)
        sums[found[often]] += np.add.reduceat(some, np.cumsum(many) - many)
    by_size = np.argsort(-sizes, kind="stable")[int(often.sum()) :]
    found, first, sizes = found[by_size], first[by_size], sizes[by_size]
    more = int(np.searchsorted(-sizes, -1))
    rest = rows.take(order[first[:more] + 1], 0)
    for k in range(2, 8):
        left = int(np.searchsorted(-sizes, -k))
        rest[:left] += rows.take(order[first[:left] + k], 0)
    part = rows.take(order[first], 0)
    part[:more] += rest
    sums[found] += part


def _output_gradients(
    gru: Gru, states: np.ndarray, targets: np.ndarray, grads: dict[str, np.ndarray]
) -> np.ndarray:
    """Fills the gradients of both softmax layers; returns that of the states."""
    per, size = gru.per_class, np.float32(len(targets))
    classes = targets // per
    order = _stable_order(classes, len(gru.word_bias))
    states, classes, within = states.take(order, 0), classes.take(order), (targets % per).take(order)
    wrong = states @ gru.to_class + gru.class_bias
    _softmax(wrong)
    wrong[np.arange(len(targets)), classes] -= 1
    wrong /= size
    grads["to_class"] += states.T @ wrong
    grads["class_bias"] += wrong.sum(0)
    down = wrong @ gru.to_class.T
    cuts = np.searchsorted(classes, np.arange(len(gru.word_bias) + 1))
    met = np.flatnonzero(np.diff(cuts))
    wrong = np.empty((len(targets), per), wrong.dtype)
    for c in met:
        rows = slice(cuts[c], cuts[c + 1])
        np.matmul(states[rows], gru.to_word[c], out=wrong[rows])
    wrong += gru.word_bias.take(classes, 0)
    _softmax(wrong)
    wrong[np.arange(len(targets)), within] -= 1
    wrong /= size
    for c in met:
        rows = slice(cuts[c], cuts[c + 1])
        part = wrong[rows]
        grads["to_word"][c] += states[rows].T @ part
        grads["word_bias"][c] += part.sum(0)
        down[rows] += part @ gru.to_word[c].T
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return down.take(place, 0)


class _Words:
    """Word hashes of a batch of texts and the cluster of each word."""

    def __init__(self, column: pa.Array, clusters: int):
        data, begins = tokens.packed(column)
        starts, ends, self.first = tokens.words(data, begins)
        self.hashes = tokens.word_hashes(data, starts, ends)
        one, two = data.take(starts).astype(np.int64), data.take(np.minimum(starts + 1, ends - 1))
        self.clusters = _clusters_by_bytes(clusters).take(one << 8 | two)


@functools.lru_cache(maxsize=4)
def _clusters_by_bytes(clusters: int) -> np.ndarray:
    """The cluster of each first two bytes."""
    one, two = np.divmod(np.arange(1 << 16), 256)
    return (_LOWER[one].astype(np.int64) * 257 + _LOWER[two]) * 7919 % 10007 % clusters


@dataclass(frozen=True)
class LanguageModel:
    """Counts of frequent words, the network, and the weight of each cluster's other words.

    An unknown word of a cluster has the cluster's probability after the text so far, times
    its smoothed share (count + 0.5) of the cluster, which keeps 0.5 for unseen words.
    """

    head: np.ndarray
    counts: np.ndarray
    own: int
    mass: np.ndarray
    total: int
    distinct: int
    gru: Gru
    settings: GruSettings

    @property
    def scale(self) -> float:
        """What a smoothed count is divided by to give the base probability."""
        return self.total + 0.5 * (self.distinct + 1)


def count_tokens(docs: DataFrame, s: GruSettings) -> DataFrame:
    """The number of each token in all texts, as stored rows (word, cluster, n); clusters from 0.

    The end has cluster -1. Each task counts its batches; the sums combine before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Words(batch.column("text"), s.clusters)
            found, at, n = np.unique(words.hashes, return_index=True, return_counts=True)
            yield pa.record_batch(
                [
                    pa.array(np.append(found, END).view(np.int64)),
                    pa.array(np.append(words.clusters[at], -1).astype(np.int32)),
                    pa.array(np.append(n, batch.num_rows).astype(np.int64)),
                ],
                names=["word", "cluster", "n"],
            )

    found = docs.select("text").mapInArrow(run, "word long, cluster int, n long")
    found = found.groupBy("word").agg(F.first("cluster").alias("cluster"), F.sum("n").alias("n"))
    return stage(found.where("n > 0"), "token-counts")


def train_model(docs: DataFrame, counts: DataFrame, s: GruSettings) -> LanguageModel:
    """The model of `docs` (text), whose tokens `counts` has.

    The driver gets the `head` most frequent words with counts, one sum for each cluster and the
    sample of token numbers; each has a fixed bound.
    """
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(whole.n or 0), int(whole.v)
    top = _frequent(counts.where("cluster >= 0"), s.head)
    ends = counts.where("cluster < 0").agg(F.sum("n")).first()[0] or 0
    head = np.concatenate([[END], top["word"].to_numpy().view(U64)])
    number = np.concatenate([[ends], top["n"].to_numpy()])
    own = min(s.words, top.num_rows) + 1
    mass = np.full(s.clusters, 0.5)
    sums = counts.where("cluster >= 0").groupBy("cluster").agg(F.sum(F.col("n") + 0.5).alias("m"))
    for row in sums.collect():
        mass[row.cluster] += row.m
    of_own = top["cluster"].to_numpy()[: own - 1]
    mass -= np.bincount(of_own, number[1:own] + 0.5, s.clusters)
    blank = LanguageModel(
        head, number, own, np.maximum(mass, 0.5), total, distinct, new_gru(own + s.clusters, s), s
    )
    texts = int(ends)
    size = min(texts, -(-s.sample * texts // max(1, total)))
    drawn = hashed_sample(docs.select("text").where("text is not null"), max(1, size), ["text"])
    index = tokens.HashIndex(head[:own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Words(batch.column("text"), s.clusters)
            numbers = _own_numbers(words, index.find(words.hashes), blank)
            parts = []
            for a, b in zip(words.first[:-1], words.first[1:]):
                skip = max(0, b - a - s.stretch)
                skip = int(words.hashes[a] % U64(skip + 1)) if skip else 0
                part = numbers[a + skip : min(b, a + skip + s.stretch)]
                parts.append(np.append(part, 0).astype(np.int32))
            yield pa.record_batch([pa.array(parts, pa.list_(pa.int32()))], names=["ids"])

    rows = drawn.mapInArrow(run, "ids array<int>").toArrow()["ids"]
    sample = sorted((x.values.to_numpy().astype(np.int64) for x in rows), key=lambda x: x.tobytes())
    gru, squares = train_gru(sample, own + s.clusters, s)
    for _ in range(s.rounds):
        gru = _round(docs, blank, index, gru, squares)
    return LanguageModel(head, number, own, blank.mass, total, distinct, gru, s)


def _round(
    docs: DataFrame, blank: LanguageModel, index: tokens.HashIndex, gru: Gru, squares: dict
) -> Gru:
    """The mean of the weights that tasks get from `gru` by learning all their texts, by tokens.

    The tasks' weights are stored and added up by tasks, so the driver gets a few rows however many
    tasks there were.
    """
    s = blank.settings
    names = list(vars(gru))
    shapes = [vars(gru)[k].shape for k in names]
    light = replace(blank, head=blank.head[:0], counts=blank.counts[:0], gru=None)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Gru(*[vars(gru)[k].copy() for k in names])
        sums = {k: v.copy() for k, v in squares.items()}
        held, size, seen = [], 0, 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                words = _Words(batch.column("text"), s.clusters)
                numbers = _own_numbers(words, index.find(words.hashes), light)
                # An end after each text; the places are those before the insertion.
                held.append(np.insert(numbers, words.first[1:], 0).astype(np.int32))
                size += len(held[-1])
            if size >= s.buffer or (batch is None and size):
                # Fewer streams make more steps of a small part.
                streams = min(s.wide, max(16, size // (256 * s.window)))
                _learn(mine, sums, np.concatenate(held), streams, s.rate / (1 + s.epochs), s)
                held, size, seen = [], 0, seen + size
        if seen:
            flat = np.concatenate([vars(mine)[k].reshape(-1) for k in names]).astype(np.float64) * seen
            yield pa.record_batch([pa.array([seen]), pa.array([flat.tobytes()])], names=["n", "w"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for seen, flat in zip(*(c.to_pylist() for c in batch.columns)):
                flat = np.frombuffer(flat)
                n, total = n + seen, flat if total is None else total + flat
        if n:
            yield pa.record_batch([pa.array([n]), pa.array([total.tobytes()])], names=["n", "w"])

    shape = "n long, w binary"
    trained = stage(docs.select("text").where("text is not null").mapInArrow(learn, shape), "weights")
    few = trained.mapInArrow(add, shape).repartition(4).mapInArrow(add, shape).collect()
    if not few:
        return gru
    mean = sum(np.frombuffer(r.w) for r in few) / sum(r.n for r in few)
    cuts = np.cumsum([math.prod(x) for x in shapes])[:-1]
    return Gru(*[v.astype(np.float32).reshape(x) for v, x in zip(np.split(mean, cuts), shapes)])


def _frequent(counts: DataFrame, most: int) -> pa.Table:
    """The most frequent words (word, cluster, n), at most `most`, the first the most frequent.

    Words that one text alone would bring are as many as all others, so the least count that
    leaves at most `most` words is found first, from how many words have which count.
    """
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toArrow()
    held = np.cumsum(sizes["words"].to_numpy())
    rank = int(np.searchsorted(held, most, "right"))
    least = int(sizes["n"][rank - 1].as_py()) if rank else 1 << 62
    found = counts.where(F.col("n") >= least).select("word", "cluster", "n").toArrow()
    return found.sort_by([("n", "descending"), ("word", "ascending")])


def _own_numbers(words: _Words, place: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Token numbers of the network: 0 the end, frequent words, then clusters."""
    own = (place >= 0) & (place < model.own)
    return np.where(own, place, model.own + words.clusters)


def _score_parts(model: LanguageModel):
    """Per row everything that the task knows, and the words whose counts it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = tokens.HashIndex(model.head)
        next_row = TaskContext.get().partitionId() << 33
        held, size = [], 0
        for batch in batches:
            held.append(_read(batch, model, index))
            size += sum(len(t) for t in held[-1][1])
            if size >= model.settings.buffer:
                for out in _scored(held, model, next_row):
                    next_row += out.num_rows
                    yield out
                held, size = [], 0
        for out in _scored(held, model, next_row):
            next_row += out.num_rows
            yield out

    return run


def _read(batch: pa.RecordBatch, model: LanguageModel, index: tokens.HashIndex) -> tuple:
    words = _Words(batch.column("text"), model.settings.clusters)
    place = index.find(words.hashes)
    numbers = _own_numbers(words, place, model)
    seen = place >= 0
    log_count = np.log10(model.counts[np.maximum(place, 0)] + 0.5)
    base = np.where(seen, log_count - math.log10(model.scale), 0.0)
    other = numbers >= model.own
    # Of a word outside the network: its share of the cluster, without the count if that is unknown.
    share = np.where(seen, log_count, 0.0) - np.log10(model.mass[words.clusters])
    share = np.where(other, share, 0.0)
    base_end = math.log10((model.counts[0] + 0.5) / model.scale)
    texts, plain, extra, known, rare, rare_n = [], [], [], [], [], []
    for a, b in zip(words.first[:-1], words.first[1:]):
        texts.append(np.append(numbers[a:b], 0).astype(np.int32))
        plain.append(base[a:b].sum() + base_end)
        extra.append(share[a:b].sum())
        known.append(int(seen[a:b].sum()) + int(model.counts[0] > 0))
        w, n = np.unique(words.hashes[a:b][~seen[a:b]], return_counts=True)
        rare.append(w.view(np.int64))
        rare_n.append(n.astype(np.int32))
    return batch.column("doc_id"), texts, plain, extra, known, rare, rare_n


def _scored(held: list[tuple], model: LanguageModel, row: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    logs = score_texts(model.gru, [t for x in held for t in x[1]]) / math.log(10)
    at = 0
    for ids, texts, plain, extra, known, rare, rare_n in held:
        mine = logs[at : at + len(texts)] + np.array(extra)
        at += len(texts)
        yield pa.record_batch(
            [
                ids,
                pa.array(np.arange(row, row + len(texts))),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(plain, pa.float64()),
                pa.array(mine, pa.float64()),
                pa.array(rare, pa.list_(pa.int64())),
                pa.array(rare_n, pa.list_(pa.int32())),
            ],
            names=["doc_id", "row", "n_tokens", "known", "base", "model", "rare", "rare_n"],
        )
        row += len(texts)


def score_documents(
    docs: DataFrame,
    training: DataFrame,
    settings: GruSettings = GruSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Base and model log10 probability of every whole text, learned from `training` (text).

    Words are lower-cased (A-Z); each text ends with one end token, so null and empty texts have one
    token. Without training texts every base probability is 1 and the network is untrained.
    Equal texts score alike; repeated rows each get a row; empty tables give no rows. Columns
    other than id and text are not read. Words are told apart by 64-bit hashes.

    Counts cover all training texts. Frequent words' counts go to the tasks; the other words of each
    row meet the stored counts in a join, so neither side is held whole anywhere.
    """
    s = settings
    bounded_batches(docs.sparkSession)
    training = training.select(F.col(text_column).alias("text"))
    counts = count_tokens(training, s)
    model = train_model(training, counts, s)
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    parts = narrow.mapInArrow(
        _score_parts(model),
        f"doc_id {kind}, row long, n_tokens long, known long, base double, model double, "
        "rare array<long>, rare_n array<int>",
    )
    parts = stage(parts, "text-scores")
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("times")
    )
    smooth = F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))
    sums = (
        rare.join(counts.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * smooth).alias("rare_log"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum("times").alias("rare_times"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    scale = math.log10(model.scale)
    return parts.drop("rare", "rare_n").join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + zero(F.col("rare_known"))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero(F.col("rare_log")) - zero(F.col("rare_times")) * scale).alias("base_score"),
        (F.col("model") + zero(F.col("rare_log"))).alias("score"),
    )
