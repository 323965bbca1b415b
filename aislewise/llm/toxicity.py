"""Toxicity by a subsequence-kernel support vector machine on Nystrom landmarks."""

from __future__ import annotations

import dataclasses
import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import bounded_batches, hashed_sample

#: Letters of one window; longer words are cut into windows that overlap by half.
WINDOW = 16
CACHE = 400_000
TOXIC_WEIGHT = 20.0


@dataclass(frozen=True)
class ToxicitySettings:
    """Kernel and training.

    `length` letters to a subsequence, weight `decay` for each letter it spans. `sample`
    bounds the labelled documents per label, `landmarks` the strings that stand for all.
    """

    length: int = 3
    decay: float = 0.6
    sample: int = 800
    landmarks: int = 200
    rounds: int = 3
    regular: float = 1e-4


class Subsequences:
    """The subsequence kernel with a fixed set of strings, by its explicit features.

    The kernel sums, over all strings of `length` letters, the product of their weights on both
    sides; a string weighs decay to the power of the letters that each occurrence spans.
    The fixed strings have few letters, so their weights are a dense table by letter codes;
    other strings look up all their subsequences, which costs no more with more fixed strings.
    """

    def __init__(self, fixed: tuple[str, ...], s: ToxicitySettings):
        self.s, self.fixed = s, fixed
        self.letters = np.array(sorted({ord(c) for t in fixed for c in t}), np.int64)
        self.base = len(self.letters) + 1
        used = [self._codes([t]) for t in fixed]
        self.known = np.unique(np.concatenate([c.ravel() for c, _ in used]))
        table = np.zeros((len(self.known) + 1, len(fixed)))
        for k, (codes, weights) in enumerate(used):
            np.add.at(table[:, k], np.searchsorted(self.known, codes[0]), weights)
        norm = np.sqrt(np.maximum((table**2).sum(0), 1e-12))
        self.table = table / norm
        self.rows = np.full(self.base**s.length, len(self.known), np.int32)
        self.rows[self.known] = np.arange(len(self.known))

    def _codes(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all subsequences of strings of one length, and their weights.

        Letters of no fixed string have digit 0, which no known code has.
        """
        size = len(strings[0])
        picks = _picks(size, self.s.length)
        points = _points(strings)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        digits = np.where(self.letters[at] == points, at + 1, 0).astype(np.int32)
        out = np.zeros((len(strings), len(picks)), np.int32)
        for k in range(self.s.length):
            out *= self.base
            out += digits[:, picks[:, k]]
        return out, self.s.decay ** (picks[:, -1] - picks[:, 0] + 1.0)

    def norms(self, strings: list[str]) -> np.ndarray:
        """Length in feature space of strings of one length: the root of the kernel with itself."""
        points, size = _points(strings), len(strings[0])
        same = (points[:, :, None] == points[:, None, :]).astype(np.float32)
        gap = np.arange(size + 1)[:, None] - np.arange(size)[None, :]
        fall = np.where(gap > 0, self.s.decay ** np.maximum(gap, 0), 0).astype(np.float32)
        # tails[p, q]: common subsequences of the first p and q letters, each letter of gap counted.
        tails = np.ones((len(strings), size + 1, size + 1), np.float32)
        for _ in range(1, self.s.length):
            tails = fall @ (same * tails[:, :size, :size]) @ fall.T
        return np.sqrt((same * tails[:, :size, :size]).sum((1, 2))) * self.s.decay

    def apply(self, strings: list[str], columns: np.ndarray) -> np.ndarray:
        """Normalised kernel with the fixed strings, times `columns` (fixed strings x outputs).

        0 for strings shorter than a subsequence; 1 before `columns` for equal strings.
        """
        table = (self.table @ columns).astype(np.float32)
        narrow = table[self.rows, 0] if table.shape[1] == 1 else None
        out = np.zeros((len(strings), columns.shape[1]), np.float32)
        groups: dict[int, list[int]] = {}
        for k, t in enumerate(strings):
            groups.setdefault(len(t), []).append(k)
        for size, every in groups.items():
            if size < self.s.length:
                continue
            for at in range(0, len(every), 1024):
                part = every[at : at + 1024]
                some = [strings[k] for k in part]
                codes, weights = self._codes(some)
                weights = weights.astype(np.float32)
                if narrow is not None:
                    got = (narrow[codes] @ weights)[:, None]
                else:
                    got = np.zeros((len(part), table.shape[1]), np.float32)
                    for k, row in enumerate(self.rows[codes]):
                        hit = row < len(self.known)
                        got[k] = weights[hit] @ table[row[hit]]
                out[part] = got / self.norms(some)[:, None]
        return out


def _points(strings: list[str]) -> np.ndarray:
    """Code points of strings of one length, a string a row."""
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points.astype(np.int64).reshape(len(strings), -1)


@functools.cache
def _picks(size: int, length: int) -> np.ndarray:
    """All ways to choose `length` places of `size`, in order."""
    found = list(itertools.combinations(range(size), length))
    return np.array(found, np.int64).reshape(-1, length)


@dataclass(frozen=True)
class ToxicityModel:
    subsequences: Subsequences
    #: Weight of the normalised kernel with each landmark, and the bias.
    alpha: np.ndarray
    bias: float
    #: Logistic weights of the document's summary, last the constant.
    doc_weights: np.ndarray


def windows(text: str) -> list[str]:
    """The strings that are scored: words without marks, and runs of single letters joined.

    "i.d.i.o.t" and "i d i o t" both become "idiot".
    """
    found, run = [], []
    for word in text.lower().split():
        letters = word if word.isalpha() else "".join(filter(str.isalpha, word))
        if len(letters) == 1:
            run.append(letters)
            continue
        if len(run) > 2:
            found += _cut("".join(run))
        run.clear()
        if letters:
            found += _cut(letters)
    if len(run) > 2:
        found += _cut("".join(run))
    return found


def _cut(letters: str) -> list[str]:
    if len(letters) <= WINDOW:
        return [letters]
    half = WINDOW // 2
    return [letters[k : k + WINDOW] for k in range(0, len(letters) - half, half)]


def summary(scores: np.ndarray) -> np.ndarray:
    """What the document's probability rests on: best windows, and how many are toxic."""
    if not len(scores):
        return np.array([-1.0, -1.0, -1.0, 0.0, 0.0])
    top = np.sort(np.partition(scores, -3)[-3:])[::-1] if len(scores) > 3 else np.sort(scores)[::-1]
    top = np.concatenate([top, np.full(3 - len(top), min(-1.0, top[-1]))])
    toxic = float((scores > 0).sum())
    return np.array([*top, np.log1p(toxic), toxic / len(scores) * 10])


def train_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()
) -> ToxicityModel | None:
    """A model from docs (doc_id, text) and labels (doc_id, toxic); None without both labels.

    At most about `sample` documents of each label are drawn by hash, whole. A repeated id
    counts once, as toxic if any of its labels is; null labels don't count.
    """
    marks = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    ids = docs.select("doc_id").distinct().join(marks, "doc_id")
    ids = ids.select("doc_id", (F.col("toxic") > 0).alias("toxic"))
    sizes = {r.toxic: r["count"] for r in ids.groupBy("toxic").count().collect()}
    drawn = F.broadcast(hashed_sample(ids, settings.sample, ["doc_id"], ["toxic"]))
    rows = (
        docs.select("doc_id", "text")
        .where("text is not null")
        .join(drawn, "doc_id")
        .groupBy("doc_id")
        .agg(F.first("text").alias("text"), F.first("toxic").alias("toxic"))
        .collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    bad = [r.text for r in rows if r.toxic]
    good = [r.text for r in rows if not r.toxic]
    if not bad or not good:
        return None
    return fit_toxicity(bad, good, settings, sizes[True] / (sizes[True] + sizes[False]))


def fit_toxicity(
    bad: list[str], good: list[str], s: ToxicitySettings, prior: float
) -> ToxicityModel:
    """Landmarks, then rounds of "which window of each toxic sentence is it" and of fitting.

    `prior` is the share of toxic documents where the samples come from. Between rounds the
    harmless windows that score highest become landmarks, so that the machine can tell
    them from the insults they resemble.
    """
    in_bad = Counter(w for t in bad for w in set(windows(t)))
    in_good = Counter(w for t in good for w in set(windows(t)))

    def lift(w: str) -> float:
        return np.log((in_bad[w] + 0.1) / len(bad)) - np.log((in_good[w] + 0.5) / len(good))

    evidence = {w: lift(w) for w in in_bad if in_bad[w] > 1 or len(bad) < 50}
    positive = [x for x in (_sentence(t, evidence) for t in bad) if x]
    known = sorted({w for x in positive for w in x} | in_good.keys() | evidence.keys())
    place = {w: k for k, w in enumerate(known)}
    no = np.array([place[w] for w in sorted(in_good)], int)
    of_no = np.array([in_good[w] / len(good) for w in sorted(in_good)])
    chosen = [max(x, key=lambda w: (evidence.get(w, -9.0), w)) for x in positive]
    # Insults that several documents share stay examples, whatever the machine makes of them.
    enough = max(3, len(bad) // 100)
    clear = [w for w in evidence if in_bad[w] >= enough and lift(w) > 3]
    clear = [w for w in sorted(clear) for _ in range(in_bad[w])]
    long_ = lambda c: [w for w in c if len(w) >= s.length]
    telling = sorted(
        (w for w in long_(evidence) if lift(w) > 1),
        key=lambda w: (in_bad[w] * lift(w), w),
        reverse=True,
    )
    plain = sorted(long_(in_good), key=lambda w: (in_good[w], w), reverse=True)
    third = s.landmarks // 3
    marks = telling[:third] + [w for w in plain if lift(w) < 0.5][: third // 2] or ["aaa"]
    for k in range(s.rounds):
        subsequences = Subsequences(tuple(marks), s)
        gram = subsequences.apply(marks, np.eye(len(marks))).astype(np.float64)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
        space = subsequences.apply(known, root)
        yes = np.array([place[w] for w in chosen + clear if w in place], int)
        weights, bias = _svm(space, yes, no, of_no, s)
        score = space @ weights + bias
        chosen = [max(x, key=lambda w: (score[place[w]], w)) for x in positive]
        hard = [w for w in np.argsort(-score[no] * np.sqrt(of_no), kind="stable")]
        if k < s.rounds - 1:
            fresh = (known[no[h]] for h in hard)
            have = set(marks)
            fresh = (w for w in fresh if w not in have and len(w) >= s.length and lift(w) < 1)
            marks = marks + list(itertools.islice(fresh, (s.landmarks - len(marks)) // (s.rounds - 1 - k)))
    model = ToxicityModel(subsequences, root @ weights, float(bias), np.zeros(6))
    score_of = WindowScores(model)
    shape = np.array([summary(x) for x in score_of(bad + good)])
    truth = np.r_[np.ones(len(bad)), np.zeros(len(good))]
    weight = np.where(truth > 0, prior / len(bad), (1 - prior) / len(good)) * len(truth)
    return dataclasses.replace(model, doc_weights=_logistic(shape, truth, weight))


def _sentences(text: str) -> list[list[str]]:
    return [w for w in map(windows, re.split(r"(?<=[.!?])\s|\n", text)) if w]


def _sentence(text: str, evidence: dict[str, float]) -> list[str]:
    """The sentence of a toxic document that holds its most telling window, if one tells."""
    best = max(_sentences(text), key=lambda x: max(evidence.get(w, -9.0) for w in x), default=[])
    return best if best and max(evidence.get(w, -9.0) for w in best) > 1 else []


def _svm(
    space: np.ndarray, yes: np.ndarray, no: np.ndarray, of_no: np.ndarray, s: ToxicitySettings
) -> tuple[np.ndarray, float]:
    """Squared hinge loss by Newton steps on the rows inside the margin.

    A harmless window weighs by the documents that have it, all insults together as TOXIC_WEIGHT
    harmless windows that every document has.
    """
    width = space.shape[1] + 1
    if not len(yes) or not len(no):
        return np.zeros(width - 1), -1.0
    rows = np.r_[yes, no]
    y = np.r_[np.ones(len(yes)), -np.ones(len(no))]
    c = np.r_[np.full(len(yes), TOXIC_WEIGHT / len(yes)), of_no]
    w, before = np.zeros(width), None
    for step in range(30):
        bend, pull = np.diag(np.full(width, s.regular)), np.zeros(width)
        inside = np.empty(len(rows), bool)
        for at in range(0, len(rows), 8192):
            part = slice(at, at + 8192)
            x = np.c_[space[rows[part]].astype(np.float64), np.ones(len(rows[part]))]
            inside[part] = hit = y[part] * (x @ w) < 1
            x, weight = x[hit], c[part][hit]
            bend += (x * weight[:, None]).T @ x
            pull += x.T @ (weight * y[part][hit])
        if before is not None and (inside == before).all():
            break
        before = inside
        full = np.linalg.solve(bend, pull)
        w = full if step < 5 else (w + full) / 2
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps for a weighted logistic model with a constant and a little shrinkage."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.1 * w
        bend = (x * (weight * p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


class WindowScores:
    """Decision values of the windows of texts; a window seen before is looked up.

    The store is emptied when it would hold more than CACHE windows, so its memory is bounded.
    """

    def __init__(self, model: ToxicityModel):
        self.model, self.seen = model, {}

    def _learn(self, words: set[str]) -> None:
        new = sorted(words - self.seen.keys())
        if len(self.seen) + len(new) > CACHE:
            self.seen.clear()
            new = sorted(words)
        m = self.model
        values = m.subsequences.apply(new, m.alpha[:, None])[:, 0] + m.bias
        self.seen.update(zip(new, values.tolist()))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the values of its windows. New ones are worked out many at a time."""
        out: list[np.ndarray] = []
        waiting: list[list[str]] = []
        fresh: set[str] = set()
        for text in texts:
            waiting.append(windows(text or ""))
            fresh.update(waiting[-1])
            if len(fresh) > CACHE // 4:
                out += self._values(waiting, fresh)
                waiting, fresh = [], set()
        return out + self._values(waiting, fresh)

    def _values(self, waiting: list[list[str]], fresh: set[str]) -> list[np.ndarray]:
        self._learn(fresh)
        return [np.array([self.seen[w] for w in words], np.float64) for words in waiting]


def _probabilities(model: ToxicityModel | None, texts: list, scores: WindowScores) -> list[float]:
    """Of each text; a text without windows has the value of no evidence, no model 0."""
    if model is None:
        return [0.0] * len(texts)
    shape = np.array([summary(x) for x in scores(texts)]).reshape(len(texts), -1)
    x = shape @ model.doc_weights[:-1] + model.doc_weights[-1] if len(texts) else np.empty(0)
    return (1 / (1 + np.exp(-np.clip(x, -30, 30)))).tolist()


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """For every row its id as `doc_id`, the `score` (0 to 1) and `predicted` (1 from 0.5 on).

    Whole texts are used. Null and empty texts get the score of no evidence; everything gets
    0 if there was nothing to learn from. Equal texts score alike. Empty tables give no
    rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WindowScores(model)
        for batch in batches:
            p = _probabilities(model, batch.column("text").to_pylist(), scores)
            columns = [batch.column("doc_id"), pa.array(p, pa.float64())]
            columns.append(pa.array([int(v >= 0.5) for v in p], pa.int32()))
            yield pa.record_batch(columns, names=["doc_id", "score", "predicted"])

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def drop_toxic(
    docs: DataFrame, model: ToxicityModel | None, text_column: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows that score below `least`, with all their columns; see `score_toxicity`."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WindowScores(model)
        for batch in batches:
            p = _probabilities(model, batch.column(at).to_pylist(), scores)
            yield batch.filter(pa.array([v < least for v in p], pa.bool_()))

    names = [f"c{k}" for k in range(len(docs.columns))]
    kept = docs.toDF(*names)
    return kept.mapInArrow(run, kept.schema).toDF(*docs.columns)
