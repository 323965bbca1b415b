"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm import tokens
from aislewise.llm.common import bounded_batches, hashed_sample

U64 = np.uint64
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """Shape and training of the model.

    `sample` bounds the labelled documents per language that are fitted on, `held` the share
    of them that calibrates. `kept` is the share of calibration documents of the right
    language that rejection must let pass.
    """

    buckets: int = 1 << 14
    width: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    sample: int = 400
    epochs: int = 6
    rate: float = 0.5
    held: float = 0.25
    kept: float = 0.998
    seed: int = 1


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: Embedding times softmax weights: what a subword of each bucket adds to each language.
    votes: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Documents of lower score are rejected.
    least: float
    settings: LanguageSettings


#: Code points for hashing: white space, digits and punctuation become one word mark.
_FOLD = np.arange(0x3000, dtype=np.uint32)
for _c in range(0x3000):
    _ch = chr(_c).lower()
    _FOLD[_c] = ord(_ch[0]) if _ch[0].isalpha() else 0x20


def _code_points(text: str) -> np.ndarray:
    """Letters in lower case, runs of anything else as one space, a space at both ends."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    low = points < len(_FOLD)
    folded = np.where(low, _FOLD[np.where(low, points, 0)], points)
    space = folded == 0x20
    return folded[~(space & np.concatenate(([False], space[:-1])))]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def subwords(text: str, settings: LanguageSettings) -> np.ndarray:
    """Buckets of all character n-grams within words, word ends marked; repeated ones repeat."""
    points = _code_points(text).astype(U64)
    space = points == 0x20
    out = []
    for n in settings.sizes:
        m = len(points) - n + 1
        if m <= 0:
            continue
        value, broken = np.full(m, n, U64), np.zeros(m, bool)
        for k in range(n):
            value = value * U64(tokens.BASE) + points[k : k + m]
            if 0 < k < n - 1:
                broken |= space[k : k + m]
        out.append(value[~broken])
    grams = np.concatenate(out) if out else np.empty(0, U64)
    return (tokens.mix(grams) % U64(settings.buckets)).astype(np.int64)


def _features(settings: LanguageSettings):
    """Per document its distinct subword buckets and their shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, share = [], []
            for text in batch.column("text").to_pylist():
                places, counts = np.unique(subwords(text, settings), return_counts=True)
                at.append(places.astype(np.int32))
                share.append((counts / max(1, counts.sum())).astype(np.float32))
            yield pa.record_batch(
                [batch.column("lang"), pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))],
                names=["lang", "at", "share"],
            )

    return run


def train_languages(
    docs: DataFrame, settings: LanguageSettings = LanguageSettings()
) -> LanguageModel | None:
    """A model from `docs` (text, lang); None if no row has both.

    At most about `sample` documents of each language are drawn by hash, whole; Spark turns
    them into bucket shares, and the driver fits those.
    """
    bounded_batches(docs.sparkSession)
    labelled = docs.select("text", "lang").where("lang is not null and text rlike '\\\\p{L}'")
    drawn = hashed_sample(labelled, settings.sample, ["text"], ["lang"])
    rows = drawn.mapInArrow(
        _features(settings), "lang string, at array<int>, share array<float>"
    ).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.at))
    languages = tuple(sorted({r.lang for r in rows}))
    data = [
        (np.array(r.at, np.int64), np.array(r.share, np.float32), languages.index(r.lang))
        for r in rows
    ]
    return _fit(data, languages, settings)


def _fit(data: list, languages: tuple[str, ...], s: LanguageSettings) -> LanguageModel:
    """Stochastic gradient descent on the cross entropy, one document at a time."""
    rng = np.random.default_rng(s.seed)
    table = rng.uniform(-1, 1, (s.buckets, s.width)).astype(np.float32) / s.width
    weights = np.zeros((s.width, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    order = rng.permutation(len(data))
    held = order[: int(len(data) * s.held)]
    learn = order[len(held) :]
    steps, step = s.epochs * len(learn), 0
    for _ in range(s.epochs):
        for i in rng.permutation(learn):
            at, share, y = data[i]
            rate = s.rate * (1 - step / steps)
            hidden = share @ table[at]
            wrong = _softmax(hidden @ weights + bias)
            wrong[y] -= 1
            back = weights @ wrong
            weights -= rate * np.outer(hidden, wrong)
            bias -= rate * 0.1 * wrong
            # The shares are small, so the mean's gradient is scaled up to the table's size.
            table[at] -= rate * np.outer(share * np.float32(len(at) ** 0.5), back)
            step += 1
    votes = table @ weights
    logits = np.array([share @ votes[at] + bias for at, share, _ in (data[i] for i in held)])
    right = np.array([data[i][2] for i in held], int)
    temperature, least = _calibrate(logits.reshape(-1, len(languages)), right, s.kept)
    return LanguageModel(languages, votes, bias, temperature, least, s)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _calibrate(logits: np.ndarray, right: np.ndarray, kept: float) -> tuple[float, float]:
    """The temperature of least cross entropy, and the score that a share `kept` of right ones reach.

    Too few documents leave temperature 1 and a bound below every certain prediction.
    """
    even = 1 / max(1, logits.shape[1])
    if len(right) < 20:
        return 1.0, min(0.5, even)
    rows = np.arange(len(right))
    losses = {
        t: -np.log(_softmax(logits / t)[rows, right] + 1e-12).mean()
        for t in np.geomspace(0.1, 10, 41)
    }
    best = min(losses, key=losses.get)
    p = _softmax(logits / best)
    score = p.max(1)[p.argmax(1) == right]
    least = np.quantile(score, 1 - kept) if len(score) else even
    return float(best), float(min(least, 0.5))


def predict(text: str | None, model: LanguageModel | None) -> tuple[str, float, bool]:
    """Language, its probability, and whether the document is accepted.

    `und`, 0 and rejected where there is no text, no letter or no model.
    """
    if model is None or not has_letter(text):
        return UNKNOWN, 0.0, False
    total, n = np.zeros(len(model.languages)), 0
    for part in _parts(text):
        at = subwords(part, model.settings)
        total += np.bincount(at, minlength=len(model.votes)) @ model.votes
        n += len(at)
    p = _softmax((total / max(1, n) + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best]), bool(p[best] >= model.least)


def _parts(text: str, size: int = 1 << 18) -> Iterator[str]:
    """The whole text in pieces, cut at spaces where there are any, so memory stays bounded."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        if end < len(text):
            end = max(text.rfind(" ", at, end), at) or end
            end = end if end > at else min(len(text), at + size)
        yield text[at:end]
        at = end


def _predictions(batch: pa.Array, model: LanguageModel | None) -> tuple[list, list, list]:
    found = [predict(t, model) for t in batch.to_pylist()]
    return [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]


def identify_languages(
    docs: DataFrame, model: LanguageModel | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """For every row its id as `doc_id`, `lang_pred`, `score` and `accepted`.

    Texts are used whole. Null and letterless texts get `und`, score 0 and are not accepted;
    so does everything if there was nothing to learn from. Rows of equal text get equal
    results, ties go to the language first in the alphabet. Empty tables give no rows and other
    columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, accepted = _predictions(batch.column("text"), model)
            columns = [batch.column("doc_id"), pa.array(lang, pa.string())]
            columns += [pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.record_batch(columns, names=["doc_id", "lang_pred", "score", "accepted"])

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, accepted boolean"
    )


def keep_identified(
    docs: DataFrame, model: LanguageModel | None, text_column: str = "text"
) -> DataFrame:
    """The rows whose language is accepted, with all their columns; see `identify_languages`."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            accepted = _predictions(batch.column(at), model)[2]
            yield batch.filter(pa.array(accepted, pa.bool_()))

    names = [f"c{k}" for k in range(len(docs.columns))]
    kept = docs.toDF(*names)
    return kept.mapInArrow(run, kept.schema).toDF(*docs.columns)
