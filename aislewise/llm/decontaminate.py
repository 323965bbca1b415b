"""Benchmark decontamination by SimHash windows, multi-index lookup and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm import tokens
from aislewise.llm.common import bounded_batches

U64 = np.uint64
BLOCKS = 8


@dataclass(frozen=True)
class LeakRule:
    """Words to a shingle, least similarity, and bytes of benchmark text for one pass.

    `radius` is the Hamming distance within which fingerprints are candidates. At similarity
    0.8 the expected distance is 9.6 of 64 bits with a deviation of 2.9. The eight blocks of
    eight bits are searched up to distance `radius // 8`, which finds every fingerprint
    within `radius`: more bits than that would differ in every block by more.
    """

    words: int = 5
    similarity: float = 0.8
    radius: int = 23
    pass_bytes: int = 16 << 20


class BenchmarkIndex:
    """Items of a bounded part of the benchmark, ready for lookup.

    A shingle weighs 1 + ln(items / items that have it), so that phrases of many items
    count less; shingles of no item weigh as those of one.
    """

    def __init__(self, ids: list[int], texts: list[str], rule: LeakRule):
        self.rule = rule
        data, begins = tokens.packed(pa.array(texts, pa.string()))
        starts, ends, first = tokens.words(data, begins, marks=True)
        hashes = tokens.word_hashes(data, starts, ends)
        each = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        keep = [k for k, h in enumerate(each) if len(h)]
        self.ids = [ids[k] for k in keep]
        self.sizes = np.array([len(each[k]) for k in keep], np.int64)
        self.widths = np.minimum(self.sizes, rule.words)
        self.shingles = [tokens.shingles(each[k], rule.words) for k in keep]
        distinct = [np.unique(s) for s in self.shingles] or [np.empty(0, U64)]
        known, held = np.unique(np.concatenate(distinct), return_counts=True)
        self.places = tokens.HashIndex(known)
        self.most = 1 + np.log(max(1, len(self.ids)))
        self.weights = (1 + np.log(max(1, len(self.ids)) / held)).astype(np.float64)
        #: A bit for the size of each item that has the shingle; sizes may share one.
        self.of_size = np.zeros(len(known), U64)
        for grams, size in zip(distinct, self.sizes):
            self.of_size[np.searchsorted(known, grams)] |= U64(1 << int(size) % 64)
        self.prints = np.array(
            [simhash(s, self.weigh(s)[0]) for s in self.shingles], U64
        ).reshape(-1)
        self.tables = [self._near(b) for b in range(BLOCKS)]

    def weigh(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of shingles, and the sizes of the items that have them, as bits."""
        at = self.places.find(shingles)
        known = np.flatnonzero(at >= 0)
        out, sizes = np.full(len(shingles), self.most), np.zeros(len(shingles), U64)
        out[known] = self.weights[at[known]]
        sizes[known] = self.of_size[at[known]]
        return out, sizes

    def _near(self, block: int) -> list[np.ndarray]:
        """For each value of a block the items whose block is within the block radius."""
        values = (self.prints >> U64(8 * block)) & U64(255)
        apart = _BITS[np.arange(256)[:, None] ^ values.astype(np.int64)[None, :]]
        return [np.flatnonzero(row <= self.rule.radius // BLOCKS) for row in apart]

    def near(self, fingerprint: int) -> np.ndarray:
        """All items whose fingerprint is within the radius."""
        found = [self.tables[b][fingerprint >> (8 * b) & 255] for b in range(BLOCKS)]
        items = np.unique(np.concatenate(found))
        apart = np.bitwise_count(self.prints[items] ^ U64(fingerprint))
        return items[apart <= self.rule.radius]


_BITS = np.array([bin(v).count("1") for v in range(256)], np.int64)


def simhash(shingles: np.ndarray, weights: np.ndarray) -> int:
    """64 signs of the weighted sums of the shingles' bits."""
    bits = np.unpackbits(tokens.mix(shingles)[:, None].view(np.uint8), axis=1, bitorder="little")
    sums = weights @ (bits.astype(np.float64) * 2 - 1)
    return int(np.packbits(sums > 0, bitorder="little").view(U64)[0])


def similarity(x: np.ndarray, y: np.ndarray, index: BenchmarkIndex) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    every, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    weights = index.weigh(every)[0]
    of_x = np.bincount(at[: len(x)], minlength=len(every))
    of_y = np.bincount(at[len(x) :], minlength=len(every))
    return float(weights @ np.minimum(of_x, of_y) / (weights @ np.maximum(of_x, of_y)))


def leaks(hashes: np.ndarray, index: BenchmarkIndex) -> dict[int, tuple[float, int]]:
    """Similarity and first word of the best window for each item that a text contains.

    Windows as long as an item slide over the whole text and are held against the items of
    that length. Where shingles of such items make up less than the threshold's share of a
    window's weight, none of them can reach the threshold; the fingerprint is made for the
    other windows only.
    """
    best: dict[int, tuple[float, int]] = {}
    for width in np.unique(index.widths):
        if len(hashes) < width:
            continue
        grams = tokens.shingles(hashes, int(width))
        weights, bits = index.weigh(grams)
        here = int(np.bitwise_or.reduce(bits))
        if not here:
            continue
        total = np.concatenate(([0.0], np.cumsum(weights)))
        for size in np.unique(index.sizes[index.widths == width]).tolist():
            span = size - width + 1
            if len(grams) < span or not here >> size % 64 & 1:
                continue
            known = (bits >> U64(size % 64) & U64(1)).astype(np.float64)
            hits = np.concatenate(([0.0], np.cumsum(weights * known)))
            whole, hit = total[span:] - total[:-span], hits[span:] - hits[:-span]
            for at in np.flatnonzero(hit >= index.rule.similarity * whole - 1e-9):
                window = grams[at : at + span]
                items = index.near(simhash(window, weights[at : at + span]))
                for item in items[index.sizes[items] == size]:
                    value = similarity(window, index.shingles[item], index)
                    if value >= index.rule.similarity and value > best.get(item, (0.0, 0))[0]:
                        best[item] = (value, int(at))
    return best


def _scan(index: BenchmarkIndex, column: pa.Array) -> Iterator[dict[int, tuple[float, int]]]:
    data, begins = tokens.packed(column)
    starts, ends, first = tokens.words(data, begins, marks=True)
    hashes = tokens.word_hashes(data, starts, ends)
    for a, b in zip(first[:-1], first[1:]):
        yield leaks(hashes[a:b], index)


def benchmark_passes(benchmark: DataFrame, rule: LeakRule) -> Iterator[BenchmarkIndex]:
    """The whole benchmark as indexes of about `pass_bytes` of text each.

    Each goes to the tasks of one pass over the documents, so what is sent at once does
    not grow with the benchmark. Items without words match nothing.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // rule.pass_bytes)
    part = F.pmod(F.xxhash64("text"), F.lit(max(1, n)))
    for k in range(n):
        rows = items.where(part == k).distinct().collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        yield BenchmarkIndex([r.item_id for r in rows], [r.text for r in rows], rule)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rule: LeakRule = LeakRule(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, similarity, first_word, n_words): the best window of each item found.

    Words are runs of letters and digits in lower case (ASCII marks and white space part
    them). A document's row appears once for each item it has; repeated rows repeat, of
    windows that tie the first counts. Null and empty texts and items give nothing, as do
    empty tables. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    shape = f"doc_id {kind}, item_id long, similarity double, first_word long, n_words long"
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def scan(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (k, index.ids[i], value, at, int(index.sizes[i]))
                    for k, found in enumerate(_scan(index, batch.column("text")))
                    for i, (value, at) in sorted(found.items())
                ]
                k, item, value, at, size = zip(*rows) if rows else [()] * 5
                columns = [batch.column("doc_id").take(pa.array(k, pa.int64()))]
                columns += [pa.array(item, pa.int64()), pa.array(value, pa.float64())]
                columns += [pa.array(at, pa.int64()), pa.array(size, pa.int64())]
                names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                yield pa.record_batch(columns, names=names)

        return run

    found = narrow.sparkSession.createDataFrame([], shape)
    for index in benchmark_passes(benchmark, rule):
        found = found.unionByName(narrow.mapInArrow(scan(index), shape))
    return found


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, rule: LeakRule = LeakRule(), text_column: str = "text"
) -> DataFrame:
    """The rows that contain no benchmark item, with all their columns; see `find_leaks`."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_column)

    def clean(index: BenchmarkIndex):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = [not found for found in _scan(index, batch.column(at))]
                yield batch.filter(pa.array(good, pa.bool_()))

        return run

    names = [f"c{k}" for k in range(len(docs.columns))]
    kept = docs.toDF(*names)
    for index in benchmark_passes(benchmark, rule):
        kept = kept.mapInArrow(clean(index), kept.schema)
    return kept.toDF(*docs.columns)
