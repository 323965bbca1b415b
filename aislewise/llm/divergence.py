"""How the term use of each source departs from the other sources of its language.

Late string materialization. One pass over the texts counts terms and stores two narrow tables: counts
by group and 64-bit term digest, and the terms themselves, each about once a task. Counting, document
frequencies, probabilities, divergences and the choice of what to return shuffle digests and numbers
only. The minimum and the maximum term of a digest tell whether two terms share it; such digests are
split by their terms in a second pass, so no result rests on luck. Text is joined back for the rows
that stay.

Everything is whole-number arithmetic. The sum over all terms of a language is taken sparsely: most
terms of most sources have no count there, and their share is one product.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewise.llm.common import bounded_batches, stage
from aislewise.llm.tokens import BASE, U64, mix

TERM = re.compile(rb"[a-z\x80-\xff]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SCALE = 1_000_000_000
COUNTED = "kind string, gid long, digest long, n long, docs long, term binary"
GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
_IS_TERM = np.zeros(256, bool)
_IS_TERM[97:123] = _IS_TERM[128:] = True
#: Masks of the first 0 to 8 bytes of a number's eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
#: Bytes of text counted at once.
GATHER = 12 << 20
#: Terms that a task remembers to have named.
MOST_TOLD = 1_000_000


@dataclass(frozen=True)
class AuditRule:
    """`min_docs` documents of a language must hold a term; `ranks` terms of a group are returned.

    `digest_bits` shortens the digests, so that tests see terms sharing one.
    """

    min_docs: int = 3
    ranks: int = 200
    digest_bits: int = 64


def audit_sources(docs: DataFrame, rule: AuditRule = AuditRule()) -> DataFrame:
    """lang, source, part, item, value, rank of every language and source of `docs`.

    Part `pair` has one row for each other source of the language: the divergence from it over
    all kept terms. Part `term` has the terms that the source uses more than its language does, by
    their share of the divergence from the language, the first `ranks` of them.

    Null text, lang and source count as empty. Repeated rows count each, also those of equal id.
    Equal values are ranked by the bytes of the item. A source without terms, or a language without
    kept terms, has its pairs. An empty table has no rows. Very long texts are counted in one go by the
    task that reads them. Columns besides text, lang and source are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    groups, seed = _groups(texts)
    keyed = texts.select(
        _group_id(seed).alias("gid"), F.col("text").cast("binary").alias("text")
    )
    shift = 64 - rule.digest_bits
    counted = keyed.mapInArrow(lambda batches: _count(batches, shift), COUNTED)
    stored = stage(counted, "terms")
    numbers = stored.where("kind = 'count'").select("gid", "digest", F.lit(0).alias("split"), "n", "docs")
    # One exchange by digest; each task has named a term about once.
    words = stored.where("kind = 'term'").select("digest", "term").repartition("digest")
    spans = words.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    spans = stage(spans, "spans")
    names = spans.where("least = most").select("digest", F.lit(0).alias("split"), F.col("least").alias("term"))
    shared = spans.where("least <> most").select("digest")
    if not shared.isEmpty():
        numbers, names = _split(keyed, shift, numbers, names, stage(shared, "shared"))

    kept = _kept_counts(numbers, groups, rule)
    stats = _statistics(kept, groups)
    valued = kept.join(stats.select("gid", "terms", "n_lang", "n_group"), "gid").select(
        "lid", "gid", "digest", "split",
        _probability("n", "n_group").alias("p"),
        _probability("n_all", "n_lang").alias("q"),
        _probability(F.lit(0), "n_group").alias("p0"),
    )
    valued = stage(valued, "valued")
    terms = _term_rows(valued, names, rule.ranks)
    pairs = _pair_rows(valued, stats)
    named = stats.select("gid", "lang", "source")
    return pairs.unionByName(terms).join(named, "gid").select(
        "lang", "source", "part", "item", "value", "rank"
    )


def _group_id(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "lang", "source")


def _groups(texts: DataFrame) -> tuple[DataFrame, int]:
    """gid, lid, lang, source of every group, under the first seed that gives them ids of their own."""
    found = stage(texts.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        groups = found.withColumns({"gid": _group_id(seed), "lid": F.xxhash64(F.lit(seed), "lang")})
        again = [
            groups.groupBy("gid").count().where("count > 1"),
            groups.select("lid", "lang").distinct().groupBy("lid").count().where("count > 1"),
        ]
        if all(g.isEmpty() for g in again):
            return groups, seed
        seed += 1


def _count(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """Counts of terms by group and digest, and the terms of the digests, each about once a task.

    Texts are taken some megabytes at a time; one that is longer is counted in slices.
    """
    told = _Told()
    held: list[tuple[int, bytes]] = []
    size = 0
    for batch in batches:
        for gid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(text) > GATHER:
                yield from _count_long(gid, text, shift, told)
                continue
            held.append((gid, text))
            size += len(text)
            if size > GATHER:
                yield from _count_texts(held, shift, told)
                held, size = [], 0
    yield from _count_texts(held, shift, told)


def _count_texts(held: list[tuple[int, bytes]], shift: int, told: _Told) -> Iterator[pa.RecordBatch]:
    held = sorted(held, key=lambda h: h[0])
    gids = np.array([gid for gid, _ in held], np.int64)
    doc, found = _terms([text for _, text in held], shift)
    # Stable, so the terms of a digest stay in order of documents and thus of groups.
    order = np.argsort(found.digest, kind="stable")
    digest, doc = found.digest[order], doc[order]
    gid = gids[doc]
    fresh = _changes(digest)
    in_doc = fresh | _changes(doc)
    begins = np.flatnonzero(fresh | _changes(gid))
    n = np.diff(begins, append=len(digest))
    docs = np.add.reduceat(in_doc.astype(np.int64), begins) if len(begins) else n
    yield _counts(gid[begins], digest[begins], n, docs)
    yield told.terms(found, order, fresh)


def _count_long(gid: int, text: bytes, shift: int, told: _Told) -> Iterator[pa.RecordBatch]:
    """One document, cut behind a term every GATHER bytes; its terms count as one document's."""
    digests, counts = [], []
    begin = 0
    while begin < len(text):
        gap = GAP.search(text, begin + GATHER)
        end = gap.start() if gap else len(text)
        _, found = _terms([text[begin:end]], shift)
        order = np.argsort(found.digest, kind="stable")
        fresh = _changes(found.digest[order])
        begins = np.flatnonzero(fresh)
        digests.append(found.digest[order][begins])
        counts.append(np.diff(begins, append=len(order)))
        yield told.terms(found, order, fresh)
        begin = end
    digest, where = np.unique(np.concatenate(digests), return_inverse=True)
    n = np.zeros(len(digest), np.int64)
    np.add.at(n, where, np.concatenate(counts))
    one = np.ones(len(digest), np.int64)
    yield _counts(one * gid, digest, n, one)


class _Terms(NamedTuple):
    """The terms of some texts: digests, the first and the next eight bytes, length, and the
    digests of those that are longer."""

    digest: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray
    long: dict[bytes, int]


def _terms(texts: list[bytes], shift: int) -> tuple[np.ndarray, _Terms]:
    """The text that each term is of, and the terms."""
    raw = b" ".join([*texts, bytes(16)]).translate(LOWER)
    data = np.frombuffer(raw, np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    edges = np.flatnonzero(np.diff(_IS_TERM[data].view(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, begins)))
    size = ends - starts
    eight = np.ndarray((len(data) - 7,), "<u8", raw, strides=(1,))
    low = eight[starts] & _FIRST[np.minimum(size, 8)]
    high = eight[starts + 8] & _FIRST[np.clip(size - 8, 0, 8)]
    # One to one for terms of up to eight bytes.
    digest = mix(mix(low) + high * U64(BASE))
    long: dict[bytes, int] = {}
    for k in np.flatnonzero(size > 16).tolist():
        term = raw[starts[k] : ends[k]]
        if term not in long:
            long[term] = xxhash.xxh64_intdigest(term)
        digest[k] = long[term]
    digest = (digest >> U64(shift)).view(np.int64)
    return doc, _Terms(digest, low, high, size, {t: d >> shift for t, d in long.items()})


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value is another than the one before."""
    return np.diff(values, prepend=values[:1] + 1) != 0


class _Told:
    """The terms that a task has named already, as far as there is room."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.digest = np.zeros(0, np.int64)
        self.low = self.high = np.zeros(0, U64)
        self.long: set[bytes] = set()

    def terms(self, found: _Terms, order: np.ndarray, fresh: np.ndarray) -> pa.RecordBatch:
        """Each digest with each of its terms that isn't told yet. Equal digests follow each other in `order`."""
        low, high = found.low[order], found.high[order]
        at = order[(fresh | _changes(low) | _changes(high)) & (found.size[order] <= 16)]
        digest, low, high, size = found.digest[at], found.low[at], found.high[at], found.size[at]
        place = np.minimum(np.searchsorted(self.digest, digest), max(len(self.digest) - 1, 0))
        if len(self.digest):
            new = (self.digest[place] != digest) | (self.low[place] != low) | (self.high[place] != high)
            digest, low, high, size, place = digest[new], low[new], high[new], size[new], place[new]
        long = found.long.keys() - self.long
        if len(self.digest) + len(self.long) > MOST_TOLD:
            self._forget()
        where = np.searchsorted(self.digest, digest)
        self.digest = np.insert(self.digest, where, digest)
        self.low, self.high = np.insert(self.low, where, low), np.insert(self.high, where, high)
        self.long |= long
        letters = np.stack([low, high], axis=1).view(np.uint8)[np.arange(16) < size[:, None]]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        short = pa.Array.from_buffers(
            pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(letters.tobytes())]
        )
        listed = list(long)
        term = pa.concat_arrays([short, pa.array(listed, pa.binary())])
        own = np.concatenate([digest, np.array([found.long[t] for t in listed], np.uint64).view(np.int64)])
        none = pa.nulls(len(term), pa.int64())
        return _rows("term", none, pa.array(own), none, none, term)


def _counts(gid: np.ndarray, digest: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(x.astype(np.int64)) for x in (gid, digest, n, docs)]
    return _rows("count", *columns, pa.nulls(len(gid), pa.binary()))


def _spell(batches: Iterator[pa.RecordBatch], shift: int) -> Iterator[pa.RecordBatch]:
    """Counts of terms by group, each with its term; for the digests that terms share."""
    for batch in batches:
        uses: dict[int, Counter] = {}
        docs: dict[int, Counter] = {}
        for gid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = TERM.findall(text.translate(LOWER))
            uses.setdefault(gid, Counter()).update(words)
            docs.setdefault(gid, Counter()).update(set(words))
        for gid, counts in uses.items():
            terms = list(counts)
            _, found = _terms([b" ".join(terms)], shift)
            n = np.array([counts[t] for t in terms], np.int64)
            seen = np.array([docs[gid][t] for t in terms], np.int64)
            columns = [pa.array(x) for x in (np.full(len(terms), gid, np.int64), found.digest, n, seen)]
            yield _rows("count", *columns, pa.array(terms, pa.binary()))


def _rows(
    kind: str, gids: pa.Array, digests: pa.Array, n: pa.Array, docs: pa.Array, terms: pa.Array
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(kind), len(digests)), gids, digests, n, docs, terms],
        names=["kind", "gid", "digest", "n", "docs", "term"],
    )


def _split(
    keyed: DataFrame, shift: int, numbers: DataFrame, names: DataFrame, shared: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Counts and names with the terms of a shared digest told apart by their order in it."""
    spelled = keyed.mapInArrow(lambda batches: _spell(batches, shift), COUNTED)
    spelled = stage(spelled.join(shared, "digest", "left_semi"), "spelled")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    apart = stage(spelled.select("digest", "term").distinct().withColumn("split", place), "apart")
    more = spelled.join(apart, ["digest", "term"]).select("gid", "digest", "split", "n", "docs")
    alone = numbers.join(shared, "digest", "left_anti")
    return alone.unionByName(more), names.unionByName(apart.select("digest", "split", "term"))


def _kept_counts(numbers: DataFrame, groups: DataFrame, rule: AuditRule) -> DataFrame:
    """Counts of the kept terms by group, with the language's and a mark on one row of each term."""
    counts = numbers.groupBy("gid", "digest", "split").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lid", "digest", "split")
    return stage(
        counts.join(groups.select("gid", "lid"), "gid")
        .select(
            "lid", "gid", "digest", "split", "n",
            F.sum("n").over(term).alias("n_all"),
            F.sum("docs").over(term).alias("n_docs"),
            (F.row_number().over(term.orderBy("gid")) == 1).cast("long").alias("once"),
        )
        .where(F.col("n_docs") >= rule.min_docs)
        .drop("n_docs"),
        "kept",
    )


def _statistics(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each group: its names, its count, and the terms and count of its language."""
    of_group = kept.groupBy("gid").agg(F.sum("n").alias("n_group"))
    of_lang = kept.groupBy("lid").agg(F.sum("n").alias("n_lang"), F.sum("once").alias("terms"))
    joined = groups.join(of_group, "gid", "left").join(of_lang, "lid", "left")
    return stage(joined.na.fill(0, ["n_group", "n_lang", "terms"]), "statistics")


def _probability(count: str | Column, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), by three steps of long division.

    A step multiplies by a thousand, so the counts may go up to 9e15.
    """
    whole = F.greatest(F.col(total) + F.col("terms"), F.lit(1))
    left = (F.col(count) if isinstance(count, str) else count) + F.lit(1)
    share = _quotient(left, whole)
    for _ in range(3):
        left = F.pmod(left, whole) * 1000
        share = share * 1000 + _quotient(left, whole)
    return (share + 1).cast("long")


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(p: str | Column, q: str | Column) -> Column:
    """floor((p - q)^2 / q)"""
    p, q = (F.col(x) if isinstance(x, str) else x for x in (p, q))
    return _quotient((p - q) * (p - q), q)


def _term_rows(valued: DataFrame, names: DataFrame, ranks: int) -> DataFrame:
    """The first `ranks` terms of each group; their text comes last.

    Counting the distinct values tells the value below which nothing can be among the first, so
    neither a large group nor many equal values come to one task.
    """
    above = valued.where("p > q").select("gid", "digest", "split", _share("p", "q").alias("value"))
    levels = above.groupBy("gid", "value").agg(F.count("*").alias("n"))
    down = Window.partitionBy("gid").orderBy(F.desc("value"))
    top = levels.withColumn("place", F.row_number().over(down)).where(F.col("place") <= ranks)
    ahead = F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1))
    least = (
        top.withColumn("ahead", F.coalesce(ahead, F.lit(0)))
        .where(F.col("ahead") < ranks)
        .groupBy("gid")
        .agg(F.min("value").alias("least"))
    )
    near = above.join(stage(least, "least"), "gid").where("value >= least").drop("least")
    spelled = near.join(names, ["digest", "split"])
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "term")
    return (
        spelled.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= ranks)
        .select("gid", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )


def _pair_rows(valued: DataFrame, stats: DataFrame) -> DataFrame:
    """The divergence of each source from each other of its language, over all kept terms.

    With a and b for the probability of an absent term in the two sources, the sum of f(p, q) is
    f(a, b) for every term; f(p, b) - f(a, b) more for each term of the first source; f(a, q) - f(a, b) more
    for each of the second; and what the two do not add up to for each term of both. The
    first three need only how often a probability occurs in a source.
    """
    other = "o_"
    sources = stats.select("lid", "gid", "source", "terms", _probability(F.lit(0), "n_group").alias("p0"))
    others = sources.select("lid", *[F.col(c).alias(other + c) for c in ("gid", "source", "p0")])
    both = sources.join(others, "lid").where("gid <> o_gid")
    none = _share("p0", "o_p0")
    base = both.select("gid", "o_gid", F.when(F.col("terms") > 0, F.col("terms") * none).otherwise(0).alias("value"))

    levels = stage(valued.groupBy("gid", "p").agg(F.count("*").alias("n")), "levels")
    first = both.join(levels, "gid").select(
        "gid", "o_gid", (F.col("n") * (_share("p", "o_p0") - none)).alias("value")
    )
    second = both.join(levels.select(F.col("gid").alias("o_gid"), "p", "n"), "o_gid").select(
        "gid", "o_gid", (F.col("n") * (_share("p0", "p") - none)).alias("value")
    )
    # Terms used alike by the same sources are one pattern; sources of a term are at most those of a language.
    use = F.array_sort(F.collect_list(F.struct("gid", "p", "p0")))
    patterns = (
        valued.groupBy("lid", "digest", "split").agg(use.alias("uses"))
        .where(F.size("uses") > 1)
        .groupBy("uses").agg(F.count("*").alias("n"))
    )
    met = patterns.select("n", "uses", F.explode("uses").alias("s")).select(
        "n", "s", F.explode("uses").alias("t")
    )
    more = (
        _share("s.p", "t.p") - _share("s.p", "t.p0") - _share("s.p0", "t.p") + _share("s.p0", "t.p0")
    )
    third = met.where("s.gid <> t.gid").select(
        F.col("s.gid").alias("gid"), F.col("t.gid").alias("o_gid"), (F.col("n") * more).alias("value")
    )
    sums = (
        base.unionByName(first).unionByName(second).unionByName(third)
        .groupBy("gid", "o_gid").agg(F.sum("value").alias("value"))
    )
    named = sums.join(stats.select(F.col("gid").alias("o_gid"), F.col("source").alias("item")), "o_gid")
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return named.select(
        "gid", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
