"""Jaccard similarity join of documents on word n-grams, by prefix filtering.

Documents with the same n-grams are one *set*. A set's grams are ordered rare first. Two
sets can reach the threshold only if they share a gram among their first few (the prefix),
if their sizes are close (length filter), if enough grams are left after the shared one
(positional filter) and if their grams spread alike over bins (suffix filter). What passes
is verified once per pair on the full grams.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from aislewise.llm import tokens
from aislewise.llm.common import bounded_batches, release_memory, stage
from aislewise.llm.components import connected_components

U64 = np.uint64
#: Counters of the gram frequencies that set the order, sent in chunks. Grams that fall
#: together are ordered by their sum; the order decides on speed alone.
COUNTER_BITS, CHUNK = 21, 4096
COUNTERS = 1 << COUNTER_BITS
#: Bits of the suffix filter's sketch beside each gram; a sketch of a whole set has as many for each gram.
PARITY_BITS, BITS_PER_GRAM = 256, 4
#: Bits of the filters that spare the shuffles what can't match; when they fill up, more passes.
SET_BITS, GRAM_BITS = 1 << 23, 1 << 26
#: Text whose sets and grams a task holds at once.
SLICE_BYTES = 1 << 20
#: Text of an Arrow batch, which is in the memory of both processes.
BATCH_BYTES = 2 << 20

SKETCH = tuple(f"s{k}" for k in range(PARITY_BITS // 64))
PREFIX = ["gram", "id", "n", "at", *SKETCH]
_PREFIX_SHAPE = "gram long, id long, n int, at int, " + ", ".join(f"{c} long" for c in SKETCH)


@dataclass(frozen=True)
class JoinRule:
    """Words to a gram and the least Jaccard similarity of a link, in percent."""

    words: int = 5
    percent: int = 80

    def least_size(self, n: np.ndarray) -> np.ndarray:
        """The size that a partner of a set of n grams has at least; also the least overlap."""
        return -(-n * self.percent // 100)


def overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """The fewest common grams with which sets of n and m reach the threshold."""
    return F.ceil((n + m) * percent / (100 + percent) - F.lit(1e-9))


class _Texts:
    """Gram sets of a batch of texts: sorted distinct hashes, and a hash of each set."""

    def __init__(self, column: pa.Array, rule: JoinRule):
        data, begins = tokens.packed(column)
        starts, ends, first = tokens.words(data, begins)
        hashes = tokens.word_hashes(data, starts, ends)
        self.sets = [
            np.unique(tokens.shingles(hashes[a:b], rule.words))
            for a, b in zip(first[:-1], first[1:])
        ]
        self.ids = np.array([_set_id(s) for s in self.sets], np.int64)


def _set_id(grams: np.ndarray) -> int:
    """A 64-bit name of a set; 0 for the empty one.

    Among n sets about n^2 / 2^65 pairs get one name by chance: one in six billion sets.
    """
    if not len(grams):
        return 0
    parts = np.array([0, 0, len(grams)], U64)
    parts[0] = np.bitwise_xor.reduce(tokens.mix(grams))
    parts[1] = np.add.reduce(tokens.mix(grams ^ U64(tokens.BASE)))
    return int(tokens.shingles(parts, 3).astype(np.int64)[0]) or 1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES of text; a longer text is a slice of its own."""
    release_memory()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for low, high in zip(cuts, cuts[1:]):
            yield batch.slice(low, high - low)
    release_memory()


def _unique_row_ids() -> Iterator[int]:
    base = TaskContext.get().partitionId() << 33
    return iter(range(base, base + (1 << 33)))


def _describe(rule: JoinRule):
    """Per document its id and set; after the last one the gram counters of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("id", pa.int64()), ("n", pa.int64())]
            + [("chunk", pa.int32()), ("counts", pa.binary())]
        )
        for batch in _slices(batches):
            texts = _Texts(batch.column("text"), rule)
            if texts.sets:
                np.add.at(counts, _counter(np.concatenate(texts.sets)), 1)
            nothing = [None] * batch.num_rows
            yield pa.record_batch(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(texts.ids),
                    pa.array([len(s) for s in texts.sets], pa.int64()),
                    pa.array(nothing, pa.int32()),
                    pa.array(nothing, pa.binary()),
                ],
                schema=schema,
            )
        for chunk, part in enumerate(counts.reshape(-1, CHUNK)):
            if part.any():
                values = [None, None, None, chunk, part.astype("<i8").tobytes()]
                columns = [pa.array([v], f.type) for v, f in zip(values, schema)]
                yield pa.record_batch(columns, schema=schema)

    return run


def _added_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks of a partition, in memory for no more than all counters."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "counts"))):
            here = sums.setdefault(chunk, np.zeros(CHUNK, np.int64))
            here += np.frombuffer(counts, "<i8")
    columns = [pa.array(list(sums), pa.int32())]
    columns.append(pa.array([c.astype("<i8").tobytes() for c in sums.values()], pa.binary()))
    yield pa.record_batch(columns, names=["chunk", "counts"])


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - COUNTER_BITS)).astype(np.int64)


def _prefixes(rule: JoinRule, frequency: np.ndarray):
    """Per set of the task, once, the grams of its prefix with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            texts = _Texts(batch.column("text"), rule)
            out: list[tuple[np.ndarray, ...]] = []
            for name, grams in zip(texts.ids.tolist(), texts.sets):
                if not name or name in seen:
                    continue
                seen.add(name)
                order = np.lexsort((grams, frequency[_counter(grams)]))
                size = len(grams) - int(rule.least_size(np.int64(len(grams)))) + 1
                chosen = grams[order[:size]]
                out.append(
                    (
                        chosen.view(np.int64),
                        np.full(size, name, np.int64),
                        np.full(size, len(grams), np.int32),
                        np.arange(size, dtype=np.int32),
                        *(np.full(size, w, np.int64) for w in _parity(grams, PARITY_BITS).view(np.int64)),
                    )
                )
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.record_batch(columns, names=PREFIX)

    return run


def _parity(grams: np.ndarray, bits: int) -> np.ndarray:
    """For each bin whether an odd number of grams falls into it, as bytes.

    Two sets' sketches differ in at most as many bins as there are grams that only one has.
    """
    odd = np.bincount((grams & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def _sketch_gap() -> Column:
    """In how many bins the sketches beside two grams differ."""
    return functools.reduce(
        operator.add, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"r_{c}"))) for c in SKETCH]
    )


def _in_filter(bitmap: np.ndarray):
    """The rows whose gram may be in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("gram").to_numpy() % (8 * len(bitmap))
            yield batch.filter(pa.array((bitmap[slot >> 3] >> (slot & 7) & 1).astype(bool)))

    return run


def _wanted_sets(rule: JoinRule, bitmap: np.ndarray):
    """Per set of the task that the filter lets through, once, its grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            texts = _Texts(batch.column("text"), rule)
            names, sets, sketches = [], [], []
            for name, grams in zip(texts.ids.tolist(), texts.sets):
                slot = name % SET_BITS
                if name and name not in seen and bitmap[slot >> 3] >> (slot & 7) & 1:
                    seen.add(name)
                    names.append(name)
                    sets.append(grams.tobytes())
                    bits = 1 << (BITS_PER_GRAM * len(grams)).bit_length()
                    sketches.append(_parity(grams, max(bits, 64)).tobytes())
            columns = [pa.array(x, pa.binary()) for x in (sketches, sets)]
            yield pa.record_batch(
                [pa.array(names, pa.int64()), *columns], names=["id", "sketch", "grams"]
            )

    return run


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as if made with fewer bins: bins that fall together add up."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def _near(rule: JoinRule):
    """The pairs whose sketches don't rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            pairs = (batch.column(c).to_pylist() for c in ("n_both", "x", "y"))
            for n_both, x, y in zip(*pairs):
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
                # The most common grams that are left, against the threshold.
                good.append((n_both - apart) // 2 * (100 + rule.percent) >= n_both * rule.percent)
            yield batch.select(["a", "b", "n_both"]).filter(pa.array(good, pa.bool_()))

    return run


def _overlaps(rule: JoinRule):
    """The pairs whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            pairs = (batch.column(c).to_pylist() for c in ("n_both", "x", "y"))
            for n_both, x, y in zip(*pairs):
                common = len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), True))
                good.append(common * 100 >= (n_both - common) * rule.percent)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _bitmap_of(values: DataFrame, size: int) -> np.ndarray:
    """A bit for each remainder of the one column by `size`, which bounds what is collected."""
    slot = F.pmod(F.col(values.columns[0]), F.lit(size))
    parts = (
        values.select(slot.alias("slot"))
        .groupBy((F.col("slot") / 32768).cast("int").alias("part"))
        .agg(F.expr("bitmap_construct_agg(slot % 32768)").alias("bits"))
        .toArrow()
    )
    out = np.zeros(max(size // 8, 4096), np.uint8)
    for part, bits in zip(parts["part"].to_pylist(), parts["bits"].to_pylist()):
        out[part * 4096 : (part + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _linked(pairs: DataFrame, texts: DataFrame, rule: JoinRule) -> DataFrame:
    """Those candidate pairs (a, b, n_both) that reach the threshold, each verified once.

    The suffix filter comes first once more, on sketches as long as the sets ask for; only
    what it leaves has its grams brought together.
    """
    ids = lambda p: p.select(F.explode(F.array("a", "b")).alias("id"))
    close = stage(pairs.distinct(), "candidates")
    pool = texts.mapInArrow(
        _wanted_sets(rule, _bitmap_of(ids(close), SET_BITS)), "id long, sketch binary, grams binary"
    )
    pool = stage(pool, "grams")

    def beside(left: DataFrame, column: str) -> DataFrame:
        one = pool.select("id", column)
        one = one.join(ids(left).distinct(), "id", "left_semi").dropDuplicates(["id"])
        x, y = ((F.col("id").alias(k), F.col(column).alias(v)) for k, v in (("a", "x"), ("b", "y")))
        return left.join(one.select(*x), "a").join(one.select(*y), "b")

    near = beside(close, "sketch").mapInArrow(_near(rule), "a long, b long, n_both long")
    near = stage(near, "near")
    return beside(near, "grams").mapInArrow(_overlaps(rule), "a long, b long")


def _may_link(rule: JoinRule) -> Column:
    """The length, positional and suffix filters on a row of PREFIX and another, named r_."""
    n, m = F.col("n"), F.col("r_n")
    most = F.least(n - F.col("at"), m - F.col("r_at"))
    return (
        (F.col("id") != F.col("r_id"))
        & (n * 100 >= m * rule.percent)
        & (m * 100 >= n * rule.percent)
        & (most >= overlap_needed(n, m, rule.percent))
        & (_sketch_gap() <= n + m - overlap_needed(n, m, rule.percent) * 2)
    )


def _pair() -> tuple[Column, ...]:
    both = (F.col("n") + F.col("r_n")).cast("long")
    return F.least("id", "r_id").alias("a"), F.greatest("id", "r_id").alias("b"), both.alias("n_both")


def similar_documents(
    docs: DataFrame,
    rule: JoinRule = JoinRule(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, id, n) with their sets, and the components (node, component) of sets.

    Links are all pairs of sets whose Jaccard similarity reaches the threshold, up to those
    that can't change a component. Documents of equal grams share a set and so a
    component; a set without a link to another has no row among the components. A null
    text and one without words have the empty set, id 0, n 0, which links with nothing.

    Large groups of near copies would make every pair a candidate. So the first round
    pairs each member of a gram with one, the one with the fewest rarer grams of its own.
    The second round pairs only members that this left in another component than that one's, with
    all others of their gram. No pair of different components goes untested.
    """
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    described = stage(
        texts.mapInArrow(
            _describe(rule), "doc_id long, id long, n long, chunk int, counts binary"
        ),
        "sets",
    )
    chunks = described.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    frequency = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for row in chunks.mapInArrow(_added_chunks, "chunk int, counts binary").toLocalIterator():
        frequency[row.chunk] += np.frombuffer(row.counts, "<i8")
    frequency = np.minimum(frequency, 0x7FFFFFFF).astype(np.int32).reshape(-1)
    members = described.where("chunk is null").select("doc_id", "id", "n")
    text = texts.select("text")
    prefixes = stage(text.mapInArrow(_prefixes(rule, frequency), _PREFIX_SHAPE), "prefixes")
    # Most grams of a prefix are in no other one. A filter of those met again takes them out
    # before rows are shuffled; what it lets through by chance ends at the join with the heads.
    again = prefixes.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram")
    rows = prefixes.mapInArrow(_in_filter(_bitmap_of(again, GRAM_BITS)), _PREFIX_SHAPE)
    rows = stage(rows, "repeated")
    heads = (
        rows.groupBy("gram")
        .agg(
            F.min(F.struct("at", "n", "id", *SKETCH)).alias("head"),
            F.max("id").alias("hi"),
            F.min("id").alias("lo"),
        )
        .where("lo <> hi")
        .select("gram", *[F.col(f"head.{c}").alias(f"r_{c}") for c in PREFIX[1:]])
    )
    shared = stage(rows.join(heads, "gram"), "shared")
    first = shared.where(_may_link(rule)).select(*_pair())
    links = stage(_linked(first, text, rule), "links")
    components = stage(connected_components(links), "components")

    of = components.select(F.col("node").alias("id"), F.col("component").alias("c"))
    of_head = components.select(F.col("node").alias("r_id"), F.col("component").alias("r_c"))
    named = (
        shared.select(*PREFIX, "r_id")
        .join(of, "id", "left")
        .join(of_head, "r_id", "left")
        .select(*PREFIX, F.coalesce("c", "id").alias("c"), F.coalesce("r_c", "r_id").alias("r_c"))
    )
    named = stage(named, "named")
    apart = named.where("c <> r_c").select(*PREFIX, "c")
    others = named.select(*[F.col(c).alias(f"r_{c}") for c in (*PREFIX, "c")])
    second = apart.join(
        others, (F.col("gram") == F.col("r_gram")) & (F.col("c") != F.col("r_c")) & _may_link(rule)
    ).select(*_pair())
    return members, connected_components(links.unionByName(_linked(second, text, rule)))


def component_of_documents(
    docs: DataFrame,
    rule: JoinRule = JoinRule(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """For each document (doc_id, n_shingles, component_id), the smallest id it reaches by links.

    Documents without words, and those with a null id that link with no known id, have their
    own id as component. Repeated rows each get a row. See `similar_documents`.
    """
    members, components = similar_documents(docs, rule, id_column, text_column)
    least = (
        members.where("id <> 0")
        .groupBy("id")
        .agg(F.min("doc_id").alias("least"))
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    roots = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(roots, "component").select("id", "component_id")
    return members.join(named, "id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _with_sets(rule: JoinRule, schema: pa.Schema, id_column: str, text_column: str):
    """The rows with their set; of rows equal in id and set, the first of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        fresh = _unique_row_ids()
        for batch in batches:
            texts = _Texts(batch.column(text_column), rule)
            keys = batch.column(id_column).to_pylist()
            names = [i or next(fresh) for i in texts.ids.tolist()]
            empty = [not i for i in texts.ids.tolist()]
            keep = []
            for key, name, bare in zip(keys, names, empty):
                keep.append(bare or (key, name) not in seen)
                if not bare:
                    seen.add((key, name))
            columns = [*batch.columns, pa.array(names, pa.int64()), pa.array(empty, pa.bool_())]
            yield pa.record_batch(columns, schema=schema).filter(pa.array(keep, pa.bool_()))

    return run


def drop_near_duplicates(
    docs: DataFrame,
    rule: JoinRule = JoinRule(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of `docs` without those that link, directly or not, to one of smaller id.

    One row of each component stays, the one with the smallest id (null ids first) and, in
    that, the smallest set name; of rows equal in both, an arbitrary one. Documents without
    words all stay. Columns and their names are those of `docs`.
    """
    members, components = similar_documents(docs, rule, id_column, text_column)
    named = (
        members.where("id <> 0")
        .groupBy("id")
        .agg(F.min(F.struct("doc_id")).alias("least"))
        .join(components.withColumnRenamed("node", "id"), "id", "left")
    )
    chosen = named.groupBy(F.coalesce("component", "id").alias("component")).agg(
        F.min(F.struct("least", "id")).alias("kept")
    )
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    key, text = names[docs.columns.index(id_column)], names[docs.columns.index(text_column)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    schema = _arrow_schema(plain)
    rows = plain.mapInArrow(
        _with_sets(rule, schema, key, text), f"{kinds}, name long, bare boolean"
    )
    chosen = chosen.select(
        F.col("kept.least.doc_id").alias("kept_id"), F.col("kept.id").alias("kept_name")
    )
    same = (F.col("name") == F.col("kept_name")) & F.col(key).cast("long").eqNullSafe(F.col("kept_id"))
    kept = rows.join(chosen, same, "left").where("bare or kept_name is not null")
    kept = kept.dropDuplicates([key, "name"])
    return kept.select(*[F.col(c).alias(o) for c, o in zip(names, docs.columns)])


def _arrow_schema(df: DataFrame) -> pa.Schema:
    own = [pa.field("name", pa.int64()), pa.field("bare", pa.bool_())]
    return pa.schema([*to_arrow_schema(df.schema), *own])
