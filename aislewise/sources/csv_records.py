"""CSV records whose quoted fields hold line breaks, out of files that are read in splits.

Whether a line starts a record depends on how many quotes stand before it in its file. Each split
reports whether its quotes are odd in number; the prefix of these tells how each split begins. With
that known, every split joins its own lines, and a record that crosses a border is stitched from the
ends it has in its splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislewise.workspace import stage

QUOTE = '"'
#: Longer records are taken for a quote that is never closed.
MOST_RECORD_BYTES = 16 << 20
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def quoted_records(
    lines: DataFrame, most_bytes: int = MOST_RECORD_BYTES, tasks: int | None = None
) -> DataFrame:
    """The records of `lines`, a text scan with `value` and further columns that are the same in a file.

    The result has the columns of `lines`; lines of one record are joined by a line feed, whatever
    parted them in the file. Quotes are counted as they stand, so a doubled quote changes nothing
    and one in an unquoted field must be escaped by doubling. A record that is not closed at the end of its
    file is passed on as it is, and one longer than `most_bytes` ends the scan with an error.

    Reads the lines twice; lines of files in which a record crosses a border a third time. With `tasks`,
    small splits share so many tasks in each of these passes; the splits themselves stay as they are.
    """
    columns = lines.columns
    placed = lines.select(
        *columns,
        F.col("_metadata.file_path").alias("_uri"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    if tasks:
        placed = placed.coalesce(tasks)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(QUOTE), F.lit("")))
    odd = placed.groupBy("_uri", "_start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("_uri").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    parities = odd.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # One row per split at most, and those only where a record crosses a border or stays open.
    parities = stage(parities.where("odd + inside > 0"), "parities")
    begun: dict[str, set[int]] = {}
    for row in parities.where("inside = 1").select("_uri", "_start").collect():
        begun.setdefault(row._uri, set()).add(row._start)
    crossed = [row._uri for row in parities.where("(odd + inside) % 2 = 1").select("_uri").distinct().collect()]

    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields
    ) + ", _piece int"
    whole = placed.mapInArrow(_joiner(begun, most_bytes, True), schema).select(*columns)
    if not crossed:
        return whole
    ends = placed.where(F.col("_uri").isin(crossed)).mapInArrow(_joiner(begun, most_bytes, False), schema)
    return whole.unionByName(_stitched(stage(ends, "ends"), columns))


def _stitched(ends: DataFrame, columns: list[str]) -> DataFrame:
    """Records out of the ends they have in their splits, in order of the splits."""
    order = Window.partitionBy("_uri").orderBy("_start", "_piece")
    record = F.sum((F.col("_piece") == TAIL).cast("int")).over(order)
    parts = F.transform(
        F.array_sort(F.collect_list(F.struct("_start", "_piece", "value"))), lambda p: p["value"]
    )
    others = [F.first(c).alias(c) for c in columns if c != "value"]
    return (
        ends.withColumn("_record", record)
        .groupBy("_uri", "_record")
        .agg(F.array_join(parts, "\n").alias("value"), *others)
        .select(*columns)
    )


def _joiner(begun: dict[str, set[int]], most_bytes: int, whole: bool):
    """Joins the lines of each split; gives whole records, or else the ends that cross a border.

    Rows of a split come one after another and in the order of the file.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple[str, int] | None = None
        held: list[str] = []
        inside = headed = False
        like: pa.RecordBatch | None = None

        def close(piece: int) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held and (piece == WHOLE) == whole:
                yield _rows(like, ["\n".join(held)], piece)
            held = []

        for batch in batches:
            names = batch.schema.names
            uris, starts = (batch.column(names.index(c)) for c in ("_uri", "_start"))
            values = batch.column(names.index("value"))
            marks = [0, *_changes(uris, starts), len(batch)]
            for low, high in zip(marks, marks[1:]):
                if low == high:
                    continue
                here = (uris[low].as_py(), starts[low].as_py())
                if here != place:
                    if inside:
                        yield from close(MIDDLE if headed else TAIL)
                    place, like = here, batch.slice(low, 1)
                    inside = headed = here[1] in begun.get(here[0], ())
                part = batch.slice(low, high - low)
                odd = pc.count_substring(values.slice(low, high - low), QUOTE).to_numpy(zero_copy_only=False) % 2
                if not inside and not odd.any():
                    if whole:
                        yield _with_piece(part)
                    continue
                out = []
                for line, flips in zip(values.slice(low, high - low).to_pylist(), odd.tolist()):
                    held.append(line)
                    inside ^= bool(flips)
                    if inside:
                        if sum(map(len, held)) > most_bytes:
                            raise ValueError(f"{here[0]}: a quoted field is not closed within {most_bytes} bytes")
                        continue
                    if headed:
                        if out and whole:
                            yield _rows(like, out, WHOLE)
                            out = []
                        yield from close(HEAD)
                        headed = False
                    else:
                        out.append("\n".join(held))
                        held = []
                if out and whole:
                    yield _rows(like, out, WHOLE)
        if inside:
            yield from close(MIDDLE if headed else TAIL)

    return join


def _changes(uris: pa.Array, starts: pa.Array) -> list[int]:
    """Places where another split begins."""
    if len(starts) < 2:
        return []
    at = starts.to_numpy(zero_copy_only=False)
    moved = at[1:] != at[:-1]
    moved |= pc.not_equal(uris.slice(1), uris.slice(0, len(uris) - 1)).to_numpy(zero_copy_only=False)
    return (np.flatnonzero(moved) + 1).tolist()


def _with_piece(batch: pa.RecordBatch) -> pa.RecordBatch:
    piece = pa.array(np.full(len(batch), WHOLE, np.int32))
    return pa.RecordBatch.from_arrays([*batch.columns, piece], names=[*batch.schema.names, "_piece"])


def _rows(like: pa.RecordBatch, values: list[str], piece: int) -> pa.RecordBatch:
    columns = [
        pa.array(values, pa.string())
        if name == "value"
        else pa.array(like.column(name).to_pylist() * len(values), like.schema.field(name).type)
        for name in like.schema.names
    ]
    columns.append(pa.array(np.full(len(values), piece, np.int32)))
    return pa.RecordBatch.from_arrays(columns, names=[*like.schema.names, "_piece"])
