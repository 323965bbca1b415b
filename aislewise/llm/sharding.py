"""Assignment of rows to shards by a hierarchical weighted hash tree."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislewise.llm.common import stage, text_bytes


@dataclass(frozen=True)
class Node:
    """A shard (no children, `shard` set) or a region or rack above shards."""

    name: str
    weight: float = 0.0
    shard: int = -1
    children: tuple[Node, ...] = field(default=())

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def topology(shards: int, regions: int = 4, racks: int = 2, base: int = 16) -> Node:
    """`base` equal shards in regions and racks; each further shard is a region of its own.

    A shard that joins an existing rack raises the weight of that subtree, and rows
    drawn into it settle on any of its shards. As a region with one rack and one
    shard it draws rows into itself only.
    """
    leaf = lambda i: Node(f"shard-{i}", 1.0, i)
    per = max(1, math.ceil(min(shards, base) / (regions * racks)))
    cells = [range(i, min(i + per, shards, base)) for i in range(0, min(shards, base), per)]
    rack = [Node(f"rack-{k}", children=tuple(map(leaf, c))) for k, c in enumerate(cells)]
    top = [
        Node(f"region-{k // racks}", children=tuple(rack[k : k + racks]))
        for k in range(0, len(rack), racks)
    ]
    top += [
        Node(f"region-of-{i}", children=(Node(f"rack-of-{i}", children=(leaf(i),)),))
        for i in range(base, shards)
    ]
    return Node("root", children=tuple(top))


def place(key: Column, tree: Node) -> Column:
    """The shard of a 64-bit key: at each level the child with the highest weighted draw.

    A child's draw is ln(u) / weight, u from the hash of key and child name. It depends
    on nothing else, so a changed weight moves rows only into or out of that child.
    Children of weight 0 get no rows. The tree is part of the expression: its size is
    the number of nodes, which is meant to be hundreds, not millions.
    """
    open_ = [c for c in tree.children if c.total > 0]
    if not tree.children:
        return F.lit(tree.shard)
    if len(open_) == 1:
        return place(key, open_[0])
    draws = [
        F.struct(F.log(_uniform(key, c.name)) / F.lit(float(c.total)), F.lit(-i))
        for i, c in enumerate(open_)
    ]
    chosen = -F.array_max(F.array(*draws))["col2"]
    out = F.when(chosen == 0, place(key, open_[0]))
    for i, child in enumerate(open_[1:], 1):
        out = out.when(chosen == i, place(key, child))
    return out


def _uniform(key: Column, name: str) -> Column:
    """A number above 0 and up to 1 from the upper 53 bits of a hash."""
    return (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11) + 1) / F.lit(float(1 << 53))


def assign_shards(
    docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Shard, slot and size of every row under the law `key`.

    The id as text and the number of shards alone decide on the shard; `grown_shard` is
    the shard with one more. Null ids share one shard, as rows of equal id do. A null
    text counts 1 byte and has the checksum of the empty text. Slots count from 0 in each
    shard without gaps; repeated rows get a slot each. An empty table gives no rows, and
    columns other than id and text are not read.

    Slots need no sort of a shard: rows are numbered within (shard, input partition) and
    shifted by the counts of earlier partitions. The numbered rows are stored first, so
    that a lost executor can't renumber them.
    """
    key = F.xxhash64(F.coalesce(F.col(id_column).cast("string"), F.lit("\0null")))
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (text_bytes(F.col(text_column)) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("key"),
    )
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        place(F.col("key"), topology(shards)).cast("int").alias("shard"),
        place(F.col("key"), topology(shards + 1)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = stage(placed, "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    offsets = offsets.select(
        "shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    local = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    return (
        placed.withColumn("local", local - 1)
        .join(offsets, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("local")).alias("slot"),
            "grown_shard",
        )
    )
