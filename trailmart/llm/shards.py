"""Operator 5, sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks. A document descends from the root: at each
level every child draws a straw from the hash of (document id, child), lengthened by the child's
weight, and the longest wins. A weight that changes at a node changes the straws of that node and
of those above it only, so documents move into or out of these subtrees and nowhere else. A shard
that is added with ``grow`` is a region and rack of its own, so documents move only into it.

The law is ``key``: the id and the tree decide. A null id is a key like any other. Sizes and
checksums of null texts are those of no bytes. Documents with equal ids share a shard and have
different slots, ordered by checksum and size.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes that each document counts besides its text.
OVERHEAD = 16
#: Documents to a group in which slots are numbered.
SLOT_ROWS = 20_000


@dataclass(frozen=True)
class Tree:
    """Leaves as (region, rack, shard, weight)."""

    leaves: tuple[tuple[int, int, int, float], ...]

    @staticmethod
    def even(shards: int, per_rack: int = 5, racks: int = 2) -> Tree:
        """Shards of weight 1 in racks of ``per_rack`` and regions of ``racks``."""
        return Tree(
            tuple((s // (per_rack * racks), s // per_rack, s, 1.0) for s in range(shards))
        )

    def grow(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region and rack of its own."""
        region, rack, shard = (max(leaf[k] for leaf in self.leaves) + 1 for k in range(3))
        return Tree((*self.leaves, (region, rack, shard, weight)))

    def reweigh(self, shard: int, weight: float) -> Tree:
        return Tree(tuple((*x[:3], weight) if x[2] == shard else x for x in self.leaves))

    def _children(self, depth: int) -> dict[int, dict[int, float]]:
        """Parent to (child to weight) at a depth; the root's parent is 0."""
        out: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
        for leaf in self.leaves:
            if leaf[3] > 0:
                out[leaf[depth - 1] if depth else 0][leaf[depth]] += leaf[3]
        return out

    def place(self, key: Column) -> Column:
        """The shard of a key, as an expression: one draw for each level."""
        at = F.lit(0)
        for depth in range(3):
            levels = []
            for parent, children in sorted(self._children(depth).items()):
                pairs = [
                    F.struct(F.lit(c).alias("child"), F.lit(w).alias("weight"))
                    for c, w in sorted(children.items())
                ]
                levels += [F.lit(parent), F.array(*pairs)]
            at = _longest(key, depth, F.element_at(F.create_map(*levels), at))
        return at


def _longest(key: Column, depth: int, children: Column) -> Column:
    """The child with the longest straw: ln(u) / weight, u uniform in (0, 1); ties to the smaller."""

    def straw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(depth), child["child"]), 11)
        u = (bits.cast("double") + 0.5) / float(1 << 53)
        return F.struct((F.log(u) / child["weight"]).alias("s"), (-child["child"]).alias("c"))

    return -F.array_max(F.transform(children, straw))["c"]


def assign(
    docs: DataFrame,
    tree: Tree,
    grown: Tree | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every document.

    Slots number the documents of a shard without gaps. A shard is cut into groups by a hash of
    the id; a group begins where the sizes of those before it end, so no task holds a shard.
    """
    content = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col)
    rows = docs.select(
        key.alias("id"),
        (F.octet_length(content) + OVERHEAD).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        tree.place(key).alias("shard"),
        (grown.place(key) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    n = docs.count()
    groups = max(1, n // (SLOT_ROWS * len(tree.leaves)) + 1)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("id", F.lit("slot")), F.lit(groups)))
    totals = rows.groupBy("shard", "group").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "shard", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "group").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("row", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "group"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("row")).cast("long").alias("slot"),
        "grown_shard",
    )
