"""Totals over all subtrees of a forest in rounds of joins: rake leaves, compress unary chains.

A round first takes all leaves away and adds what they hold to their parents. Then it takes nodes
out of chains, that is nodes with a parent and a single child left: those whose random rank of the
round beats that of neighbours in the chain. The child is hung on the parent of the removed
node and carries what that one held. The number of rounds grows with the logarithm of the
number of nodes, be the tree a long chain or a broad star. Nodes taken out of chains get their
totals at the end, in reverse order of the rounds, from the child they had.

Joins are on keys that occur once on either side, and the only grouping, by parent, is summed in
the map tasks first, so a node with very many children is not a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart import scratch


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def subtree_totals(tree: DataFrame, key: Sequence[str], parent: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key, values) for every node, each value summed over the node and all below it.

    ``tree`` has one row per node; the columns ``key`` name it and are never null, ``parent``
    names its parent by the same columns and is null for a root. Values are long and not null.
    """
    n = len(key)
    names = [f"k{i}" for i in range(n)]
    above = [f"p{i}" for i in range(n)]
    held = [f"v{i}" for i in range(len(values))]
    carried = [f"c{i}" for i in range(len(values))]
    below = [f"u{i}" for i in range(n)]
    rename = lambda df, old, new: df.select(*(F.col(o).alias(w) for o, w in zip(old, new, strict=True)))
    inner = F.col(above[0]).isNotNull()

    rows = tree.select(
        *(F.col(c).alias(w) for c, w in zip([*key, *parent, *values], [*names, *above, *held], strict=True)),
        *(F.lit(0).cast("long").alias(c) for c in carried),
    )
    kids = rows.where(inner).groupBy(*above).agg(F.count("*").alias("kids"))
    kids = rename(kids, [*above, "kids"], [*names, "kids"])
    live = scratch.materialise(rows.join(kids, names, "left").fillna(0, ["kids"]))
    raked, chains = [], []
    while True:
        leaves = live.where(inner & (F.col("kids") == 0))
        raked.append(leaves.select(*names, *held))
        given = leaves.groupBy(*above).agg(
            F.count("*").alias("gone"), *(F.sum(F.col(v) + F.col(c)).alias(f"g{v}") for v, c in zip(held, carried, strict=True))
        )
        given = rename(given, [*above, "gone", *(f"g{v}" for v in held)], [*names, "gone", *(f"g{v}" for v in held)])
        left = live.where(~inner | (F.col("kids") > 0)).join(given, names, "left")
        left = scratch.materialise(
            left.select(
                *names,
                *above,
                *((F.col(v) + F.coalesce(f"g{v}", F.lit(0))).alias(v) for v in held),
                *carried,
                (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
            )
        )
        if left.where(inner).isEmpty():
            roots = left.select(*names, *held)
            break
        chosen = scratch.materialise(_chain_nodes(left, names, above, below, held, carried, len(raked)))
        chains.append((len(raked), chosen))
        # Each child of a chosen node is hung on that one's parent.
        hung = chosen.select(
            *(F.col(u).alias(k) for u, k in zip(below, names, strict=True)),
            *(F.col(p).alias(f"n{p}") for p in above),
            *(F.col(f"up_{v}") for v in held),
        )
        live = scratch.materialise(
            left.join(chosen.select(*names), names, "left_anti")
            .join(hung, names, "left")
            .select(
                *names,
                *(F.coalesce(f"n{p}", p).alias(p) for p in above),
                *held,
                *((F.col(c) + F.coalesce(f"up_{v}", F.lit(0))).alias(c) for v, c in zip(held, carried, strict=True)),
                "kids",
            )
        )
    totals: list[DataFrame] = []
    for after, chosen in reversed(chains):
        # The child was raked in a later round, or taken out of a chain in one.
        known = rename(_union([*raked[after:], *totals]), [*names, *held], [*below, *(f"t{v}" for v in held)])
        totals.append(
            scratch.materialise(
                chosen.join(known, below).select(*names, *((F.col(f"t{v}") + F.col(f"add_{v}")).alias(v) for v in held))
            )
        )
    return rename(_union([roots, *raked, *totals]), [*names, *held], [*key, *values])


def _chain_nodes(
    left: DataFrame, names: list[str], above: list[str], below: list[str], held: list[str], carried: list[str], salt: int
) -> DataFrame:
    """Chain nodes to take out, no two of them neighbours, each with its child, with what the
    child has to carry from then on, and with what is added to the child's total for the node's own."""
    inner = F.col(above[0]).isNotNull()
    # With a single child, the least of each of its columns is that child's.
    only = (
        left.where(inner)
        .groupBy(*above)
        .agg(
            F.count("*").alias("n"),
            *(F.min(k).alias(u) for k, u in zip(names, below, strict=True)),
            *(F.min(c).alias(f"o{c}") for c in carried),
        )
        .where("n = 1")
    )
    only = only.select(
        *(F.col(p).alias(k) for p, k in zip(above, names, strict=True)), *below, *(f"o{c}" for c in carried)
    )
    rank = F.xxhash64(*names, F.lit(salt)).alias("rank")
    chain = scratch.materialise(left.where(inner & (F.col("kids") == 1)).join(only, names).select("*", rank))
    child = chain.select(*(F.col(k).alias(u) for k, u in zip(names, below, strict=True)), F.col("rank").alias("its"))
    pairs = chain.join(child, below).select(*names, *below, "rank", "its")
    node, other = (F.struct(*(F.col(c).alias(k) for c, k in zip(cs, names, strict=True))) for cs in (names, below))
    beaten = pairs.select(F.when(F.col("its") >= F.col("rank"), node).otherwise(other).alias("s")).select("s.*")
    return chain.join(beaten, names, "left_anti").select(
        *names,
        *above,
        *below,
        *((F.col(v) + F.col(c)).alias(f"up_{v}") for v, c in zip(held, carried, strict=True)),
        *((F.col(v) + F.col(f"o{c}")).alias(f"add_{v}") for v, c in zip(held, carried, strict=True)),
    )
