"""Operator 3, approximate nearest neighbours by a navigable small-world graph for each shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of their id. Each shard is one task:
its distinct vectors are put one by one into a hierarchical graph, whose levels are flat arrays
of neighbours. The index is a table with a row for each shard. Every query searches the graph of
every shard; the nearest of all shards are merged. Equal vectors are one node with a list of ids,
so a vector that very many rows share does not wall off the graph.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, neither
as queries nor as candidates. Vectors of another length are never neighbours. Distances are
Euclidean in double precision on the original vectors; ties go to the smaller id. Rows without an
id take no part. With fewer than ``k`` candidates all of them are returned.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmart import scratch

SHARD_ROWS = 4096
QUERY_ROWS = 1024
#: Neighbours of a node (twice as many on the lowest level), and the widths of both searches.
LINKS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 96

INDEX = (
    "dim int, shard int, ids binary, first binary, vectors binary, levels binary, "
    "neighbours binary, entry int"
)


class Graph(NamedTuple):
    """Nodes are distinct vectors. ``neighbours`` holds, for each level and node, so many places
    (twice as many on level 0), filled up with -1; ``first`` is where a node's ids begin."""

    ids: np.ndarray
    first: np.ndarray
    vectors: np.ndarray
    levels: np.ndarray
    neighbours: list[np.ndarray]
    entry: int


def _search(
    graph: np.ndarray, vectors: np.ndarray, norms: np.ndarray, query: np.ndarray,
    entries: list[tuple[float, int]], width: int,
) -> list[tuple[float, int]]:
    """The ``width`` nearest nodes found on one level, nearest first, from (distance, node)."""
    seen = np.zeros(len(vectors), bool)
    seen[[n for _, n in entries]] = True
    todo = list(entries)
    heapq.heapify(todo)
    best = [(-d, n) for d, n in entries]
    heapq.heapify(best)
    while todo:
        distance, node = heapq.heappop(todo)
        if len(best) >= width and distance > -best[0][0]:
            break
        near = graph[node]
        near = near[near >= 0]
        near = near[~seen[near]]
        if not len(near):
            continue
        seen[near] = True
        far = norms[near] - 2 * (vectors[near] @ query)
        if len(best) >= width:
            closer = far < -best[0][0]
            near, far = near[closer], far[closer]
        for d, n in zip(far.tolist(), near.tolist(), strict=True):
            if len(best) < width:
                heapq.heappush(best, (-d, n))
                heapq.heappush(todo, (d, n))
            elif d < -best[0][0]:
                heapq.heapreplace(best, (-d, n))
                heapq.heappush(todo, (d, n))
    return sorted((-d, n) for d, n in best)


def _diverse(vectors: np.ndarray, norms: np.ndarray, base: int, nodes: list[int], most: int) -> list[int]:
    """Of nodes in order of distance from ``base``, those nearer to it than to one already taken;
    filled up with the nearest others."""
    if len(nodes) <= most:
        return nodes
    own = vectors[nodes]
    norm = norms[nodes]
    from_base = norm + norms[base] - 2 * (own @ vectors[base])
    between = norm[:, None] + norm[None, :] - 2 * (own @ own.T)
    taken: list[int] = []
    least = np.full(len(nodes), np.inf)
    for k in range(len(nodes)):
        if from_base[k] < least[k]:
            taken.append(k)
            if len(taken) == most:
                break
            least = np.minimum(least, between[k])
    if len(taken) < most:
        chosen = set(taken)
        taken += [k for k in range(len(nodes)) if k not in chosen][: most - len(taken)]
    return [nodes[k] for k in taken]


def build(ids: np.ndarray, rows: np.ndarray) -> Graph:
    """The graph of a shard's vectors (float32 rows) and ids."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], np.ascontiguousarray(rows[order] + np.float32(0))
    keys = rows.view(np.dtype((np.void, rows.shape[1] * 4))).ravel()
    _, at, node = np.unique(keys, return_index=True, return_inverse=True)
    by_node = np.argsort(node, kind="stable")
    vectors = rows[at]
    n = len(vectors)
    first = np.searchsorted(node[by_node], np.arange(n + 1)).astype(np.int32)
    # The order of insertion and the levels come from the vectors' ids.
    draw = np.random.default_rng(abs(int(ids[0])) % (1 << 32))
    levels = np.minimum((-np.log(1 - draw.random(n)) / np.log(LINKS)).astype(np.int32), 12)
    norms = (vectors * vectors).sum(axis=1)
    graph = [np.full((n, LINKS * 2 if k == 0 else LINKS), -1, np.int32) for k in range(levels.max() + 1)]
    entry, top = -1, -1
    for new in draw.permutation(n).tolist():
        level, query = int(levels[new]), vectors[new]
        if entry < 0:
            entry, top = new, level
            continue
        found = [(float(norms[entry] - 2 * (vectors[entry] @ query)), entry)]
        for k in range(top, -1, -1):
            found = _search(graph[k], vectors, norms, query, found, BUILD_WIDTH if k <= level else 1)
            if k > level:
                continue
            links = graph[k]
            most = links.shape[1]
            mine = _diverse(vectors, norms, new, [x for _, x in found], LINKS)
            links[new, : len(mine)] = mine
            for other in mine:
                row = links[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = new
                    continue
                all_ = np.append(row, new)
                far = norms[all_] - 2 * (vectors[all_] @ vectors[other])
                kept = _diverse(vectors, norms, other, all_[np.argsort(far, kind="stable")].tolist(), most)
                row[:] = -1
                row[: len(kept)] = kept
        if level > top:
            entry, top = new, level
    return Graph(ids[by_node], first, vectors, levels, graph, entry)


def search(graph: Graph, query: np.ndarray, k: int, own: int | None) -> list[tuple[float, int]]:
    """The ``k`` nearest found, as (distance, id) in order; the row ``own`` is left out."""
    vectors, norms = graph.vectors, (graph.vectors * graph.vectors).sum(axis=1)
    return _search_graph(graph, vectors, norms, query, k, own)


def _search_graph(graph, vectors, norms, query, k, own):
    found = [(float(norms[graph.entry] - 2 * (vectors[graph.entry] @ query)), graph.entry)]
    for level in range(len(graph.neighbours) - 1, -1, -1):
        width = 1 if level else max(SEARCH_WIDTH, k + 1)
        found = _search(graph.neighbours[level], vectors, norms, query, found, width)
    nodes = np.array([n for _, n in found])
    apart = vectors[nodes].astype(np.float64) - query.astype(np.float64)
    far = np.sqrt((apart * apart).sum(axis=1))
    out: list[tuple[float, int]] = []
    for d, node in sorted(zip(far.tolist(), nodes.tolist(), strict=True)):
        if len(out) >= k and d > out[k - 1][0]:
            break
        ids = graph.ids[graph.first[node] : graph.first[node + 1]][: k + 1].tolist()
        out = sorted(out + [(d, i) for i in ids if i != own])[: k + 1]
    return out[:k]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def _build(table: pa.Table) -> pa.Table:
    dim = table["dim"][0].as_py()
    graph = build(table["id"].to_numpy(), _matrix(table["vector"], dim))
    flat = np.concatenate([x.ravel() for x in graph.neighbours])
    row = {"dim": dim, "shard": table["shard"][0].as_py(), "entry": graph.entry}
    row |= {
        "ids": graph.ids.astype(np.int64).tobytes(),
        "first": graph.first.tobytes(),
        "vectors": graph.vectors.tobytes(),
        "levels": graph.levels.tobytes(),
        "neighbours": flat.tobytes(),
    }
    kinds = {"dim": pa.int32(), "shard": pa.int32(), "entry": pa.int32()}
    names = [x.split()[0] for x in INDEX.split(", ")]
    return pa.table({c: pa.array([row[c]], kinds.get(c, pa.binary())) for c in names})


def _stored(index: pa.Table, dim: int) -> Graph:
    read = lambda c, kind: np.frombuffer(index[c][0].as_py(), kind)
    levels = read("levels", np.int32)
    n, flat, at, neighbours = len(levels), read("neighbours", np.int32), 0, []
    for k in range(int(levels.max()) + 1):
        width = LINKS * 2 if k == 0 else LINKS
        neighbours.append(flat[at : at + n * width].reshape(n, width))
        at += n * width
    vectors = read("vectors", np.float32).reshape(n, dim)
    return Graph(
        read("ids", np.int64), read("first", np.int32), vectors, levels, neighbours, index["entry"][0].as_py()
    )


def _answer(k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float, int]] = []
        if len(index) and len(queries):
            dim = index["dim"][0].as_py()
            graph = _stored(index, dim)
            norms = (graph.vectors * graph.vectors).sum(axis=1)
            asked = zip(queries["row"].to_pylist(), queries["id"].to_pylist(), _matrix(queries["vector"], dim), strict=True)
            for row, own, query in asked:
                near = _search_graph(graph, graph.vectors, norms, query, k, own)
                found += [(row, own, d, i) for d, i in near]
        return pa.table(
            {
                "row": pa.array([f[0] for f in found], pa.int64()),
                "query_id": pa.array([f[1] for f in found], pa.int64()),
                "vec_id": pa.array([f[3] for f in found], pa.int64()),
                "score": pa.array([f[2] for f in found], pa.float64()),
            }
        )

    return run


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, dim) of the rows that take part."""
    vector = F.col(vector_col).cast("array<float>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return df.select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.size(vector).alias("dim")
    ).where("id is not null and dim > 0").where(
        F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    )


def build_index(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The index table: a row for each shard, written to the shared folder."""
    rows = usable(df, id_col, vector_col)
    shards = -(-rows.count() // SHARD_ROWS) or 1
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")
    dealt = rows.select("dim", shard, "id", "vector")
    return scratch.materialise(dealt.groupBy("dim", "shard").applyInArrow(_build, INDEX))


def nearest(index: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query but its own.

    Queries are cut into blocks; a pair of a shard and a block is one group, so neither the
    queries nor the shards of a large index meet in one task. Rows with an equal id are queries of
    their own, each with its ``k`` nearest, and no row of that id is among them; candidates
    with an equal id are each found.
    """
    asked = usable(queries, id_col, vector_col).withColumn("row", F.monotonically_increasing_id())
    asked = scratch.materialise(asked)
    blocks = -(-asked.count() // QUERY_ROWS) or 1
    block = F.pmod(F.xxhash64("id", "row", F.lit("block")), F.lit(blocks)).cast("int").alias("block")
    shards = index.select(F.col("dim"), F.col("shard"))
    left = index.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    # As many copies of a query as shards: each is searched.
    right = asked.select("dim", "row", "id", "vector", block).join(shards, "dim")
    right = right.select(
        F.col("dim").alias("dim_"), F.col("shard").alias("shard_"), F.col("block").alias("block_"), "row", "id", "vector"
    )
    found = (
        left.groupBy("dim", "shard", "block")
        .cogroup(right.groupBy("dim_", "shard_", "block_"))
        .applyInArrow(_answer(k), "row long, query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("row").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
