"""Scoring of (member, place) pairs and handling of the scorer's answers.

An answer is an array of ``cid -> score`` maps, whatever gave it.
"""

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart import schemas, scratch
from trailmart.operators import ranking
from trailmart.operators.joins import lookup_join
from trailmart.sources import files as sources

Scorer = Callable[[str, str, int], list[dict[str, float]]]

#: Seeds that are compared with a block of items at once.
_SLAB = 128
#: Partitions for block pairs; beyond them, several pairs share one.
_MOST_PARTS = 8192


def score_members(
    pairs: DataFrame,
    scorer: Scorer,
    partitions: int,
    top_k: int = schemas.TOP_K,
    max_in_flight: int = 5,
) -> DataFrame:
    """Ask ``scorer(memberId, ml_mapping_id, top_k)`` once for every distinct pair, on executors.

    At most ``partitions`` x ``max_in_flight`` calls are open at a time, so choose ``partitions``
    by what the model server bears; adaptive execution does not change the number. Pairs are
    spread by hash and answers leave batch by batch, so a task holds one Arrow batch. A lost task
    asks again for its own pairs, so the scorer has to be repeatable; materialise the result when
    it feeds more than one consumer.
    """
    keys = ["memberId", "ml_mapping_id"]
    spread = pairs.select(*keys).distinct().repartition(partitions, *keys)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_in_flight) as pool:
            for batch in batches:
                answers = pool.map(
                    lambda pair: scorer(pair[0], pair[1], top_k),
                    zip(batch["memberId"], batch["ml_mapping_id"], strict=True),
                )
                yield batch[keys].assign(recommendations=list(answers))

    return spread.mapInPandas(ask, schemas.SCORER_ANSWER)


def stored_answers(
    pairs: DataFrame,
    scorer: Scorer,
    store: str,
    model_version: str,
    partitions: int,
    lots: int = 16,
    top_k: int = schemas.TOP_K,
    max_in_flight: int = 5,
) -> DataFrame:
    """The answers of all pairs, from the table at ``store`` and, for those that it lacks, the scorer.

    The store only grows: a row is the answer of one version of the model for a member and a
    place. Pairs without one are dealt to ``lots`` by hash, and a lot is asked and appended
    before the next, so a run that stops loses the answers of one lot and the next run goes on
    behind it. Two runs at a time may both ask for a pair; the first answer by content counts.
    """
    spark, keys = pairs.sparkSession, ["memberId", "ml_mapping_id"]
    version = F.col("model_version") == model_version

    def stored() -> DataFrame:
        return sources.parquet_or_empty(spark, store, schemas.STORED_ANSWER).where(version)

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left[keys[0]].eqNullSafe(right[keys[0]]) & left[keys[1]].eqNullSafe(right[keys[1]])

    wanted = scratch.materialise(pairs.select(*keys).distinct())
    known = stored().select(*keys).alias("known")
    lot = F.pmod(F.xxhash64(*keys), F.lit(lots)).alias("lot")
    missing = scratch.materialise(wanted.join(known, same(wanted, known), "left_anti").select(*keys, lot))
    for (number,) in missing.select("lot").distinct().orderBy("lot").collect():
        asked = score_members(missing.where(F.col("lot") == number), scorer, partitions, top_k, max_in_flight)
        (
            asked.withColumn("model_version", F.lit(model_version))
            .write.mode("append")
            .partitionBy("model_version")
            .parquet(store)
        )
    answers = stored().drop("model_version")
    # Maps can't be compared, their entries can.
    content = F.transform("recommendations", lambda m: F.array_sort(F.map_entries(m)))
    once = ranking.top_n(answers.withColumn("_content", F.to_json(content)), keys, [F.col("_content").asc()])
    return once.drop("_content").join(wanted.alias("w"), same(once, wanted.alias("w")), "left_semi")


def fixed_scorer(answer: Sequence[dict[str, float]]) -> Scorer:
    """A scorer that gives the same answer to everyone, for dry runs without a model."""
    fixed = [dict(scores) for scores in answer]

    def scorer(member_id: str, ml_mapping_id: str, top_k: int) -> list[dict[str, float]]:
        return fixed

    return scorer


def _directed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have a direction, and the lengths of all: none if zero or not finite."""
    lengths = np.linalg.norm(vectors, axis=1)
    return np.flatnonzero((lengths > 0) & np.isfinite(vectors).all(axis=1)), lengths


def _rough_cosines(a, a_length, b, b_length) -> tuple[Callable[[slice], np.ndarray], float]:
    """A function that gives the cosines of some rows of ``a`` with all of ``b``, and by how much they
    may be off. Lengths whose product may overflow or vanish take the slow way."""
    lengths = np.concatenate([a_length, b_length])
    if len(lengths) and lengths.min() > 1e-150 and lengths.max() < 1e150:
        a32, b32 = ((x / n[:, None]).astype(np.float32) for x, n in ((a, a_length), (b, b_length)))
        # Rounding of the two directions and of a sum of as many products as there are dimensions.
        return lambda part: a32[part] @ b32.T, 1.2 * (a.shape[1] + 8) * 2.0**-24

    def exact(part: slice) -> np.ndarray:
        out = _cosines(a[part] @ b.T, np.outer(a_length[part], b_length))
        return np.where(np.isfinite(out), out, -np.inf)

    return exact, 1e-9


def _cosines(products: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.full(products.shape, -np.inf)
    return np.divide(products, lengths, out=out, where=lengths > 0)


def _best_of_block(seed_rows: pd.DataFrame, item_rows: pd.DataFrame, top_k: int) -> pd.DataFrame:
    """The best ``top_k`` items of a block per row of seeds.

    One matrix product in single precision tells which items may be among the best; its error is
    bounded, so none of them is missed. Only their scores are computed in double precision.
    """
    found = {"ml_mapping_id": [], "cid": [], "score": []}
    empty = pd.DataFrame(found, dtype=object)
    if seed_rows.empty or item_rows.empty:
        return empty
    # Items in cid order, so that a smaller position is a smaller cid.
    item_rows = item_rows.sort_values("cid")
    cids = item_rows["cid"].to_numpy()
    b = np.stack(item_rows["embedding"].to_numpy()).astype(np.float64)
    some, b_length = _directed(b)
    times = pd.Series(cids[some]).value_counts(dropna=False)
    if not len(times):
        return empty
    # Of equal vectors only the first can be near a seed, and those of the seed itself are no items.
    most = int(times.iloc[0])
    whole = np.ascontiguousarray(b[some]).view(np.dtype((np.void, b.shape[1] * b.itemsize)))[:, 0]
    place = pd.Series(np.unique(whole, return_inverse=True)[1])
    some = some[(place.groupby(place).cumcount() < top_k + most).to_numpy()]
    cids, b, b_length = cids[some], b[some], b_length[some]
    a = np.stack(seed_rows["direction"].to_numpy()).astype(np.float64)
    some, a_length = _directed(a)
    seeds, a, a_length = seed_rows["seed"].to_numpy()[some], a[some], a_length[some]
    # Where the items of an id begin and end: they lie together.
    codes, names = pd.factorize(cids)
    begin, end = (np.searchsorted(codes[codes >= 0], np.arange(len(names)), side) for side in ("left", "right"))
    own = pd.Index(names).get_indexer(seeds)
    rough, error = _rough_cosines(a, a_length, b, b_length)
    keep, groups = min(top_k, len(cids)), min(512, len(cids))
    piece = max(1, (1 << 22) // b.shape[1])
    for start in range(0, len(seeds), _SLAB):
        part = slice(start, start + _SLAB)
        cosines = rough(part)
        # A place is not its own neighbour.
        has = np.flatnonzero(own[part] >= 0)
        first, last = begin[own[part][has]], end[own[part][has]]
        for n in range(most):
            same = first + n < last
            cosines[has[same], first[same] + n] = -np.inf
        # The best of each of many groups of items: as many items are at least as near as the last kept.
        of_group = cosines[:, : len(cids) // groups * groups].reshape(len(cosines), -1, groups).max(axis=1)
        if keep > groups:
            of_group = cosines
        edge = np.partition(of_group, -keep, axis=1)[:, -keep, None].astype(np.float64)
        edge = (edge - 2 * error - 1e-8).astype(cosines.dtype)
        near = np.flatnonzero((cosines >= edge) & (cosines > -np.inf))
        row, item = np.divmod(near, len(cids))
        scores = np.empty(len(near))
        for lo in range(0, len(near), piece):
            r, i = row[lo : lo + piece] + start, item[lo : lo + piece]
            products, lengths = np.einsum("ij,ij->i", a[r], b[i]), a_length[r] * b_length[i]
            scores[lo : lo + piece] = np.round(_cosines(products, lengths), 9)
        # Vectors that overflow have no direction either.
        finite = np.isfinite(scores)
        row, item, scores = row[finite], item[finite], scores[finite]
        order = np.lexsort((item, -scores, row))
        row, item, scores = row[order], item[order], scores[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < top_k
        found["ml_mapping_id"].append(seeds[row[best] + start])
        found["cid"].append(cids[item[best]])
        found["score"].append(scores[best])
    if not len(seeds):
        return empty
    return pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})


def similar_places(
    seeds: DataFrame,
    items: DataFrame,
    top_k: int = schemas.TOP_K,
    block_rows: int = 4096,
    item_count: int | None = None,
    seed_count: int | None = None,
) -> DataFrame:
    """The ``top_k`` items closest to each seed by cosine, exact: (ml_mapping_id, cid, score).

    ``seeds`` holds ml_mapping_id, ``items`` holds unique ml_mapping_id and embedding; seeds
    without an item get no rows, and no item is recommended for itself. A vector that is NULL or
    holds a NULL has no neighbours, nor has one that is zero or not finite; vectors of different
    lengths are not compared.

    Items and seeds are cut into hash blocks of ``block_rows`` to four times as many, each side by
    its own number of rows, so few seeds do not copy the items and many rows are not copied to ever
    more blocks of one size. Every block pair is a partition of its own as far as hashes allow, and
    lets only its best ``top_k`` per seed out, so neither all pairs nor a whole side ever meet in
    one task. Scores are rounded to nine digits before ranking and ties go to the smaller cid, so
    the order does not depend on how vectors are blocked.
    """
    if item_count is None:
        item_count = items.count()
    chosen = seeds.select("ml_mapping_id").distinct()
    if seed_count is None:
        seed_count = chosen.count()

    def blocks(rows: int) -> int:
        most = min(4 * block_rows, max(block_rows, math.isqrt(rows * block_rows)))
        return max(1, math.ceil(rows / most))

    def block_of(rows: int):
        return F.pmod(F.xxhash64("ml_mapping_id"), F.lit(blocks(rows)))

    def all_blocks(rows: int):
        last = F.lit(blocks(rows) - 1).cast("bigint")
        return F.explode(F.sequence(F.lit(0).cast("bigint"), last))

    items = items.filter(~F.exists("embedding", lambda x: x.isNull()))
    wanted = chosen.join(items, "ml_mapping_id")
    left = wanted.select(
        block_of(seed_count).alias("seed_block"),
        all_blocks(item_count).alias("item_block"),
        F.size("embedding").alias("width"),
        F.col("ml_mapping_id").alias("seed"),
        F.col("embedding").alias("direction"),
    )
    right = items.select(
        all_blocks(seed_count).alias("seed_block"),
        block_of(item_count).alias("item_block"),
        F.size("embedding").alias("width"),
        F.col("ml_mapping_id").alias("cid"),
        "embedding",
    )

    def best_of_block(seed_rows: pd.DataFrame, item_rows: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(all="ignore"):
            return _best_of_block(seed_rows, item_rows, top_k)

    keys = ["seed_block", "item_block", "width"]
    # A number of partitions that adaptive execution leaves alone: few bytes here are much work.
    parts = min(2 * blocks(seed_count) * blocks(item_count), _MOST_PARTS)
    best = (
        left.repartition(parts, *keys)
        .groupBy(*keys)
        .cogroup(right.repartition(parts, *keys).groupBy(*keys))
        .applyInPandas(best_of_block, "ml_mapping_id string, cid string, score double")
    )
    # At most top_k rows per seed and item block are left here.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "cid")))
    return (
        best.groupBy("ml_mapping_id")
        .agg(F.slice(ranked, 1, top_k).alias("near"))
        .select("ml_mapping_id", F.inline("near").alias("far", "cid"))
        .select("ml_mapping_id", "cid", (-F.col("far")).alias("score"))
    )


def answers_from_similar(pairs: DataFrame, similar: DataFrame) -> DataFrame:
    """Scorer answers of (member, place) pairs out of per-place neighbours."""
    per_place = similar.groupBy("ml_mapping_id").agg(
        F.array(F.map_from_entries(F.collect_list(F.struct("cid", "score")))).alias(
            "recommendations"
        )
    )
    distinct = pairs.select("memberId", "ml_mapping_id").distinct()
    return lookup_join(distinct, per_place, ["ml_mapping_id"], "inner").select(
        "memberId", "ml_mapping_id", "recommendations"
    )


def explode_scores(answers: DataFrame) -> DataFrame:
    """One row per recommended place: the array is exploded, then its maps."""
    kept = [c for c in answers.columns if c != "recommendations"]
    return answers.select(*kept, F.explode("recommendations").alias("_scores")).select(
        *kept, F.explode("_scores").alias("cid", "score")
    )
