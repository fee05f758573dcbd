import random
import re
import threading
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmart.operators import filters, joins, ranking, scores


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- filters ---------------------------------------------------------------------------------


def test_status(spark):
    df = spark.createDataFrame([(s,) for s in ["201", " 201 ", "abc", "201.0", "200", None]], "statusCode string")
    assert tuples(df.filter(filters.status(201))) == [(" 201 ",), ("201",)]
    assert tuples(df.filter(filters.status(201, canonical=True))) == [("201",)]


def test_canonical_status_reaches_the_scan(spark, folder):
    spark.createDataFrame([("201",)], "statusCode string").write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t").filter(filters.status(201, canonical=True))
    assert "EqualTo(statusCode,201)" in plan_of(df)


def test_without_text_drops_null(spark):
    df = spark.createDataFrame([("a/admin/b",), ("a",), (None,)], "v string")
    assert tuples(filters.without_text(df, "v", "/admin")) == [("a",)]


def test_numeric_id(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("1.5",), ("99999999999",)], "id string")
    assert tuples(filters.numeric_id(df)) == [("1",), ("99999999999",)]


def test_members(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c")], "memberId string, v string")
    wanted = spark.createDataFrame([("2",), ("2",), ("9",)], "memberId string")
    assert tuples(filters.of_members(df, wanted)) == [("2", "b"), ("2", "c")]
    assert tuples(filters.of_member(df, 1)) == [("1", "a")]


def test_route_prunes_folders(spark, folder, conf):
    conf("spark.sql.maxMetadataStringLength", "10000")
    rows = [("t", "2024-01-01", "_r", "GET"), ("u", "2024-01-02", "_r", "GET")]
    df = spark.createDataFrame(rows, "traceId string, cre_dtm string, url_part string, method string")
    df.withColumn("cre_dtm", F.to_date("cre_dtm")).write.partitionBy(
        "cre_dtm", "url_part", "method"
    ).parquet(f"{folder}/m")
    found = filters.route(spark.read.parquet(f"{folder}/m"), "_r", "GET", "2024-01-02")
    assert [r.traceId for r in found.collect()] == ["u"]
    pruned = re.search(r"PartitionFilters: \[(.*?)\]", plan_of(found)).group(1)
    assert all(f"({c}#" in pruned for c in ("cre_dtm", "url_part", "method")), pruned


# --- ranking ---------------------------------------------------------------------------------


def test_latest_by_ties_and_null_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), (None, 1, "p"), (None, 3, "q"), ("b", None, "r")]
    df = spark.createDataFrame(rows, "k string, etl_dtm int, v string")
    assert tuples(ranking.latest_by(df, ["k"])) == sorted(
        [("a", 2, "y"), (None, 3, "q"), ("b", None, "r")], key=repr
    )


def test_latest_by_is_the_same_for_any_partitioning(spark, conf):
    rng = random.Random(5)
    rows = [(rng.randint(0, 40), rng.randint(0, 3), rng.randint(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, etl_dtm int, v int")
    seen = set()
    for parts in ("1", "8"):
        conf("spark.sql.shuffle.partitions", parts)
        for spread in (1, 7):
            seen.add(tuple(tuples(ranking.latest_by(df.repartition(spread), ["k"]))))
    assert len(seen) == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    """One key with a third of the rows leaves each map task as a single row."""
    df = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("etl_dtm")
    )
    latest = ranking.latest_by(df, ["k"])
    plan = plan_of(latest)
    partial, shuffle = plan.rfind("row_number(), 1, Partial"), plan.rfind("Exchange hashpartitioning(k")
    assert 0 < shuffle < partial, plan
    assert latest.count() == 200_001
    assert latest.filter("k = 0").first().etl_dtm == 299_997


def test_top_n(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, v int")
    assert tuples(ranking.top_n(df, ["k"], [F.desc("v")], 2)) == [("a", 3), ("a", 4), ("b", 9)]


def test_number_within(spark):
    rows = [("t1", "m1", 5), ("t1", "m1", 9), ("t2", "m2", 1), (None, "m3", 1)]
    df = spark.createDataFrame(rows, "t string, m string, v int")
    numbered = ranking.number_within(df, "t", [F.desc("v")], "n")
    assert numbered.columns == ["t", "m", "v", "n"]
    assert tuples(numbered) == sorted(
        [("t1", "m1", 5, 2), ("t1", "m1", 9, 1), ("t2", "m2", 1, 1), (None, "m3", 1, 1)], key=repr
    )


@pytest.mark.parametrize("parts", ["1", "7", "50"])
def test_number_within_of_a_shared_key(spark, conf, parts):
    conf("spark.sql.shuffle.partitions", parts)
    rows = [(random.Random(i).choice([None, "x", f"t{i % 50}"]), f"m{i % 97}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "t string, m string, v int")
    got = ranking.number_within(df, "t", [F.desc("v")], "n").collect()
    assert Counter((r.t, r.m, r.v) for r in got) == Counter(rows)
    numbers = defaultdict(list)
    for r in got:
        numbers[r.t].append(r.n)
    for found in numbers.values():
        assert sorted(found) == list(range(1, len(found) + 1))
    # The given order holds in however many ranges the key lies.
    in_order = defaultdict(list)
    for r in sorted(got, key=lambda r: r.n):
        in_order[r.t].append(r.v)
    assert all(vs == sorted(vs, reverse=True) for vs in in_order.values())


# --- joins -----------------------------------------------------------------------------------


def hot_facts(spark, rows=60_000):
    return spark.range(rows, numPartitions=12).select(
        "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("k")
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_is_the_plain_join(spark, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = hot_facts(spark, 6000)
    lookup = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = joins.lookup_join(facts, lookup, ["k"], how)
    salted = joins.lookup_join(facts, lookup, ["k"], how, salts=7, spread_by=["id"])
    assert salted.columns == plain.columns
    assert tuples(salted) == tuples(plain)


def test_adaptive_execution_splits_a_hot_key(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    lookup = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup_join(hot_facts(spark), lookup, ["k"])
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan_of(joined)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookups_are_repeated_only_where_spark_splits_no_keys(spark, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = hot_facts(spark, 6000)
    lookup = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = tuples(joins.lookup_join(facts, lookup, ["k"], how))
    for adaptive, skew, repeated in (("true", "true", False), ("true", "false", True), ("false", "true", True)):
        conf("spark.sql.adaptive.enabled", adaptive)
        conf("spark.sql.adaptive.skewJoin.enabled", skew)
        salted = joins.lookup_join(facts, lookup, ["k"], how, salts=7, spread_by=["id"])
        assert tuples(salted) == plain
        assert ("Generate explode" in plan_of(salted)) == repeated


def test_other_joins_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        joins.lookup_join(df, df, ["id"], "full")


# --- scores ----------------------------------------------------------------------------------


def brute_force(vectors, seeds, k):
    out = {}
    for seed in seeds:
        a = np.array(vectors[seed], dtype=float)
        scored = []
        for cid, v in vectors.items():
            b = np.array(v, dtype=float)
            size = np.linalg.norm(a) * np.linalg.norm(b)
            if cid != seed and size > 0:
                scored.append((-round(float(a @ b / size), 9), cid))
        out[seed] = [(cid, -s) for s, cid in sorted(scored)[:k]]
    return {s: v for s, v in out.items() if v}


@pytest.mark.parametrize("block_rows", [1000, 60])
def test_similar_places(spark, block_rows):
    rng = np.random.default_rng(3)
    vectors = {f"p{i}": rng.normal(size=6).astype("float32").tolist() for i in range(290)}
    vectors |= {f"copy{i}": vectors["p1"] for i in range(10)}  # equal scores
    vectors["zero"] = [0.0] * 6
    items = spark.createDataFrame(list(vectors.items()), "ml_mapping_id string, embedding array<float>")
    seeds = ["p1", "p2", "copy3", "zero", "p1", "missing", "p200"]
    seed_rows = spark.createDataFrame([(s,) for s in seeds], "ml_mapping_id string")
    got = defaultdict(list)
    for r in scores.similar_places(seed_rows, items, 5, block_rows).collect():
        got[r.ml_mapping_id].append((r.cid, r.score))
    want = brute_force(vectors, ["p1", "p2", "copy3", "p200"], 5)
    assert {s: sorted(v) for s, v in got.items()} == {s: sorted(v) for s, v in want.items()}


@pytest.mark.parametrize("scale", [1.0, 1e160])
def test_similar_places_that_single_precision_cannot_tell_apart(spark, scale):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=8)
    vectors = {f"p{i:03}": ((middle + 1e-7 * rng.normal(size=8)) * scale).tolist() for i in range(150)}
    vectors |= {f"copy{i}": vectors["p003"] for i in range(30)}
    items = spark.createDataFrame(list(vectors.items()), "ml_mapping_id string, embedding array<double>")
    want = brute_force({c: np.array(v) / scale for c, v in vectors.items()}, vectors, 5)
    for rows in (1000, 16):
        got = defaultdict(list)
        for r in scores.similar_places(items, items, 5, rows).collect():
            got[r.ml_mapping_id].append((r.cid, r.score))
        if scale > 1:  # the product of two lengths is not finite
            assert not any(s for v in got.values() for _, s in v)
        else:
            assert {s: sorted(v) for s, v in got.items()} == {s: sorted(v) for s, v in want.items()}


def test_similar_places_deals_block_pairs(spark):
    items = spark.createDataFrame([(f"p{i}", [float(i), 1.0]) for i in range(400)], "ml_mapping_id string, embedding array<double>")
    near = scores.similar_places(items, items, 5, block_rows=4)
    # 25 blocks of 16 rows a side, not 100 of 4, and partitions that are not put together.
    assert plan_of(near).count(", 1250), REPARTITION_BY_NUM") >= 2
    assert near.count() == 2000


def test_similar_places_with_few_items(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "ml_mapping_id string, embedding array<float>")
    got = scores.similar_places(items, items)
    assert tuples(got.select("ml_mapping_id", "cid")) == [("a", "b"), ("b", "a")]


def test_score_members_asks_each_pair_once(spark, folder):
    from pathlib import Path

    log = Path(folder)

    def scorer(member, place, top_k):
        import uuid

        (log / uuid.uuid4().hex).write_text(f"{member},{place}")
        return [{f"{place}-{n}": 1.0 - n / 10 for n in range(top_k)}]

    pairs = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a"), ("3", "b")], "memberId string, ml_mapping_id string")
    answers = scores.score_members(pairs, scorer, partitions=3, top_k=2)
    rows = tuples(scores.explode_scores(answers))
    assert rows == [
        (m, p, f"{p}-{n}", 1.0 - n / 10) for m, p in [("1", "a"), ("2", "a"), ("3", "b")] for n in (0, 1)
    ]
    assert sorted(f.read_text() for f in log.iterdir()) == ["1,a", "2,a", "3,b"]


def test_score_members_bounds_open_calls(spark, folder):
    from pathlib import Path

    log = Path(folder) / "peak"

    def scorer(member, place, top_k):
        import builtins

        state = builtins.__dict__.setdefault("_open_calls", {"now": 0, "peak": 0, "lock": threading.Lock()})
        with state["lock"]:
            state["now"] += 1
            state["peak"] = max(state["peak"], state["now"])
        time.sleep(0.02)
        with state["lock"]:
            state["now"] -= 1
            log.write_text(str(state["peak"]))
        return [{"x": 1.0}]

    pairs = spark.range(40).selectExpr("cast(id as string) memberId", "'a' ml_mapping_id")
    answers = scores.score_members(pairs, scorer, partitions=1, max_in_flight=3)
    assert answers.count() == 40
    assert 1 < int(log.read_text()) <= 3


def _calling(folder, stop_after=None):
    """A scorer that leaves a file for every call, and fails once there are ``stop_after``."""

    def scorer(member, place, top_k):
        import os
        import uuid

        if stop_after is not None and len(os.listdir(folder)) >= stop_after:
            raise RuntimeError("the model is gone")
        open(f"{folder}/{member}-{place}-{uuid.uuid4().hex}", "w").close()
        return [{"a": 1.0, "b": 0.5}, {"c": 0.25}]

    return scorer


def test_stored_answers_are_not_asked_for_again(spark, tmp_path):
    store, calls = f"{tmp_path}/store", tmp_path / "calls"
    calls.mkdir()
    pairs = spark.createDataFrame([(f"m{n}", "p") for n in range(60)] + [("m1", "p"), ("m1", None)], "memberId string, ml_mapping_id string")
    half = pairs.where("memberId < 'm3'")
    asked = half.distinct().count()
    ask = lambda df, version, **k: scores.stored_answers(df, _calling(calls, **k), store, version, 2, lots=5)
    assert ask(half, "v1").count() == asked == len(list(calls.iterdir()))
    # A run that stops keeps the lots that it finished.
    with pytest.raises(Exception, match="the model is gone"):
        ask(pairs, "v1", stop_after=asked + 20)
    stored = spark.read.parquet(store).count()
    assert asked <= stored < 61
    before = len(list(calls.iterdir()))
    found = ask(pairs, "v1")
    assert found.count() == 61 and found.columns == ["memberId", "ml_mapping_id", "recommendations"]
    assert len(list(calls.iterdir())) - before == 61 - stored
    # Nothing is missing, so nothing is asked, and only the wanted pairs come back.
    assert ask(half, "v1", stop_after=0).count() == asked
    # Another version of the model has no answers yet.
    assert ask(half.limit(4), "v2").count() <= 4
    assert spark.read.parquet(store).where("model_version = 'v1'").count() == 61


def test_fixed_scorer_and_explode(spark):
    pairs = spark.createDataFrame([("1", "a")], "memberId string, ml_mapping_id string")
    answers = scores.score_members(pairs, scores.fixed_scorer([{"x": 0.5}, {"y": 0.25, "z": 0.1}]), 2)
    assert tuples(scores.explode_scores(answers)) == [
        ("1", "a", "x", 0.5), ("1", "a", "y", 0.25), ("1", "a", "z", 0.1),
    ]


def test_explode_scores_of_nothing(spark):
    rows = [("1", "a", None), ("2", "a", []), ("3", "a", [{}])]
    df = spark.createDataFrame(rows, "memberId string, ml_mapping_id string, recommendations array<map<string,double>>")
    assert scores.explode_scores(df).count() == 0
