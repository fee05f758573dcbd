import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trailmart.sinks import files as sinks
from trailmart.sinks import marts, versions
from trailmart.sources import versions as version_source
from trailmart.sources.marts import read_mart, read_partition, read_period

SCHEMA = "k string, v int, etl_dtm timestamp, cre_dtm date"


def frame(spark, run, *rows):
    df = spark.createDataFrame(list(rows), "k string, v int, day string")
    return df.select(
        "k", "v", F.lit(run).cast("timestamp").alias("etl_dtm"), F.to_date("day").alias("cre_dtm")
    )


def stored(spark, path):
    rows = read_mart(spark, path, SCHEMA).collect()
    return sorted((r.k, r.v, str(r.cre_dtm)) for r in rows)


def files_of(path, day):
    (version,) = manifest_of(path)["days"][f"cre_dtm={day}"]
    return {f.name for f in Path(path, "data", f"version={version}", f"cre_dtm={day}").glob("*.parquet")}


def manifest_of(path):
    return json.loads(max(Path(path, "manifest").glob("*.json")).read_text())


@pytest.fixture(params=["true", "false"])
def adaptive(request, conf):
    conf("spark.sql.adaptive.enabled", request.param)


def test_upsert(spark, folder, adaptive):
    path = f"{folder}/mart"
    first = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), ("a", 3, "2024-01-02"))
    versions.upsert(spark, first, path, ["cre_dtm", "k"], ["cre_dtm"])
    want = [("a", 1, "2024-01-01"), ("a", 3, "2024-01-02"), ("b", 2, "2024-01-01")]
    assert stored(spark, path) == want
    # The same day again: nothing changes.
    versions.upsert(spark, first, path, ["cre_dtm", "k"], ["cre_dtm"])
    assert stored(spark, path) == want
    # A newer run of one day and a new day; the other day keeps its files.
    untouched = files_of(path, "2024-01-02")
    second = frame(spark, "2024-02-02", ("a", 10, "2024-01-01"), ("c", 4, "2024-01-03"))
    out = versions.upsert(spark, second, path, ["cre_dtm", "k"], ["cre_dtm"])
    assert stored(spark, path) == [
        ("a", 3, "2024-01-02"), ("a", 10, "2024-01-01"), ("b", 2, "2024-01-01"), ("c", 4, "2024-01-03"),
    ]
    assert files_of(path, "2024-01-02") == untouched
    assert out.days == ["cre_dtm=2024-01-01", "cre_dtm=2024-01-03"]
    assert sorted((r.k, r.v) for r in out.read(spark).collect()) == [("a", 10), ("b", 2), ("c", 4)]
    assert (out.rows, out.folders, out.number) == (3, 2, 3)
    # An older run does not win.
    versions.upsert(spark, first, path, ["cre_dtm", "k"], ["cre_dtm"])
    assert ("a", 10, "2024-01-01") in stored(spark, path)


def test_upsert_that_moves_rows_between_days(spark, folder, adaptive):
    path = f"{folder}/mart"
    first = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"))
    versions.upsert(spark, first, path, ["k"], ["cre_dtm"])
    versions.upsert(spark, frame(spark, "2024-02-02", ("a", 5, "2024-01-02")), path, ["k"], ["cre_dtm"])
    assert stored(spark, path) == [("a", 5, "2024-01-02"), ("b", 2, "2024-01-02")]


def test_upsert_of_nothing_and_of_a_null_day(spark, folder):
    path = f"{folder}/mart"
    first = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, None))
    versions.upsert(spark, first.limit(0), path, ["k"], ["cre_dtm"])
    versions.upsert(spark, first, path, ["cre_dtm", "k"], ["cre_dtm"])
    versions.upsert(spark, first.limit(0), path, ["cre_dtm", "k"], ["cre_dtm"])
    assert stored(spark, path) == [("a", 1, "2024-01-01"), ("b", 2, "None")]
    versions.upsert(spark, frame(spark, "2024-02-02", ("b", 3, None)), path, ["cre_dtm", "k"], ["cre_dtm"])
    assert stored(spark, path) == [("a", 1, "2024-01-01"), ("b", 3, "None")]


def test_upsert_reads_only_the_days_of_the_batch(spark, folder):
    path = f"{folder}/mart"
    versions.upsert(
        spark, frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("a", 1, "2024-01-02")),
        path, ["cre_dtm", "k"], ["cre_dtm"],
    )
    # A day that cannot be read is no obstacle as long as the batch does not concern it.
    for file in Path(path, "data").glob("*/cre_dtm=2024-01-02/*.parquet"):
        file.write_bytes(b"broken")
        Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)
    versions.upsert(spark, frame(spark, "2024-02-02", ("a", 2, "2024-01-01")), path, ["cre_dtm", "k"], ["cre_dtm"])
    assert [r.v for r in read_partition(spark, path, "2024-01-01").collect()] == [2]


def test_merge_by_name(spark):
    old = spark.createDataFrame([("2024-01-01", 1, "a")], "etl_dtm string, v int, k string")
    new = frame(spark, "2024-02-01", ("b", 2, "2024-01-01")).drop("cre_dtm")
    merged = marts.merge_latest(old, new, ["k"])
    assert merged.schema["etl_dtm"].dataType.simpleString() == "timestamp"
    assert sorted((r.k, r.v) for r in merged.collect()) == [("a", 1), ("b", 2)]


def test_append_keeps_and_replace_replaces(spark, folder):
    path = f"{folder}/m"
    df = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"))
    sinks.append_partitions(df, path, ["cre_dtm"])
    sinks.append_partitions(df, path, ["cre_dtm"])
    assert len(stored(spark, path)) == 4
    sinks.replace_partitions(df.filter("k = 'a'"), path, ["cre_dtm"])
    assert stored(spark, path) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("b", 2, "2024-01-02")]


def test_replace_day(spark, folder):
    path = f"{folder}/m"
    df = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"))
    sinks.append_partitions(df, path, ["cre_dtm"])
    changed = df.withColumn("v", F.lit(9))
    with pytest.raises(ValueError, match="rows of other days"):
        sinks.replace_day(changed, path, "2024-01-01")
    assert stored(spark, path) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]
    sinks.replace_day(changed.filter("cre_dtm = '2024-01-01'"), path, "2024-01-01")
    assert stored(spark, path) == [("a", 9, "2024-01-01"), ("b", 2, "2024-01-02")]
    # A day without new rows is emptied, as deleting it first would do.
    sinks.replace_day(df.limit(0), path, date(2024, 1, 2))
    assert stored(spark, path) == [("a", 9, "2024-01-01")]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_replace_day_may_read_the_mart(spark, folder, conf, adaptive):
    conf("spark.sql.adaptive.enabled", adaptive)
    path = f"{folder}/m"
    spark.range(990).selectExpr("id", "date'2024-01-01' as cre_dtm").write.partitionBy(
        "cre_dtm"
    ).parquet(path)
    sinks.replace_day(spark.read.parquet(path), path, "2024-01-01")
    assert spark.read.parquet(path).distinct().count() == 990


def test_a_stopped_replacement_is_finished(spark, folder):
    path = f"{folder}/m"
    spark.range(5).write.parquet(f"{path}/cre_dtm=2024-01-01")
    staged = spark.range(9).selectExpr("id", "date'2024-01-01' as cre_dtm")
    staged.write.parquet(f"{path}_staging/cre_dtm=2024-01-01")
    assert sinks.resume_day(spark, path, "2024-01-01")
    assert spark.read.parquet(path).count() == 9
    assert not sinks.resume_day(spark, path, "2024-01-01")


def test_too_many_folders_are_refused(spark, folder):
    df = spark.range(20).selectExpr("id", "cast(id as string) as memberId")
    with pytest.raises(ValueError, match="more than 10 folders"):
        sinks.append_partitions(df, f"{folder}/m", ["memberId"], max_folders=10)
    sinks.append_partitions(df, f"{folder}/m", ["memberId"], max_folders=20)


def test_a_hot_folder_is_written_by_several_tasks(spark, folder, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    df = spark.range(200_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("p"),
    )
    sinks.append_partitions(df, f"{folder}/m", ["p"])
    assert len(list(Path(folder, "m", "p=99").glob("*.parquet"))) > 3
    assert spark.read.parquet(f"{folder}/m").count() == 200_000


def test_unpartitioned_overwrite(spark, folder):
    for rows in ([(1,), (2,)], [(3,)]):
        sinks.overwrite(spark.createDataFrame(rows, "v int"), f"{folder}/p")
    assert [r.v for r in spark.read.parquet(f"{folder}/p").collect()] == [3]


@pytest.mark.parametrize("keys", [["cre_dtm", "k"], ["k"]])
def test_a_stopped_load_changes_nothing(spark, folder, monkeypatch, keys):
    path = f"{folder}/mart"
    days = ["2024-01-01", "2024-01-02"]
    versions.upsert(spark, frame(spark, "2024-02-01", *[(d, 1, d) for d in days]), path, keys, ["cre_dtm"])
    before = stored(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(versions.storage, "create_text", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            versions.upsert(spark, frame(spark, "2024-02-02", ("new", 2, "2024-01-01")), path, keys, ["cre_dtm"])
    assert stored(spark, path) == before
    assert len(list(Path(path, "data").iterdir())) == 1
    versions.upsert(spark, frame(spark, "2024-02-03", ("late", 3, "2024-01-02")), path, keys, ["cre_dtm"])
    assert stored(spark, path) == [*before, ("late", 3, "2024-01-02")]


def test_a_reader_sees_the_old_day_or_the_new(spark, folder, monkeypatch):
    path = f"{folder}/mart"
    versions.upsert(spark, frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")), path, ["cre_dtm", "k"], ["cre_dtm"])
    before, opened, seen = stored(spark, path), read_mart(spark, path, SCHEMA), []
    publish = versions.storage.create_text

    def looking(*args):
        # All files of the load are written, its manifest is not.
        seen.append(stored(spark, path))
        return publish(*args)

    monkeypatch.setattr(versions.storage, "create_text", looking)
    versions.upsert(spark, frame(spark, "2024-02-02", ("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")), path, ["cre_dtm", "k"], ["cre_dtm"])
    assert seen == [before]
    # A reader that took its manifest before goes on with it.
    assert sorted((r.k, r.v, str(r.cre_dtm)) for r in opened.collect()) == before
    assert stored(spark, path) == [("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")]
    # A manifest that is not whole yet counts for nothing.
    Path(version_source.manifest_file(path, 3)).write_text('{"number": 3, "da')
    assert stored(spark, path) == [("a", 2, "2024-01-01"), ("b", 2, "2024-01-02")]


def test_of_two_loads_at_a_time_one_is_refused(spark, folder, monkeypatch):
    path = f"{folder}/mart"
    day = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"))
    base = version_source.manifest(spark, path)
    versions.publish(spark, day, path, versions.Layout(["cre_dtm"]), ["cre_dtm=2024-01-01"], base)
    with pytest.raises(versions.LoadConflict):
        versions.publish(spark, day.limit(0), path, versions.Layout(["cre_dtm"]), ["cre_dtm=2024-01-01"], base)
    assert stored(spark, path) == [("a", 1, "2024-01-01")]


def test_versions_of_replaced_days(spark, folder):
    path, day = f"{folder}/mart", versions.Layout(["cre_dtm"])
    df = frame(spark, "2024-02-01", ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("n", 3, None))
    first = versions.replace_days(spark, df, path, day)
    assert sorted(first.days) == ["cre_dtm=2024-01-01", "cre_dtm=2024-01-02", "cre_dtm=__HIVE_DEFAULT_PARTITION__"]
    with pytest.raises(ValueError, match="rows of other days"):
        versions.replace_days(spark, df, path, day, ["2024-01-01"])
    # The rows may come from the mart, and a day without rows is emptied.
    read = read_mart(spark, path, SCHEMA)
    versions.replace_days(spark, read.where("k = 'a'").withColumn("v", F.lit(9)), path, day, ["2024-01-01", None])
    assert stored(spark, path) == [("a", 9, "2024-01-01"), ("b", 2, "2024-01-02")]
    assert version_source.changed_days(spark, path, 1) == ["cre_dtm=2024-01-01", "cre_dtm=__HIVE_DEFAULT_PARTITION__"]
    with pytest.raises(FileNotFoundError):
        read_partition(spark, path, "2024-01-03")
    with pytest.raises(FileNotFoundError, match="2024-01-03"):
        read_period(spark, path, "2024-01-03", 2, require_all_days=True)
    assert read_period(spark, path, "2024-01-03", 2).count() == 1
    versions.append(spark, df.where("k = 'b'"), path, ["cre_dtm"])
    assert stored(spark, path) == [("a", 9, "2024-01-01"), ("b", 2, "2024-01-02"), ("b", 2, "2024-01-02")]
    assert len(versions.forget(spark, path, keep=1)) == 0
    versions.replace_days(spark, df, path, day)
    assert len(versions.forget(spark, path, keep=1)) == 3
    assert len(stored(spark, path)) == 3


def test_a_load_over_too_many_folders_is_not_published(spark, folder):
    path = f"{folder}/mart"
    rows = [(str(n), n, f"2024-01-{1 + n % 20:02}") for n in range(40)]
    with pytest.raises(versions.TooManyFolders):
        versions.append(spark, frame(spark, "2024-02-01", *rows), path, ["cre_dtm", "k"], max_folders=20)
    with pytest.raises(versions.TooManyFolders):
        versions.upsert(spark, frame(spark, "2024-02-01", *rows), path, ["k"], ["cre_dtm"], max_days=10)
    assert not list(Path(path, "data").iterdir())
    assert not version_source.is_versioned(spark, path)


def test_old_rows_are_not_sorted_when_a_few_are_delivered_again(spark, folder):
    path, keys = f"{folder}/mart", ["cre_dtm", "k"]
    old = spark.range(20_000).selectExpr("'k' || id as k", "1 as v", "timestamp'2024-02-01' as etl_dtm", "date'2024-01-01' as cre_dtm")
    versions.upsert(spark, old, path, keys, ["cre_dtm"])
    new = old.where("k like 'k77%'").selectExpr("k", "2 as v", "timestamp'2024-02-02' as etl_dtm", "cre_dtm")
    stored_rows = version_source.read_days(spark, path, version_source.manifest(spark, path))
    by = [*keys, "_content"]
    index = versions._identified(new, None, "etl_dtm").groupBy(*by).agg(F.max("etl_dtm").alias("etl_dtm"))
    merged = versions.merge_by_key(stored_rows, new, index, keys, "etl_dtm", None)
    assert {r.v: r["count"] for r in merged.groupBy("v").count().collect()} == {1: 20_000 - 111, 2: 111}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    old_side = plan[: plan.index("Window")]
    assert "BroadcastHashJoin" in old_side and "SortMergeJoin" not in old_side and "Exchange hashpartitioning" not in old_side


def test_columns_only_the_mart_has_are_kept(spark, folder):
    path = f"{folder}/mart"
    first = frame(spark, "2024-02-01", ("a", 1, "2024-01-01")).withColumn("note", F.lit("x"))
    versions.upsert(spark, first, path, ["cre_dtm", "k"], ["cre_dtm"])
    versions.upsert(spark, frame(spark, "2024-02-02", ("b", 2, "2024-01-01")), path, ["cre_dtm", "k"], ["cre_dtm"])
    rows = read_mart(spark, path).collect()
    assert sorted((r.k, r.v, r.note) for r in rows) == [("a", 1, "x"), ("b", 2, None)]


def scanned_rows(df):
    """Rows that the scan of a frame without a shuffle gave when it was collected."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture
def clustered(spark, folder):
    """100,000 rows of 20,000 members on two days, one day and one member with very many."""
    path = f"{folder}/mart"
    rows = spark.range(100_000).selectExpr(
        "cast(id * 7919 % 1000 as string) as cid",
        "case when id % 3 = 0 then 'busy' else 'm' || (id * 31 % 40000 * 2) end as memberId",
        "case when id % 10 = 0 then date'2024-01-02' else date'2024-01-01' end as cre_dtm",
    )
    layout = versions.Layout(["cre_dtm"], order=("memberId", "cid"), blooms=("memberId",), files=6, row_group_bytes=16_384)
    versions.replace_days(spark, rows, path, layout)
    return path, rows


def test_an_ordered_mart_gives_its_order_back(spark, clustered):
    path, rows = clustered
    found = version_source.read_in_order(spark, path)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Only files are counted and sorted; rows are neither sorted nor shuffled.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for day in ("2024-01-01", "2024-01-02"):
        want = sorted((r.memberId, r.cid) for r in rows.where(f"cre_dtm = '{day}'").collect())
        own = found.where(f"cre_dtm = '{day}'").orderBy("position").collect()
        assert [(r.memberId, r.cid) for r in own] == want
        assert [r.position for r in own] == list(range(1, len(want) + 1))
    # The busy member is written by several tasks.
    files = found.where("memberId = 'busy'").select("cre_dtm", "memberId").inputFiles()
    assert len(files) >= 6


def test_a_lookup_of_a_member_skips_row_groups(spark, clustered):
    path, rows = clustered
    for member, least in (("m31002", 1), ("m31003", 0)):
        found = read_mart(spark, path).where(F.col("memberId") == member)
        assert "PushedFilters: [IsNotNull(memberId), EqualTo(memberId," in found._jdf.queryExecution().toString()
        assert len(found.collect()) == rows.where(F.col("memberId") == member).count() >= least
        assert scanned_rows(found) < 5_000
    # The place of a row does not depend on what else is read.
    places = version_source.read_in_order(spark, path)
    one = places.where("memberId = 'm31002'").collect()
    assert set(map(tuple, one)) <= set(map(tuple, places.collect()))


def test_an_empty_mart_in_order(spark, folder):
    layout = versions.Layout(["cre_dtm"], order=("k",))
    versions.replace_days(spark, frame(spark, "2024-02-01", ("a", 1, "2024-01-01")).limit(0), f"{folder}/m", layout, ["2024-01-01"])
    assert version_source.read_in_order(spark, f"{folder}/m").count() == 0
    with pytest.raises(FileNotFoundError):
        version_source.read_in_order(spark, f"{folder}/unknown")
