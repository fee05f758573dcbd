import pytest

from trailmart import scratch


class FakeSession:
    def __init__(self, setting, master):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_the_named_folder_is_used():
    for master in ("local[8]", "yarn"):
        assert scratch.shared_folder(FakeSession("s3://b/c/", master)) == "s3://b/c"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(FakeSession(None, "yarn"))


def test_a_local_session_has_a_folder():
    assert "trailmart-" in scratch.shared_folder(FakeSession(None, "local[2]"))


def test_materialise_computes_once(spark):
    df = spark.range(100).selectExpr("id", "rand() as r")
    kept = scratch.materialise(df)
    assert kept.collect() == kept.collect()
    assert kept.schema == df.schema or [f.name for f in kept.schema] == [f.name for f in df.schema]
    assert scratch.new_folder(spark, "a") != scratch.new_folder(spark, "a")


def test_discarded_tables_are_gone(spark, tmp_path):
    kept, gone = (scratch.materialise(spark.range(10)) for _ in range(2))
    spark.range(5).write.parquet(f"{tmp_path}/other")
    other = spark.read.parquet(f"{tmp_path}/other")
    scratch.discard(gone, other, spark.range(3).toDF("n"))
    assert kept.count() == 10 and other.count() == 5
    with pytest.raises(Exception, match="(?i)not.?(found|exist)|FILE_NOT_EXIST"):
        gone.collect()
