"""Shared working storage: reliable checkpoints and folders for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from trailmart import storage


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a folder of
    one machine would be of no use to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="trailmart-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute a frame once and cut its lineage, by a table in the shared folder.

    For results that are costly or not repeatable, such as model answers, and that feed several
    consumers. ``discard`` deletes the table when the last of them has been computed.
    """
    spark = df.sparkSession
    path = new_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more; other frames are left alone."""
    for df in stored:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("table-"):
                storage.delete(df.sparkSession, folder)
