"""File writers for Parquet and CSV."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import storage


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of each output folder together, so that tasks do not write everywhere.

    A rebalance is used and not a plain repartition: adaptive execution then splits a folder that
    holds a large share of the rows over several tasks, and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def check_folder_count(df: DataFrame, columns: Sequence[str], limit: int) -> None:
    """Refuse a layout with more than ``limit`` folders, for instance one per member id.

    This computes the folder columns of ``df`` once more.
    """
    folders = df.select(*columns).distinct().limit(limit + 1).count()
    if folders > limit:
        raise ValueError(f"partitioning by {', '.join(columns)} gives more than {limit} folders")


def append_partitions(
    df: DataFrame, path: str, columns: Sequence[str], max_folders: int | None = None
) -> None:
    """Add files to a partitioned Parquet folder. Running it twice stores the rows twice."""
    if max_folders is not None:
        check_folder_count(df, columns, max_folders)
    by_partition(df, columns).write.mode("append").partitionBy(*columns).parquet(path)


def replace_day(
    df: DataFrame, path: str, day: str | date, column: str = "cre_dtm", staging: str | None = None
) -> None:
    """Replace one day of a mart by ``df``, also when it has no rows; other days are refused.

    The rows are first written whole under ``staging`` (by default beside the mart) and the day is
    replaced from there, so ``df`` may read the mart. Until the day is replaced the staged rows
    stay: a run that stopped is finished by ``resume_day``.
    """
    staged = _staged_day(path, day, column, staging)
    df.hint("rebalance").write.mode("overwrite").parquet(staged)
    resume_day(df.sparkSession, path, day, column, staging)


def _staged_day(path: str, day: str | date, column: str, staging: str | None) -> str:
    return f"{(staging or path.rstrip('/') + '_staging').rstrip('/')}/{column}={day}"


def resume_day(
    spark: SparkSession,
    path: str,
    day: str | date,
    column: str = "cre_dtm",
    staging: str | None = None,
) -> bool:
    """Replace a day by its staged rows, if they were written whole; False when there are none."""
    staged = _staged_day(path, day, column, staging)
    if not storage.exists(spark, f"{staged}/_SUCCESS"):
        return False
    rows = spark.read.parquet(staged)
    wanted = F.col(column).eqNullSafe(F.lit(str(day)).cast("date"))
    if not rows.filter(~wanted).isEmpty():
        storage.delete(spark, staged)
        raise ValueError(f"rows of other days than {day}")
    rows.drop(column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={day}")
    storage.delete(spark, staged)
    return True


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace exactly the folders that ``df`` has rows for, so that days can be loaded again."""
    (
        by_partition(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the whole partitioned folder. ``df`` must not read from it."""
    (
        by_partition(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*columns)
        .parquet(path)
    )


def overwrite(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned Parquet folder."""
    df.write.mode("overwrite").parquet(path)


def overwrite_csv(df: DataFrame, path: str, escape: str = "\\") -> None:
    """Replace a CSV folder with a header line in every file."""
    df.write.mode("overwrite").option("header", True).option("escape", escape).csv(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    """Replace a folder of JSON lines."""
    df.write.mode("overwrite").json(path)
