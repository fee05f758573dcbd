"""Readers of partitioned Parquet marts, plain folders or versions behind a manifest."""

from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.sources import files, versions


def as_date(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def read_mart(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The whole mart; filters on partition columns prune folders.

    With a ``schema`` partition values keep their declared types; without one a text column whose
    values all look like numbers would come back as numbers; a manifest brings one.
    """
    if versions.is_versioned(spark, path):
        return versions.read_days(spark, path, versions.manifest(spark, path), schema=schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_partition(
    spark: SparkSession,
    path: str,
    day: str | date,
    column: str = "cre_dtm",
    keep_column: bool = True,
) -> DataFrame:
    """One day of a mart, read from its own folder; an unknown day is an error.

    ``keep_column=False`` leaves the partition column out, as a bare folder read does.
    """
    if versions.is_versioned(spark, path):
        known, folder = versions.manifest(spark, path), f"{column}={as_date(day)}"
        if folder not in known.days:
            raise FileNotFoundError(f"{path} has no {folder}")
        rows = versions.read_days(spark, path, known, [folder])
        return rows if keep_column else rows.drop(column)
    reader = spark.read.option("basePath", path) if keep_column else spark.read
    return reader.parquet(f"{path.rstrip('/')}/{column}={as_date(day)}/")


def days_ending(end_day: str | date, days: int) -> list[date]:
    """The ``days`` dates up to and including ``end_day``, newest first."""
    last = as_date(end_day)
    return [last - timedelta(days=back) for back in range(days)]


def in_period(df: DataFrame, end_day: str | date, days: int, column: str = "cre_dtm") -> DataFrame:
    """Rows of the ``days`` dates up to and including ``end_day``."""
    wanted = days_ending(end_day, days)
    first, last = (F.lit(str(d)).cast("date") for d in (wanted[-1], wanted[0]))
    return df.filter(F.col(column).between(first, last))


def read_period(
    spark: SparkSession,
    path: str,
    end_day: str | date,
    days: int,
    column: str = "cre_dtm",
    require_all_days: bool = False,
    schema: str | None = None,
) -> DataFrame:
    """A period of a mart in one scan; days without a folder are skipped unless required."""
    if versions.is_versioned(spark, path):
        known = versions.manifest(spark, path)
        wanted = [f"{column}={day}" for day in days_ending(end_day, days)]
        missing = [folder for folder in wanted if folder not in known.days]
        if require_all_days and missing:
            raise FileNotFoundError(f"{path} has no {', '.join(missing)}")
        return versions.read_days(spark, path, known, wanted, schema)
    if require_all_days:
        root = path.rstrip("/")
        folders = {str(day): f"{root}/{column}={day}" for day in days_ending(end_day, days)}
        missing = [
            day
            for day, folder in folders.items()
            if files.or_none(partial(files.parquet, spark, folder)) is None
        ]
        if missing:
            raise FileNotFoundError(f"{root} has no {column} for {', '.join(missing)}")
    return in_period(read_mart(spark, path, schema), end_day, days, column)


def query_frame(spark: SparkSession, df: DataFrame, query: str, name: str = "df") -> DataFrame:
    """Run SQL text over a frame; the text refers to it as ``{name}``."""
    return spark.sql(query, **{name: df})


def query_partition(
    spark: SparkSession,
    path: str,
    day: str | date,
    query: str,
    name: str = "df",
    column: str = "cre_dtm",
) -> DataFrame:
    """Run SQL text over one day of a mart."""
    return query_frame(spark, read_partition(spark, path, day, column), query, name)
