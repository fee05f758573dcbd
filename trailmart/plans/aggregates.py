"""Daily aggregates of the cleansed logs.

The day is part of every key, so one run serves a day, a period or the whole mart. All of them
are counts that Spark pre-aggregates in the map tasks.
"""

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.functions import payloads, times
from trailmart.operators import filters
from trailmart.sinks import versions
from trailmart.sinks.versions import Layout, Load
from trailmart.sources import versions as log_versions

# Default merge keys of the aggregate marts.
GROUP_COUNT_KEYS = ["cre_dtm"]
APPLICATION_KEYS = ["cre_dtm", "group_id"]
CATEGORY_KEYS = ["cre_dtm", "category_id", "category_name"]


def _count(df: DataFrame, keys: Sequence[str], run_ts) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .withColumn("etl_dtm", times.run_timestamp(run_ts))
    )


def created_group_counting(
    logs: DataFrame, run_ts, day: str | date | None = None, canonical_status: bool = False
) -> DataFrame:
    """Groups created per day: (cre_dtm, count, etl_dtm)."""
    posts = filters.route(logs, schemas.ROUTE_GROUP, "POST", day)
    created = posts.filter(filters.status(schemas.STATUS_CREATED, canonical_status))
    return _count(created, GROUP_COUNT_KEYS, run_ts)


def top_application_groups(
    logs: DataFrame, run_ts, day: str | date | None = None
) -> DataFrame:
    """Applications per day and group. Requests that cannot be parsed count under a NULL group."""
    posts = filters.route(logs, schemas.ROUTE_APPLICATION, "POST", day)
    request = payloads.application_request(F.col("request"))
    return _count(
        posts.select("cre_dtm", request.getField("groupId").alias("group_id")),
        APPLICATION_KEYS,
        run_ts,
    )


def top_group_categories(logs: DataFrame, run_ts, day: str | date | None = None) -> DataFrame:
    """How often each category was chosen per day, whatever the status of the request."""
    posts = filters.route(logs, schemas.ROUTE_GROUP, "POST", day)
    picked = posts.select(
        "cre_dtm", F.explode(payloads.group_categories(F.col("response"))).alias("category")
    )
    return _count(
        picked.select(
            "cre_dtm",
            F.col("category.id").alias("category_id"),
            F.col("category.name").alias("category_name"),
        ),
        CATEGORY_KEYS,
        run_ts,
    )


def by_count(counts: DataFrame, *ties: str) -> DataFrame:
    """Presentation order: highest count first, then the given columns."""
    return counts.orderBy(F.col("count").desc(), *ties)


def load_aggregate(spark: SparkSession, counts: DataFrame, path: str, keys: Sequence[str]) -> Load:
    """Upsert daily counts into their mart.

    ``serving.export_mart`` copies the merged mart to a database table.
    """
    return versions.upsert(spark, counts, path, keys, schemas.DAY_PARTITION)


def refresh_aggregate(
    spark: SparkSession,
    log_mart: str,
    path: str,
    count: Callable[[DataFrame], DataFrame],
    since: int = 0,
) -> Load | None:
    """Count again the days of the log mart that changed after its load ``since``, and only those.

    ``count`` makes daily counts of log rows. Their days replace the stored ones whole, so a day
    that no longer has any row loses its counts. None when no day changed. A run that is
    repeated counts the same days again and stores the same rows.
    """
    changed = log_versions.changed_days(spark, log_mart, since)
    if not changed:
        return None
    logs = log_versions.read_days(spark, log_mart, log_versions.manifest(spark, log_mart), changed)
    base = log_versions.manifest(spark, path)
    return versions.publish(spark, count(logs), path, Layout(schemas.DAY_PARTITION), changed, base)


def total(df: DataFrame, column: str) -> DataFrame:
    """The sum of a column."""
    return df.agg(F.sum(column).alias("total"))
