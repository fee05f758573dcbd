"""Lookups in the recommendation mart, exports and reports."""

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.operators import filters
from trailmart.operators.joins import lookup_join
from trailmart.sinks import jdbc as jdbc_sink
from trailmart.sources import marts


def recommended_places(recommendations: DataFrame, places: DataFrame) -> DataFrame:
    """Recommendations with the id and the current name of the place, where it is known."""
    known = places.select(F.col("ml_mapping_id").alias("cid"), "id", "name")
    return lookup_join(recommendations.select("memberId", "cid", "score"), known, ["cid"])


def recommendations_for_members(
    recommendations: DataFrame,
    members: DataFrame,
    places: DataFrame,
    images: DataFrame,
    image_key: str = "id",
) -> DataFrame:
    """(memberId, id, cid, score, image_path): one row per image of each recommended place.

    Places without an image are left out.
    """
    wanted = filters.of_members(recommendations, members)
    pictured = images.select(F.col(image_key).alias("id"), "image_path")
    return lookup_join(recommended_places(wanted, places), pictured, ["id"], "inner").select(
        "memberId", "id", "cid", "score", "image_path"
    )


def most_recommended(recommendations: DataFrame, n: int = schemas.TOP_K) -> DataFrame:
    """The ``n`` places recommended most often; equal counts go to the smaller cid."""
    return (
        recommendations.groupBy("cid")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), F.col("cid").asc())
        .limit(n)
    )


def popular_fallback(
    recommendations: DataFrame, members: DataFrame, n: int = schemas.TOP_K
) -> DataFrame:
    """(memberId, cid, count): the most recommended places for members without any row.

    The short top list reaches the members as one scalar subquery, so nothing is cross-joined.
    """
    without = members.select("memberId").distinct().join(
        recommendations.select("memberId").distinct(), "memberId", "left_anti"
    )
    top = most_recommended(recommendations, n).agg(F.collect_list(F.struct("cid", "count")))
    return without.select("memberId", F.inline(top.scalar()).alias("cid", "count"))


def recommendations_or_popular(
    recommendations: DataFrame, members: DataFrame, n: int = schemas.TOP_K
) -> DataFrame:
    """(memberId, cid, score, count): a member's own places with their scores or, for a member
    without any, the places recommended most often with their counts."""
    own = filters.of_members(recommendations, members).select(
        "memberId", "cid", "score", F.lit(None).cast("bigint").alias("count")
    )
    popular = popular_fallback(recommendations, members, n)
    return own.unionByName(popular.withColumn("score", F.lit(None).cast("double")))


def places_or_popular(
    recommendations: DataFrame,
    members: DataFrame,
    places: DataFrame,
    images: DataFrame,
    n: int = schemas.TOP_K,
    image_key: str = "id",
) -> DataFrame:
    """(memberId, id, cid, score, count, image_path) for every member: one row per image of each place.

    A member's own places have a score; a member without any gets the places recommended most
    often, with their counts. Places without an image are left out in either case.
    """
    rows = recommendations_or_popular(recommendations, members, n)
    known = places.select(F.col("ml_mapping_id").alias("cid"), "id")
    pictured = images.select(F.col(image_key).alias("id"), "image_path")
    return lookup_join(lookup_join(rows, known, ["cid"], "inner"), pictured, ["id"], "inner").select(
        "memberId", "id", "cid", "score", "count", "image_path"
    )


def recommendation_coverage(recommendations: DataFrame) -> DataFrame:
    """Complete recommendation rows per member."""
    return recommendations.na.drop().groupBy("memberId").agg(F.count("*").alias("count"))


def export_mart(
    spark: SparkSession,
    mart_path: str,
    mart_schema: str,
    url: str,
    table: str,
    schema: str | None = None,
    properties: Mapping[str, str] | None = None,
    **options: str | int | None,
) -> DataFrame:
    """Replace a database table by a whole mart, as it is after its upsert.

    ``options`` are ``mode``, ``column_types`` and ``connections`` of ``sinks.jdbc.write_table``.
    """
    mart = marts.read_mart(spark, mart_path, mart_schema)
    jdbc_sink.write_table(mart, url, table, schema, properties, **options)
    return mart


def export_period(
    spark: SparkSession,
    mart_path: str,
    end_day: str | date,
    url: str,
    table: str,
    days: int = schemas.EXPORT_DAYS,
    schema: str | None = None,
    properties: Mapping[str, str] | None = None,
    min_day: str | date | None = None,
    require_all_days: bool = False,
    mart_schema: str | None = None,
    **options: str | int | None,
) -> DataFrame | None:
    """Replace a database table by the ``days`` dates up to ``end_day`` of a mart.

    Does nothing and returns None before ``min_day``, while the mart is too young for a period.
    ``options`` are ``mode``, ``column_types`` and ``connections`` of ``sinks.jdbc.write_table``.
    """
    if min_day is not None and marts.as_date(end_day) < marts.as_date(min_day):
        return None
    period = marts.read_period(
        spark, mart_path, end_day, days, require_all_days=require_all_days, schema=mart_schema
    )
    jdbc_sink.write_table(period, url, table, schema, properties, **options)
    return period
