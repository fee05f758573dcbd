"""The recommendation mart: each member's favourite place and places like it."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart import schemas, scratch
from trailmart.functions import payloads, times
from trailmart.operators import filters, ranking, scores
from trailmart.operators.joins import lookup_join
from trailmart.sinks import versions
from trailmart.sinks.versions import Layout, Load

_MEMBER_DAY = ["cre_dtm", "memberId"]
LAYOUT = Layout(schemas.DAY_PARTITION, order=("memberId", "cid"), blooms=("memberId",))


def place_views(logs: DataFrame, day: str | date | None = None) -> DataFrame:
    """(cre_dtm, memberId, traceId, id) of every viewed place.

    Views without a member are left out: nobody could be recommended anything for them.
    """
    views = filters.route(logs, schemas.ROUTE_PLACE, "GET", day).filter("memberId is not null")
    return views.select(
        "cre_dtm", "memberId", "traceId", payloads.place_id(F.col("response")).alias("id")
    )


def place_mapping(places: DataFrame) -> DataFrame:
    """(id, ml_mapping_id, copies) of the places whose id is a number."""
    return (
        filters.numeric_id(places)
        .select(F.col("id").try_cast("bigint").alias("id"), "ml_mapping_id")
        .groupBy("id", "ml_mapping_id")
        .agg(F.count("*").alias("copies"))
    )


def member_place_counts(
    logs: DataFrame, places: DataFrame, day: str | date | None = None
) -> DataFrame:
    """Views per day, member and known place, with the smallest trace id among them.

    Views are counted per place id before the dimension is joined, so a popular place or a busy
    member shrinks in the map tasks, and the join moves counts and not log rows. A place listed
    several times in the dimension counts as often, as it would in a join of the views.
    """
    views = (
        place_views(logs, day)
        .filter(F.col("id").isNotNull())
        .groupBy(*_MEMBER_DAY, "id")
        .agg(F.count("*").alias("views"), F.min("traceId").alias("first_trace"))
    )
    known = lookup_join(views, place_mapping(places), ["id"], "inner")
    return known.select(
        *_MEMBER_DAY,
        "ml_mapping_id",
        "id",
        (F.col("views") * F.col("copies")).alias("counts"),
        "first_trace",
    )


def member_top_place(counts: DataFrame, run_ts) -> DataFrame:
    """One row per day and member: the most viewed place and one of the views behind it.

    Equal counts go to the smaller id. The view is the one with the smallest trace id among the
    member's views of any place with the same ml_mapping_id; it comes out of the counts, so the
    logs are not joined a second time.
    """
    candidate = F.struct((-F.col("counts")).alias("fewer"), F.col("id").alias("top_id"))
    view = F.struct(F.col("first_trace").isNull().alias("unknown"), "first_trace", "id")
    per_mapping = counts.groupBy(*_MEMBER_DAY, "ml_mapping_id").agg(
        F.min(candidate).alias("best"), F.min(view).alias("view")
    )
    top = ranking.top_n(
        per_mapping, _MEMBER_DAY, [F.col("best").asc(), F.col("ml_mapping_id").asc()]
    )
    return top.select(
        "memberId",
        "ml_mapping_id",
        (-F.col("best.fewer")).alias("counts"),
        F.col("view.first_trace").alias("traceId"),
        times.run_timestamp(run_ts).alias("etl_dtm"),
        "cre_dtm",
        F.col("view.id").alias("id"),
    )


def top_places(logs: DataFrame, places: DataFrame, run_ts, day: str | date | None = None) -> DataFrame:
    """The rows of ``member_top_place``, found in two steps from the logs.

    Views are counted without their trace ids, which takes no sort, and the trace is looked up
    among the views of the chosen places only. The logs are read twice, the second time without
    the views of all other places; a chosen place with very many views is cut to one row in
    every map task behind the join.
    """
    views = place_views(logs, day).filter(F.col("id").isNotNull())
    mapping = place_mapping(places)
    counts = lookup_join(views.groupBy(*_MEMBER_DAY, "id").agg(F.count("*").alias("views")), mapping, ["id"], "inner")
    best = ranking.top_n(
        counts.withColumn("counts", F.col("views") * F.col("copies")),
        _MEMBER_DAY,
        [F.col("counts").desc(), F.col("id").asc(), F.col("ml_mapping_id").asc()],
    ).select(*_MEMBER_DAY, "ml_mapping_id", "counts")
    chosen = best.join(mapping.select("ml_mapping_id", "id"), "ml_mapping_id")
    day_of = F.col("v.cre_dtm").eqNullSafe(F.col("c.cre_dtm"))
    same = day_of & (F.col("v.memberId") == F.col("c.memberId")) & (F.col("v.id") == F.col("c.id"))
    found = views.alias("v").join(chosen.alias("c"), same).select("v.*", "c.ml_mapping_id", "c.counts")
    first = ranking.top_n(found, _MEMBER_DAY, [F.col("traceId").asc_nulls_last(), F.col("id").asc()])
    return first.select(
        "memberId", "ml_mapping_id", "counts", "traceId", times.run_timestamp(run_ts).alias("etl_dtm"), "cre_dtm", "id"
    )


def member_place_recommend(
    top_places: DataFrame, answers: DataFrame, places: DataFrame
) -> DataFrame:
    """The rows of the recommendation mart, out of top places and the scorer's answers.

    Trace ids are numbered per request, best score first, then by cid, day and member. Most
    requests belong to one member and day, so they have a handful of rows and are numbered where
    they meet. Requests that several share, and rows without one, are looked up first and numbered
    in ranges, so that no task has to hold all rows of one. A recommended place that the
    dimension does not know keeps a NULL name, and an answer to a pair that is no top place gives no
    row. Both inputs are used more than once, so materialise answers of a real model first
    (``trailmart.scratch.materialise``).
    """
    scored = scores.explode_scores(answers).select("memberId", "ml_mapping_id", "cid", "score")
    context = top_places.select(*_MEMBER_DAY, "ml_mapping_id", "traceId", "etl_dtm")
    several = context.groupBy("traceId").count().where("count > 1 or traceId is null")
    several = scratch.materialise(several.select(F.col("traceId").alias("_shared")))
    is_shared = F.col("traceId").eqNullSafe(F.col("_shared"))
    order = [F.col("score").desc(), F.col("cid").asc(), *[F.col(c).asc() for c in _MEMBER_DAY]]

    def rows(context: DataFrame) -> DataFrame:
        return scored.join(context, ["memberId", "ml_mapping_id"])

    if several.isEmpty():
        alone, together = context, None
    else:
        alone = context.join(several, is_shared, "left_anti")
        together = ranking.number_within(rows(context.join(several, is_shared, "left_semi")), "traceId", order, "_n")
    place = F.row_number().over(Window.partitionBy("traceId").orderBy(*order)).cast("bigint")
    numbered = rows(alone).withColumn("_n", place)
    if together is not None:
        numbered = numbered.unionByName(together)
    unique = numbered.withColumn("traceId", F.concat_ws("_", "traceId", F.col("_n").cast("string")))
    names = places.select(F.col("ml_mapping_id").alias("cid"), "name")
    return lookup_join(unique, names, ["cid"]).select(
        "cid", "memberId", "score", "traceId", "etl_dtm", "cre_dtm", "name"
    )


def load_recommendations(
    spark: SparkSession, rows: DataFrame, path: str, days: Sequence[str | date] | None = None
) -> Load:
    """Replace days of the recommendation mart, by default those of ``rows``.

    A day's rows lie in the order of member and cid, so that ``versions.read_in_order`` gives it
    without a sort, and a lookup of a member opens the row groups that can hold it.
    """
    return versions.replace_days(spark, rows, path, LAYOUT, days)


def latest_per_member(recommendations: DataFrame) -> DataFrame:
    """One row per member, the newest."""
    return ranking.latest_by(recommendations, ["memberId"])
