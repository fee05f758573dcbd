"""One check query per operator of the library; each reads whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import inputs
from harness.inputs import FIRST_RUN, LAST_DAY, SECOND_RUN
from trailmart import schemas, scratch
from trailmart.functions import text, urls
from trailmart.operators import filters, joins, scores
from trailmart.plans import aggregates, cleansing, convert, recommend, serving
from trailmart.sinks import files as sinks
from trailmart.sinks import marts as mart_sinks
from trailmart.sources import files, logs, marts
from trailmart.sources import versions as version_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; dates and timestamps are shown as text, doubles with six digits."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        out = []
        for field in df.schema.fields:
            column = F.col(field.name)
            if isinstance(field.dataType, T.DateType):
                column = column.cast("string")
            elif isinstance(field.dataType, T.TimestampType):
                column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            elif isinstance(field.dataType, T.DoubleType):
                column = F.round(column, 6)
            out.append(column.alias(field.name))
        return df.select(*out)

    QUERIES[build.__name__] = shown
    return build


def _cleansed(spark: SparkSession, sf_dir: str, run_ts: str = FIRST_RUN) -> DataFrame:
    return cleansing.cleanse_logs(inputs.raw_logs(spark, sf_dir), run_ts)


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = inputs.redelivered(inputs.raw_logs(spark, sf_dir))
    return cleansing.cleanse_logs(again, SECOND_RUN)


def _deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _cleansed(spark, sf_dir).unionByName(_redelivered(spark, sf_dir))
    return cleansing.dedup_logs(both)


def _top_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.top_places(_cleansed(spark, sf_dir), inputs.places(spark, sf_dir), FIRST_RUN)


def _answers(spark: SparkSession, sf_dir: str, top_places: DataFrame) -> DataFrame:
    similar = scores.similar_places(top_places, inputs.place_vectors(spark, sf_dir))
    return scores.answers_from_similar(top_places, similar)


def _recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    top_places = scratch.materialise(_top_places(spark, sf_dir))
    answers = scratch.materialise(_answers(spark, sf_dir, top_places))
    return recommend.member_place_recommend(top_places, answers, inputs.places(spark, sf_dir))


def _recommendation_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recommendation mart as its readers find it, on disk, by day, member and cid."""
    return marts.read_mart(spark, recommendation_folder(spark, sf_dir), schemas.RECOMMENDATION)


def recommendation_folder(spark: SparkSession, sf_dir: str) -> str:
    mart = scratch.new_folder(spark, "mart")
    recommend.load_recommendations(spark, scratch.materialise(_recommendations(spark, sf_dir)), mart)
    return mart


def _json_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw logs as JSON files in one folder per day, as the collector leaves them."""
    folder = scratch.new_folder(spark, "json")
    days = inputs.raw_logs(spark, sf_dir).withColumn("day", F.substring("requestTime", 1, 10))
    days.write.partitionBy("day").json(folder)
    return folder


@query
def cleanse_logs(spark, sf_dir):
    return _cleansed(spark, sf_dir)


@query
def cleanse_logs_local_day(spark, sf_dir):
    shifted = cleansing.cleanse_logs(
        inputs.raw_logs(spark, sf_dir), FIRST_RUN, utc_offset_hours=9
    )
    return shifted.select("traceId", "requestTime", "cre_dtm")


@query
def url_classify_pages(spark, sf_dir):
    path = urls.strip_origin(F.col("url"), https=True)
    bare = urls.strip_query(path)
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        path.alias("path"),
        urls.url_part(path).alias("url_part"),
        urls.path_id(path).alias("path_id"),
        urls.url_part(bare).alias("bare_url_part"),
        urls.path_id(bare).alias("bare_path_id"),
    )


@query
def dedup_logs_latest(spark, sf_dir):
    return _deduplicated(spark, sf_dir).select(
        "traceId", "memberId", "url_part", "statusCode", "cre_dtm", "etl_dtm"
    )


@query
def log_mart_rerun(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    cleansing.load_log_mart(spark, _cleansed(spark, sf_dir), mart)
    cleansing.load_log_mart(spark, _redelivered(spark, sf_dir), mart)
    return marts.read_mart(spark, mart, schemas.CLEANSED_LOG)


@query
def log_mart_moved_route(spark, sf_dir):
    """Errors come again with another route and method, refused requests come again unchanged and
    have no trace id."""
    raw = inputs.raw_logs(spark, sf_dir)
    refused = F.col("statusCode") == "400"
    raw = raw.withColumn("traceId", F.when(~refused, F.col("traceId")))
    errors = raw.filter("statusCode = '500'").withColumns(
        {"url": F.concat(F.lit("http://app:9090/moved/"), "traceId"), "method": F.lit("PUT")}
    )
    mart = scratch.new_folder(spark, "mart")
    cleansing.load_log_mart(spark, cleansing.cleanse_logs(raw, FIRST_RUN), mart)
    again = errors.unionByName(raw.filter(refused))
    cleansing.load_log_mart(spark, cleansing.cleanse_logs(again, SECOND_RUN), mart)
    return marts.read_mart(spark, mart, schemas.CLEANSED_LOG)


@query
def created_group_counting(spark, sf_dir):
    return aggregates.created_group_counting(_cleansed(spark, sf_dir), FIRST_RUN)


@query
def upsert_group_counts(spark, sf_dir):
    old = aggregates.created_group_counting(_cleansed(spark, sf_dir), FIRST_RUN)
    rerun = aggregates.created_group_counting(_deduplicated(spark, sf_dir), SECOND_RUN)
    new = marts.in_period(rerun, LAST_DAY, schemas.EXPORT_DAYS)
    return mart_sinks.merge_latest(old, new, aggregates.GROUP_COUNT_KEYS)


@query
def top_application_groups(spark, sf_dir):
    counts = aggregates.top_application_groups(_cleansed(spark, sf_dir), FIRST_RUN)
    return aggregates.by_count(counts, "cre_dtm", "group_id")


@query
def application_mart_rerun(spark, sf_dir):
    cleansed = _cleansed(spark, sf_dir)
    mart = scratch.new_folder(spark, "mart")
    for run_ts, last_day, days in [(FIRST_RUN, "2024-01-20", 20), (SECOND_RUN, LAST_DAY, 15)]:
        counts = aggregates.top_application_groups(
            marts.in_period(cleansed, last_day, days), run_ts
        )
        aggregates.load_aggregate(spark, counts, mart, aggregates.APPLICATION_KEYS)
    return marts.read_mart(spark, mart, schemas.TOP_APPLICATION_GROUPS)


@query
def top_group_categories(spark, sf_dir):
    counts = aggregates.top_group_categories(_cleansed(spark, sf_dir), FIRST_RUN)
    return aggregates.by_count(counts, "cre_dtm", "category_id", "category_name")


@query
def category_latest_any_day(spark, sf_dir):
    loaded = F.date_add("cre_dtm", 1).cast("timestamp")
    counts = aggregates.top_group_categories(_cleansed(spark, sf_dir), loaded)
    before = marts.in_period(counts, "2024-01-29", 29)
    last = marts.in_period(counts, LAST_DAY, 1)
    return mart_sinks.merge_latest(before, last, ["category_id"])


@query
def category_mart_any_day(spark, sf_dir):
    loaded = F.date_add("cre_dtm", 1).cast("timestamp")
    counts = aggregates.top_group_categories(_cleansed(spark, sf_dir), loaded)
    mart = scratch.new_folder(spark, "mart")
    for last_day, days in [("2024-01-29", 29), (LAST_DAY, 1)]:
        part = marts.in_period(counts, last_day, days)
        aggregates.load_aggregate(spark, part, mart, ["category_id"])
    return marts.read_mart(spark, mart, schemas.TOP_GROUP_CATEGORIES)


@query
def cleanse_applications(spark, sf_dir):
    updates = inputs.application_updates(spark, sf_dir)
    by_key = cleansing.cleanse_applications(updates).withColumn("variant", F.lit("key"))
    by_offset = cleansing.cleanse_applications(updates, fixed_offsets=True)
    return by_key.unionByName(by_offset.withColumn("variant", F.lit("offset")))


@query
def member_place_counts(spark, sf_dir):
    return recommend.member_place_counts(
        _cleansed(spark, sf_dir), inputs.places(spark, sf_dir)
    )


@query
def place_views_known(spark, sf_dir):
    views = recommend.place_views(_cleansed(spark, sf_dir))
    known = recommend.place_mapping(inputs.places(spark, sf_dir))
    return joins.lookup_join(views, known, ["id"], "inner", salts=8, spread_by=["traceId"])


@query
def member_top_place(spark, sf_dir):
    return _top_places(spark, sf_dir)


@query
def member_top_place_of_counts(spark, sf_dir):
    counts = recommend.member_place_counts(
        _cleansed(spark, sf_dir), inputs.places(spark, sf_dir)
    )
    return recommend.member_top_place(counts, FIRST_RUN)


@query
def distinct_member_places(spark, sf_dir):
    return _top_places(spark, sf_dir).select("memberId", "ml_mapping_id").distinct()


@query
def similar_places_topk(spark, sf_dir):
    vectors = inputs.place_vectors(spark, sf_dir)
    return scores.similar_places(vectors, vectors)


@query
def scored_by_fixed_answer(spark, sf_dir):
    answer = {str(100000 + k): 1.0 / k for k in range(1, 6)}
    answers = scores.score_members(
        _top_places(spark, sf_dir), scores.fixed_scorer([answer]), partitions=8
    )
    return scores.explode_scores(answers)


@query
def answers_from_store(spark, sf_dir):
    """Half of the members have an answer already; only the others are answered by the new scorer."""
    store = scratch.new_folder(spark, "answers")
    pairs = scratch.materialise(_top_places(spark, sf_dir).select("memberId", "ml_mapping_id"))
    early, late = (scores.fixed_scorer([{f"{kind}{k}": 1.0 / k for k in (1, 2)}]) for kind in ("early", "late"))
    scores.stored_answers(pairs.where("cast(memberId as bigint) % 2 = 0"), early, store, "m1", partitions=4, lots=2)
    return scores.explode_scores(scores.stored_answers(pairs, late, store, "m1", partitions=4, lots=3))


@query
def explode_recommendations(spark, sf_dir):
    top_places = scratch.materialise(_top_places(spark, sf_dir))
    return scores.explode_scores(_answers(spark, sf_dir, top_places))


@query
def member_place_recommend(spark, sf_dir):
    return _recommendations(spark, sf_dir)


@query
def latest_recommendation_per_member(spark, sf_dir):
    loaded = F.date_add("cre_dtm", 1).cast("timestamp")
    rows = _recommendations(spark, sf_dir).withColumn("etl_dtm", loaded)
    return recommend.latest_per_member(rows).select("memberId", "cid", "cre_dtm", "etl_dtm")


@query
def recommendations_for_members(spark, sf_dir):
    return serving.recommendations_for_members(
        _recommendation_mart(spark, sf_dir),
        inputs.members(spark, sf_dir),
        inputs.places(spark, sf_dir),
        inputs.place_images(spark, sf_dir),
    )


@query
def recommendations_of_one_member(spark, sf_dir):
    mine = filters.of_member(_recommendation_mart(spark, sf_dir), 7)
    return serving.recommended_places(mine, inputs.places(spark, sf_dir))


@query
def recommendations_in_order(spark, sf_dir):
    return version_source.read_in_order(spark, recommendation_folder(spark, sf_dir), schemas.RECOMMENDATION)


@query
def recounted_days(spark, sf_dir):
    """Groups per day after requests of three days were delivered again and only those days counted."""
    def count(logs):
        return aggregates.created_group_counting(logs, logs_run)

    log_mart, mart = (scratch.new_folder(spark, name) for name in ("logs", "mart"))
    logs_run = FIRST_RUN
    first = cleansing.load_log_mart(spark, _cleansed(spark, sf_dir), log_mart)
    aggregates.refresh_aggregate(spark, log_mart, mart, count)
    logs_run = SECOND_RUN
    again = _redelivered(spark, sf_dir).filter("cre_dtm in ('2024-01-03', '2024-01-15', '2024-01-29')")
    cleansing.load_log_mart(spark, again, log_mart)
    aggregates.refresh_aggregate(spark, log_mart, mart, count, since=first.number)
    return marts.read_mart(spark, mart, schemas.GROUP_COUNTING)


@query
def most_recommended(spark, sf_dir):
    return serving.most_recommended(_recommendation_mart(spark, sf_dir))


@query
def popular_fallback(spark, sf_dir):
    return serving.popular_fallback(
        _recommendation_mart(spark, sf_dir), inputs.members(spark, sf_dir)
    )


@query
def recommendations_or_popular(spark, sf_dir):
    return serving.recommendations_or_popular(
        _recommendation_mart(spark, sf_dir), inputs.members(spark, sf_dir)
    )


@query
def places_or_popular(spark, sf_dir):
    return serving.places_or_popular(
        _recommendation_mart(spark, sf_dir),
        inputs.members(spark, sf_dir),
        inputs.places(spark, sf_dir),
        inputs.place_images(spark, sf_dir),
    )


@query
def recommendation_coverage(spark, sf_dir):
    return serving.recommendation_coverage(_recommendation_mart(spark, sf_dir))


@query
def period_window(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    counts = aggregates.top_group_categories(_cleansed(spark, sf_dir), FIRST_RUN)
    sinks.append_partitions(counts, mart, schemas.DAY_PARTITION, max_folders=1000)
    return marts.read_period(
        spark, mart, LAST_DAY, schemas.EXPORT_DAYS, require_all_days=True
    )


@query
def query_partition(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    sinks.append_partitions(_cleansed(spark, sf_dir), mart, schemas.LOG_PARTITIONS)
    sql = (
        "select url_part, method, count(*) as requests, count(distinct memberId) as members "
        "from {logs} group by url_part, method"
    )
    return marts.query_partition(spark, mart, "2024-01-15", sql, name="logs")


@query
def route_of_day(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    sinks.append_partitions(_cleansed(spark, sf_dir), mart, schemas.LOG_PARTITIONS)
    read = marts.read_mart(spark, mart, schemas.CLEANSED_LOG)
    return filters.route(read, schemas.ROUTE_GROUP, "POST", "2024-01-15").select(
        "traceId", "memberId", "statusCode", "cre_dtm", "url_part", "method"
    )


@query
def day_folder_logs(spark, sf_dir):
    folder = _json_folder(spark, sf_dir)
    one_day = logs.read_log_day(spark, folder, "day=2024-01-15")
    missing = logs.read_log_day(spark, folder, "day=2023-01-15")
    return one_day.unionByName(missing)


@query
def day_folder_wrapped(spark, sf_dir):
    """A day of plain and wrapped lines, some cut short; those keep their text."""
    folder = scratch.new_folder(spark, "wrapped")
    raw = inputs.raw_logs(spark, sf_dir).filter("requestTime like '2024-01-15%'")
    plain = F.to_json(F.struct(*schemas.RAW_LOG_FIELDS))
    wrapped = F.to_json(F.struct(plain.alias("v")))
    lines = raw.select("statusCode", "traceId", plain.alias("plain"), wrapped.alias("quoted"))
    lines.select(
        F.when(F.col("statusCode") == "500", F.concat(F.lit("{broken "), "traceId"))
        .when(F.col("statusCode") == "201", F.expr("substring(quoted, 6, length(quoted) - 6)"))
        .otherwise(F.col("plain"))
        .alias("value")
    ).write.text(f"{folder}/2024-01-15")
    return logs.read_log_day(spark, folder, "2024-01-15", "*.txt", keep_broken=True)


@query
def json_glob_logs(spark, sf_dir):
    return logs.read_logs(spark, f"{_json_folder(spark, sf_dir)}/day=2024-01-*/*.json")


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines with JSON in the middle: requests, and documents as multi-line responses."""
    requests = inputs.as_json_lines(inputs.raw_logs(spark, sf_dir))
    documents = inputs.as_json_lines(
        inputs.table(spark, sf_dir, "documents").selectExpr(
            "concat('d', cast(doc_id as string)) as traceId",
            "source as memberId",
            "concat('/docs/', lang) as url",
            "text as response",
            "n_chars as time",
        )
    )
    lines = requests.unionByName(documents)
    folder = scratch.new_folder(spark, "lines")
    lines.select(F.concat(F.lit("INFO "), "value", F.lit(" end")).alias("value")).write.text(folder)
    return files.text_lines(spark, folder)


@query
def salvage_raw_logs(spark, sf_dir):
    found = cleansing.salvage_json(_raw_lines(spark, sf_dir))
    return cleansing.parse_salvaged(found)


@query
def salvage_payloads(spark, sf_dir):
    """Salvage without the logs whose response is an HTML page or missing."""
    html = F.concat(F.lit("<!DOCTYPE html>"), "response")
    raw = inputs.raw_logs(spark, sf_dir).withColumn(
        "response",
        F.when(F.col("statusCode") == "400", html).when(F.col("statusCode") != "201", F.col("response")),
    )
    found = cleansing.salvage_json(inputs.as_json_lines(raw))
    return cleansing.parse_salvaged(found, only_payloads=True).select("traceId", "response")


@query
def salvage_single_line(spark, sf_dir):
    found = cleansing.salvage_json(_raw_lines(spark, sf_dir), across_lines=False)
    return cleansing.parse_salvaged(found.filter("json_str <> ''")).select("traceId", "url")


@query
def salvage_through_csv(spark, sf_dir):
    folder = scratch.new_folder(spark, "salvage")
    lines = inputs.as_json_lines(inputs.raw_logs(spark, sf_dir))
    lines.write.text(f"{folder}/lines")
    found = cleansing.salvage_json(files.text_lines(spark, f"{folder}/lines"))
    sinks.overwrite_csv(found, f"{folder}/step0")
    step0 = files.csv_strict(spark, f"{folder}/step0", "json_str string")
    sinks.overwrite_csv(cleansing.parse_salvaged(step0), f"{folder}/step1")
    return files.csv_strict(spark, f"{folder}/step1", schemas.RAW_LOG)


@query
def csv_quarantine(spark, sf_dir):
    """Both parts of CSV files in which failed requests have a time that is no number."""
    folder = scratch.new_folder(spark, "csv")
    time = F.when(F.col("statusCode") == "500", "n/a").otherwise(F.col("time").cast("string"))
    sinks.overwrite_csv(inputs.raw_logs(spark, sf_dir).select("traceId", "memberId", time.alias("time")), folder)
    kept, rejected = files.csv_quarantine(spark, folder, "traceId string, memberId string, time bigint")
    return kept.unionByName(rejected.select("brokenLine"), allowMissingColumns=True)


@query
def shift_request_time(spark, sf_dir):
    shifted, _ = cleansing.shift_request_time(inputs.raw_logs(spark, sf_dir))
    return shifted.select("traceId", "requestTime")


@query
def rejected_request_times(spark, sf_dir):
    dated = inputs.raw_logs(spark, sf_dir).withColumn(
        "requestTime",
        F.when(F.col("statusCode") == "500", F.substring("requestTime", 1, 19))
        .when(F.col("statusCode") == "201", F.lit(None))
        .otherwise(F.col("requestTime")),
    )
    kept, rejected = cleansing.shift_request_time(dated)
    return (
        kept.select(F.lit("kept").alias("part"), "traceId", "requestTime")
        .unionByName(rejected.select(F.lit("rejected").alias("part"), "traceId", "requestTime"))
    )


@query
def place_visits_total(spark, sf_dir):
    counts = recommend.member_place_counts(
        _cleansed(spark, sf_dir), inputs.places(spark, sf_dir)
    )
    return aggregates.total(counts, "counts")


@query
def wrapped_json_lines(spark, sf_dir):
    folder = scratch.new_folder(spark, "wrapped")
    line = F.to_json(F.struct(*schemas.RAW_LOG_FIELDS))
    quoted = F.to_json(F.struct(line.alias("v")))
    wrapped = F.expr("substring(quoted, 6, length(quoted) - 6)")
    lines = inputs.raw_logs(spark, sf_dir).select(
        "method", line.alias("line"), quoted.alias("quoted")
    )
    lines.select(
        F.when(F.col("method") == "POST", wrapped).otherwise(F.col("line")).alias("value")
    ).write.text(folder)
    return logs.read_wrapped_logs(spark, folder)


@query
def format_roundtrip(spark, sf_dir):
    folder = scratch.new_folder(spark, "formats")
    kept = [c for c in schemas.RAW_LOG_FIELDS if c != "url"]
    sinks.overwrite_json(inputs.raw_logs(spark, sf_dir), f"{folder}/json")
    convert.json_to_parquet(spark, f"{folder}/json", f"{folder}/parquet", ["method"])
    convert.json_to_csv(spark, f"{folder}/json", f"{folder}/csv")
    convert.csv_to_parquet(spark, f"{folder}/csv", f"{folder}/csv_parquet")
    from_json = marts.read_mart(spark, f"{folder}/parquet", schemas.RAW_LOG)
    from_csv = files.csv_strict(spark, f"{folder}/csv", schemas.RAW_LOG)
    typed = files.parquet(spark, f"{folder}/csv_parquet")
    inferred = typed.select(
        *[F.col(c).cast("string") for c in kept if c not in ("requestTime", "time")],
        F.date_format("requestTime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("requestTime"),
        "time",
    )
    frames = {"json": from_json, "csv": from_csv, "csv_inferred": inferred}
    out = [df.select(F.lit(name).alias("format"), *kept) for name, df in frames.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def place_csv_numeric_ids(spark, sf_dir):
    folder = scratch.new_folder(spark, "places")
    sinks.overwrite_csv(inputs.places(spark, sf_dir), folder)
    return filters.numeric_id(files.places(spark, folder))


@query
def partition_replace(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    first = aggregates.created_group_counting(_cleansed(spark, sf_dir), FIRST_RUN)
    rerun = aggregates.created_group_counting(_deduplicated(spark, sf_dir), SECOND_RUN)
    sinks.replace_partitions(first, mart, schemas.DAY_PARTITION)
    last_week = marts.in_period(rerun, LAST_DAY, schemas.EXPORT_DAYS)
    sinks.replace_partitions(last_week, mart, schemas.DAY_PARTITION)
    return marts.read_mart(spark, mart, schemas.GROUP_COUNTING)


@query
def recommendation_mart_replace(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    rows = _recommendation_mart(spark, sf_dir)
    sinks.replace_partitions(rows, mart, schemas.DAY_PARTITION)
    again = marts.in_period(rows, LAST_DAY, schemas.EXPORT_DAYS)
    sinks.replace_partitions(again, mart, schemas.DAY_PARTITION)
    return marts.read_mart(spark, mart, schemas.RECOMMENDATION)


@query
def recommendation_day_replace(spark, sf_dir):
    mart = scratch.new_folder(spark, "mart")
    rows = _recommendation_mart(spark, sf_dir)
    sinks.replace_partitions(rows, mart, schemas.DAY_PARTITION)
    sinks.replace_day(rows.filter("cre_dtm = '2024-01-15'"), mart, "2024-01-15")
    sinks.replace_day(rows.filter("cid is null"), mart, LAST_DAY)
    return marts.read_mart(spark, mart, schemas.RECOMMENDATION)


@query
def schema_json(spark, sf_dir):
    folder = _json_folder(spark, sf_dir)
    found = files.json_schema(spark, f"{folder}/day=*/*.json")
    frame = spark.createDataFrame([(found,)], "schema_json string")
    parsed = F.from_json("schema_json", "fields array<struct<name: string, type: string>>")
    return frame.select(F.inline(parsed.getField("fields")))


@query
def column_json_schema(spark, sf_dir):
    return convert.column_json_schema(inputs.table(spark, sf_dir, "events"), "props")


@query
def html_payloads(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    documents = inputs.table(spark, sf_dir, "documents")
    texts = documents.select(F.col("doc_id").alias("page_id"), F.col("text").alias("body"))
    return pages.unionByName(texts).filter(text.is_payload(F.col("body")))
