"""Cleansed access logs and what is made directly from raw logs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.functions import payloads, text, times, urls
from trailmart.operators import filters, ranking
from trailmart.sinks import versions
from trailmart.sinks.versions import Load


def cleanse_logs(
    logs: DataFrame,
    run_ts,
    utc_offset_hours: int = 0,
    strip_https: bool = False,
    drop_query: bool = False,
    name_empty: bool = True,
) -> DataFrame:
    """Raw logs with origin-free url, url_part, pathParam, cre_dtm and etl_dtm; no shuffle.

    ``cre_dtm`` is the date of the request time as written, which is UTC, or of the time shifted
    by ``utc_offset_hours``. Request times that cannot be shifted stay as they are.
    ``drop_query`` keeps query strings out of ``url_part`` and so out of the folder names.
    """
    requested = F.col("requestTime")
    if utc_offset_hours:
        requested = F.coalesce(times.shift_iso(requested, utc_offset_hours), requested)
    path = urls.strip_origin(F.col("url"), strip_https)
    named = logs.withColumns({"requestTime": requested, "url": path})
    routed = urls.strip_query(F.col("url")) if drop_query else F.col("url")
    return named.withColumns(
        {
            "url_part": urls.url_part(routed, name_empty),
            "pathParam": urls.path_id(routed),
            "cre_dtm": times.log_date(F.col("requestTime")),
            "etl_dtm": times.run_timestamp(run_ts),
        }
    )


def dedup_logs(cleansed: DataFrame, keys: Sequence[str] = ("traceId",)) -> DataFrame:
    """The newest load of every request; requests without an id all stay."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    newest = ranking.latest_by(cleansed.filter(known), keys)
    return newest.unionByName(cleansed.filter(~known))


def load_log_mart(
    spark: SparkSession,
    cleansed: DataFrame,
    path: str,
    keys: Sequence[str] = ("cre_dtm", "traceId"),
    max_folders: int = versions.MAX_FOLDERS,
) -> Load:
    """Upsert cleansed logs into the log mart, so that a day can be loaded again.

    A request delivered again keeps its request time and so its day; with the day among the keys
    only the days of the batch are read and rewritten. ``keys=("traceId",)`` also finds copies
    on other days, at the price of a pass over the whole mart. Requests without a trace id are
    known by their content, so all of them stay and a rerun does not store them twice. Routes that
    make more than ``max_folders`` folders are refused, and the mart stays as it was.
    """
    return versions.upsert(
        spark, cleansed, path, keys, schemas.LOG_PARTITIONS, optional="traceId", max_folders=max_folders
    )


def shift_request_time(logs: DataFrame, hours: int = 9) -> tuple[DataFrame, DataFrame]:
    """Logs with the request time shifted, and the logs whose time cannot be read.

    Logs without a request time are kept unchanged. A broken line, which the reader gives as a
    row of NULLs (and its text, if asked to keep it), is among those that cannot be read.
    """
    shifted = times.shift_iso(F.col("requestTime"), hours)
    fields = [c for c in logs.columns if c != schemas.BROKEN_LINE]
    anything = F.coalesce(*(F.col(c).cast("string") for c in fields)).isNotNull()
    readable = (F.col("requestTime").isNull() & anything) | shifted.isNotNull()
    return logs.filter(readable).withColumn("requestTime", shifted), logs.filter(~readable)


def cleanse_applications(logs: DataFrame, fixed_offsets: bool = False) -> DataFrame:
    """Typed (requesttime, memberid, groupadminid, applicationid) of application updates.

    Ids are read by JSON key; ``fixed_offsets`` reads them at the two character offsets older
    jobs relied on. Rows with anything missing are dropped.
    """
    request = F.col("request")
    if fixed_offsets:
        # Character offsets of the two ids.
        admin = payloads.fixed_offset_int(request, 17)
        application = payloads.fixed_offset_int(request, 40)
    else:
        parsed = payloads.application_put_request(request)
        admin, application = parsed.getField("groupAdminId"), parsed.getField("applicationId")
    return logs.select(
        F.col("requestTime").try_cast("timestamp").alias("requesttime"),
        payloads.as_int(F.col("memberId")).alias("memberid"),
        admin.alias("groupadminid"),
        application.alias("applicationid"),
    ).na.drop()


def salvage_json(
    lines: DataFrame,
    column: str = "value",
    exclude: str = "/admin",
    across_lines: bool = True,
) -> DataFrame:
    """The JSON text inside raw log lines, in ``json_str``, with escaped line breaks decoded.

    Lines that mention ``exclude`` go, and so do lines without an object, HTML pages among them.
    Choosing lines and cutting the object happen before decoding: neither depends on it, and
    only what is kept has to be rewritten. ``across_lines=False`` looks for the object in each
    decoded line and gives an empty string where there is none.
    """
    wanted = filters.without_text(lines, column, exclude)
    if across_lines:
        found = text.json_object(F.col(column))
        return wanted.filter(found.isNotNull()).select(
            text.unescape_newlines(found).alias("json_str")
        )
    decoded = text.unescape_newlines(F.col(column))
    return wanted.select(text.json_object_of_line(decoded).alias("json_str"))


def parse_salvaged(found: DataFrame, only_payloads: bool = False) -> DataFrame:
    """Typed log columns of salvaged JSON text; decoded line breaks inside values are accepted.

    ``only_payloads`` drops the logs whose response is missing or an HTML page.
    """
    parsed = F.from_json(
        F.col("json_str"), schemas.RAW_LOG, {"allowUnquotedControlChars": "true"}
    )
    logs = found.select(parsed.alias("log")).select("log.*")
    return logs.filter(text.is_payload(F.col("response"))) if only_payloads else logs
