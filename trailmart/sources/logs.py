"""Access-log readers: JSON lines, one request per line."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import schemas
from trailmart.functions import text
from trailmart.sources import files

_log = logging.getLogger(__name__)


def read_logs(spark: SparkSession, paths: files.Paths) -> DataFrame:
    """JSON lines under a fixed schema; paths may be globs. A broken line gives an all-NULL row."""
    if not paths:
        return spark.createDataFrame([], schemas.RAW_LOG)
    return spark.read.schema(schemas.RAW_LOG).json(paths)


def read_log_day(
    spark: SparkSession,
    folder: str,
    day: str,
    pattern: str = "*.json",
    keep_broken: bool = False,
) -> DataFrame:
    """All matching files below ``folder/day``, with plain or wrapped lines.

    A missing folder gives no rows and a warning; blank lines are passed over. For
    ``keep_broken`` see ``logs_from_lines``.
    """
    path = f"{folder.rstrip('/')}/{day}"
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    found = files.or_none(lambda: reader.text(path))
    if found is None:
        _log.warning("no log folder %s", path)
        found = spark.createDataFrame([], "value string")
    return logs_from_lines(found.filter("trim(value) <> ''"), keep_broken=keep_broken)


def logs_from_lines(
    lines: DataFrame, column: str = "value", keep_broken: bool = False
) -> DataFrame:
    """Typed logs out of text lines, plain JSON or JSON wrapped in a JSON string.

    With ``keep_broken`` a further column, ``schemas.BROKEN_LINE``, holds the text of a line that
    cannot be parsed, and is NULL for all others.
    """
    log = F.from_json(text.unwrap_json_string(F.col(column)), schemas.RAW_LOG)
    if not keep_broken:
        return lines.select(log.alias("log")).select("log.*")
    parsed = lines.select(log.alias("log"), F.col(column).alias(schemas.BROKEN_LINE))
    anything = F.coalesce(*(F.col(f"log.{c}").cast("string") for c in schemas.RAW_LOG_FIELDS))
    return parsed.select(
        "log.*",
        F.when(anything.isNull(), F.col(schemas.BROKEN_LINE)).alias(schemas.BROKEN_LINE),
    )


def read_wrapped_logs(spark: SparkSession, paths: files.Paths) -> DataFrame:
    """Log files whose lines may be JSON strings holding JSON."""
    return logs_from_lines(files.text_lines(spark, paths))
