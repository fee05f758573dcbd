"""Format conversions of whole log folders."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions import urls
from trailmart.sinks import files as sinks
from trailmart.sinks import versions
from trailmart.sinks.versions import Load
from trailmart.sources import files, logs


def json_to_parquet(
    spark: SparkSession,
    paths: files.Paths,
    out: str,
    partitions: Sequence[str] = ("url", "method"),
    max_folders: int = versions.MAX_FOLDERS,
) -> Load:
    """Append JSON logs to a partitioned mart, origins removed from the urls; ``marts.read_mart`` reads it.

    Urls that make more than ``max_folders`` folders are refused while nothing is published.
    """
    read = logs.read_logs(spark, paths).withColumn("url", urls.strip_origin(F.col("url")))
    return versions.append(spark, read, out, partitions, max_folders)


def csv_to_parquet(spark: SparkSession, paths: files.Paths, out: str) -> None:
    sinks.overwrite(files.csv_inferred(spark, paths), out)


def json_to_csv(spark: SparkSession, paths: files.Paths, out: str) -> None:
    sinks.overwrite_csv(logs.read_logs(spark, paths), out)


def column_json_schema(df: DataFrame, column: str) -> DataFrame:
    """One row with the schema shared by the JSON texts of a column, found in one aggregation."""
    parsed = F.try_parse_json(F.col(column))
    return df.agg(F.schema_of_variant_agg(parsed).alias("json_schema"))
