"""Plain file readers: text, CSV, JSON schema inference, Parquet."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmart import schemas

Paths = str | list[str]


def or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None when its path is not there or holds no file to learn from."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def parquet_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet folder with a known schema, or no rows when it is not there yet."""
    found = or_none(lambda: spark.read.schema(schema).parquet(path))
    return spark.createDataFrame([], schema) if found is None else found


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def text_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Raw lines in one ``value`` column."""
    return spark.read.text(paths)


def csv_inferred(spark: SparkSession, paths: Paths, escape: str = "\\") -> DataFrame:
    """CSV with a header and inferred types. Inference reads the files once more."""
    return spark.read.csv(paths, header=True, inferSchema=True, escape=escape)


def _csv(spark: SparkSession, paths: Paths, schema: str, mode: str, escape: str, multi_line: bool) -> DataFrame:
    lines = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", schemas.BROKEN_LINE)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .csv(paths)
    )
    # Spark only checks the columns a query needs. This is always true and needs all of them, so
    # that every query finds the same lines wanting.
    return lines.filter(F.pmod(F.xxhash64(*lines.columns), F.lit(1)) == 0)


def csv_strict(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    escape: str = "\\",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and given types, without the lines that do not fit.

    CSV does not tell empty text from missing text: both come back as NULL. ``multi_line``
    allows line breaks inside quoted values; such files are not split, so keep them small.
    ``csv_quarantine`` also gives the lines that are left out here.
    """
    return _csv(spark, paths, schema, "DROPMALFORMED", escape, multi_line)


def csv_quarantine(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    escape: str = "\\",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rows that ``csv_strict`` gives, and the lines it drops: (file, brokenLine).

    A line is left out if it has another number of values than the header says, or a value that
    is not of its type. Each frame reads the files for itself.
    """
    broken = F.col(schemas.BROKEN_LINE)
    lines = _csv(spark, paths, f"{schema}, {schemas.BROKEN_LINE} string", "PERMISSIVE", escape, multi_line)
    rejected = lines.filter(broken.isNotNull()).select(F.col("_metadata.file_path").alias("file"), broken)
    return lines.filter(broken.isNull()).drop(schemas.BROKEN_LINE), rejected


def places(spark: SparkSession, paths: Paths) -> DataFrame:
    """The place dimension: CSV with a header, all columns text."""
    return spark.read.schema(schemas.PLACE).csv(paths, header=True)


def json_schema(spark: SparkSession, paths: Paths) -> str:
    """The inferred schema of JSON-lines files, as JSON text."""
    return spark.read.json(paths).schema.json()
