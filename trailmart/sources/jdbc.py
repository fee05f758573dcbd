"""Database tables. Url and credentials always come from the caller."""

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Split(NamedTuple):
    """How to read a table in parallel: a numeric, date or timestamp column and its range."""

    column: str
    lower: int | str
    upper: int | str
    parts: int


def table_options(url: str, table: str, schema: str | None, properties: Mapping[str, str]) -> dict:
    return {
        **properties,
        "url": url,
        "dbtable": f"{schema}.{table}" if schema else table,
    }


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    schema: str | None = None,
    properties: Mapping[str, str] | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A database table; filters and column choices on the result are sent to the database.

    Without ``split`` one task reads everything, which suits small dimensions only.
    """
    options = table_options(url, table, schema, properties or {})
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return spark.read.format("jdbc").options(**options).load()
