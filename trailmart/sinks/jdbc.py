"""Database table writers. Url and credentials always come from the caller."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from trailmart.sources.jdbc import table_options


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    schema: str | None = None,
    properties: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    column_types: str | None = None,
    connections: int = 8,
) -> None:
    """Write a frame to a table, by default replacing its rows.

    ``connections`` bounds how many tasks write at a time, since each holds a connection. The
    table is not swapped atomically: after a failed run, run it again in overwrite mode.
    """
    options = table_options(url, table, schema, properties or {})
    options["numPartitions"] = str(connections)
    if column_types:
        options["createTableColumnTypes"] = column_types
    df.write.format("jdbc").options(**options).mode(mode).save()
