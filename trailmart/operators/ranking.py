"""Top rows per key and numbering within a key, with a total order everywhere.

A filter ``row_number <= n`` directly over its window lets Spark cut every key to n rows inside
each map task, before the shuffle. A key that holds a third of the input therefore arrives as at
most n rows per map task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart import scratch


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; a NULL key is a key of its own."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str = "etl_dtm",
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest row of each key.

    Equal times are decided by ``tiebreak``, by default all other columns in ascending order, so
    the same input always gives the same rows.
    """
    if tiebreak is None:
        skip = {*keys, order_col}
        tiebreak = [
            F.col(f.name).asc()
            for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, (T.MapType, T.VariantType))
        ]
    return top_n(df, keys, [F.col(order_col).desc(), *tiebreak])


def number_within(df: DataFrame, key: str, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each ``key`` from 1 in ``order``, a large key in several tasks.

    All rows are sorted in ranges of key and order and stored, so ranges may cut a key anywhere.
    Only the ranges' parts of keys are counted, and a part starts where the parts before it end.
    Rows that are equal in key and order share a range, in any sequence. The frame is computed
    twice, once for the bounds of the ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # As a struct the key is never NULL, so a NULL key groups and joins like any other.
    named = df.withColumn("_key", F.struct(key))
    sorting = [F.col("_key"), *order]
    ranges = named.repartitionByRange(parts, *sorting).sortWithinPartitions(*sorting)
    # The number of the range in the upper bits, the place in it below.
    stored = scratch.materialise(ranges.withColumn("_at", F.monotonically_increasing_id()))
    placed = stored.withColumn("_range", F.call_function("shiftright", F.col("_at"), F.lit(33)))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_key", "_range")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_base", F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0)) - 1)
        .select("_key", "_range", "_base")
    )
    numbered = placed.join(starts, ["_key", "_range"])
    return numbered.withColumn(name, F.col("_at") - F.col("_base")).select(*df.columns, name)
