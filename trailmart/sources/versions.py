"""Marts whose days are versions behind a manifest.

``<mart>/data/version=<id>/<day folder>/...`` holds what one load wrote, ``<mart>/manifest/<n>.json``
says which version each day has since load ``n``. A reader takes the newest manifest once and then
reads the folders that it names, whatever is loaded meanwhile.
"""

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from trailmart import storage

VERSION = "version"


@dataclass(frozen=True)
class Manifest:
    """Load ``number`` of a mart; ``days`` maps day folders, such as ``cre_dtm=2024-01-01``,
    to the versions that make it up: one, unless rows were appended."""

    number: int = 0
    schema: dict | None = None
    partitions: list[str] = field(default_factory=list)
    days: dict[str, list[str]] = field(default_factory=dict)

    @property
    def struct(self) -> StructType | None:
        return StructType.fromJson(self.schema) if self.schema else None


def data_folder(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def manifest_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/manifest/{number:010}.json"


def is_versioned(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path.rstrip('/')}/manifest")


def manifests(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the stored manifests, newest first."""
    stored = storage.names(spark, f"{path.rstrip('/')}/manifest")
    return sorted((int(n.removesuffix(".json")) for n in stored if n.endswith(".json")), reverse=True)


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest:
    """The newest manifest, or that of a load; an empty one when there is none.

    A newest file that is not whole yet is passed over for the one before it.
    """
    for n in manifests(spark, path) if number is None else [number]:
        try:
            return Manifest(**json.loads(storage.read_text(spark, manifest_file(path, n))))
        except json.JSONDecodeError:
            if number is not None:
                raise
    return Manifest()


def as_json(manifest: Manifest) -> str:
    return json.dumps(asdict(manifest))


def day_folder(spark: SparkSession, column: str, day: str | date | None) -> str:
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return named.getPartitionPathString(column, None if day is None else str(day))


def read_days(
    spark: SparkSession,
    path: str,
    known: Manifest,
    folders: Iterable[str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Days of a manifest, by default all, in one scan; days that it does not have are skipped."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    schema = schema or known.struct
    if schema is None:
        raise FileNotFoundError(f"{path} has not been loaded yet")
    wanted = known.days if folders is None else {f: known.days[f] for f in folders if f in known.days}
    if not wanted:
        return spark.createDataFrame([], schema)
    data = data_folder(path)
    with_version = StructType([*schema.fields]).add(VERSION, StringType())
    paths = [f"{data}/{VERSION}={v}/{folder}" for folder, own in sorted(wanted.items()) for v in own]
    return spark.read.schema(with_version).option("basePath", data).parquet(*paths).drop(VERSION)


def read_in_order(
    spark: SparkSession, path: str, schema: StructType | str | None = None, name: str = "position"
) -> DataFrame:
    """A mart written in an order, with each row's place in its day from 1 on; nothing is sorted.

    A place is the row's place in its file behind the rows of the files before it, which are the
    only thing counted. It stays the same when the frame is filtered, and the filters reach the files.
    """
    known = manifest(spark, path)
    day = known.partitions[0] if known.partitions else None
    if any(len(own) > 1 for own in known.days.values()):
        raise ValueError(f"rows were appended to days of {path}, so they have no order")
    rows = read_days(spark, path, known, schema=schema)
    if not known.days:
        return rows.withColumn(name, F.lit(None).cast("bigint"))
    number = [F.regexp_extract("_metadata.file_name", p, 1).cast("long") for p in (r"^part-(\d+)", r"\.c?(\d+)\.")]
    file = F.struct(*(F.coalesce(n, F.lit(0)).alias(f"n{k}") for k, n in enumerate(number))).alias("_file")
    lots = rows.select(F.col(day).alias("_day"), file).groupBy("_day", "_file").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_day").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = lots.select("_day", "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = rows.select("*", file, F.col("_metadata.row_index").alias("_row"))
    joined = placed.join(starts, F.col(day).eqNullSafe(F.col("_day")) & (placed["_file"] == starts["_file"]))
    return joined.select(*rows.columns, (F.col("_start") + F.col("_row") + 1).alias(name))


def changed_days(spark: SparkSession, path: str, since: int) -> list[str]:
    """Day folders whose version is another one than after load ``since``, gone ones included."""
    now, then = manifest(spark, path), manifest(spark, path, since) if since else Manifest()
    return sorted(d for d in {*now.days, *then.days} if now.days.get(d) != then.days.get(d))
