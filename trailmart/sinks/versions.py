"""Loads of marts whose days are versions behind a manifest.

A load writes new versions of its days beside the old ones and then adds one small manifest.
Readers see all days of a load or none. A load that stops before its manifest leaves nothing but
files that no manifest names; ``forget`` deletes those.
"""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmart import scratch, storage
from trailmart.operators import ranking
from trailmart.sinks import files as sinks
from trailmart.sources import versions
from trailmart.sources.versions import Manifest

#: Days of a batch and folders of a load, beyond which a load is refused.
MAX_DAYS = 5_000
MAX_FOLDERS = 50_000


class TooManyFolders(ValueError):
    """A layout that would spread the rows over more folders than allowed."""


class LoadConflict(RuntimeError):
    """Another load was published since this one read the mart."""


@dataclass(frozen=True)
class Load:
    """What a load published: its number, its days, and the rows it wrote for them."""

    path: str
    number: int
    version: str
    days: list[str]
    rows: int
    folders: int

    def read(self, spark: SparkSession) -> DataFrame:
        """What this load wrote, whatever was loaded since."""
        known = versions.manifest(spark, self.path, self.number)
        own = {d: [self.version] for d in self.days if self.version in known.days.get(d, [])}
        return versions.read_days(spark, self.path, replace(known, days=own))


@dataclass(frozen=True)
class Layout:
    """How rows lie in the files of a load.

    Without an ``order``, the rows of a folder come together and large folders are shared by
    several tasks. With one, files hold ascending ranges of the folder columns and ``order``, then
    of all other columns, so that even a day or a member with very many rows is written by
    several tasks; each file is sorted. Row groups are then kept small, as are the ranges of
    values in them, and get a Bloom filter on the columns ``blooms``: a lookup reads few of them.
    """

    partitions: Sequence[str]
    order: Sequence[str] = ()
    blooms: Sequence[str] = ()
    files: int | None = None
    row_group_bytes: int = 16 << 20

    def _sorting(self, df: DataFrame) -> list[str]:
        first = [*self.partitions, *self.order]
        return [*first, *(c for c in sorted(df.columns) if c not in first)]

    def deal(self, df: DataFrame) -> DataFrame:
        if not self.order:
            return sinks.by_partition(df, self.partitions)
        files = self.files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartitionByRange(files, *self._sorting(df))

    def sort(self, df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(*self._sorting(df)) if self.order else df

    def options(self) -> dict[str, str]:
        named = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.blooms}
        return named | ({"parquet.block.size": str(self.row_group_bytes)} if self.order else {})


def publish(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    layout: Layout,
    days: Sequence[str] | None,
    base: Manifest,
    max_folders: int = MAX_FOLDERS,
) -> Load:
    """Write ``rows`` as the new versions of ``days`` and switch to them, or add them to whatever
    days they have if ``days`` is None.

    Given days without a row are emptied. Rows are counted and folders estimated while they are
    written; rows of other days, too many folders and a load published meanwhile are refused, and
    then the mart is as before.
    """
    counts, partitions = Observation(), layout.partitions
    folder = F.struct(*(F.col(c).cast("string") for c in partitions))
    figures = [F.count("*").alias("rows"), F.approx_count_distinct(folder).alias("folders")]
    version = uuid.uuid4().hex
    target = f"{versions.data_folder(path)}/{versions.VERSION}={version}"
    # Counted behind the shuffle, since dealing by ranges passes over the rows before it once more.
    seen = layout.sort(layout.deal(rows).observe(counts, *figures))
    try:
        seen.write.options(**layout.options()).partitionBy(*partitions).parquet(target)
        found = [n for n in storage.names(spark, target) if n.startswith(f"{partitions[0]}=")]
        strange = [] if days is None else sorted(set(found) - set(days))
        if strange:
            raise ValueError(f"rows of other days: {', '.join(strange[:5])}")
        observed = counts.get
        if observed["folders"] > max_folders:
            raise TooManyFolders(f"about {observed['folders']} folders where {max_folders} are allowed")
        kept = {d: v for d, v in base.days.items() if days is None or d not in set(days)}
        new = Manifest(
            base.number + 1,
            rows.schema.jsonValue(),
            list(partitions),
            kept | {d: [*kept.get(d, []), version] for d in found},
        )
        if not storage.create_text(spark, versions.manifest_file(path, new.number), versions.as_json(new)):
            raise LoadConflict(f"load {new.number} of {path} was published by another run")
    except BaseException:
        storage.delete(spark, target)
        raise
    changed = sorted(found if days is None else days)
    return Load(path, new.number, version, changed, observed["rows"], observed["folders"])


def _bounded_days(spark: SparkSession, index: DataFrame, column: str, limit: int) -> list[str]:
    """The day folders of a batch, a short list: more than ``limit`` are refused."""
    found = index.select(F.col(column).cast("string")).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise TooManyFolders(f"the batch has more than {limit} values of {column}")
    return [versions.day_folder(spark, column, value) for (value,) in found]


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """Equality of keys, in which NULL equals NULL."""
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def _identified(df: DataFrame, optional: str | None, order_col: str) -> DataFrame:
    """With ``_content``: for rows without the id ``optional``, a digest of all columns but the load time.

    The two kinds of rows are read apart, so that for rows with an id a key needs no other column.
    """
    if optional is None:
        return df.withColumn("_content", F.lit(None).cast("string"))
    content = F.to_json(F.struct(*sorted({*df.columns} - {order_col})))
    unknown = df.where(F.col(optional).isNull()).withColumn("_content", F.sha2(content.cast("binary"), 256))
    return df.where(F.col(optional).isNotNull()).withColumn("_content", F.lit(None).cast("string")).unionByName(unknown)


def merge_by_key(
    old: DataFrame, new: DataFrame, index: DataFrame, keys: Sequence[str], order_col: str, optional: str | None
) -> DataFrame:
    """Old rows whose key ``new`` does not have, and the newer of both where it has.

    ``old`` holds a key once, as every load leaves it. ``index`` holds the keys of ``new`` with their
    newest load times. Which keys meet is found from the columns of the keys alone. Those are few,
    unless much is delivered again, and only they are joined to the old rows: Spark broadcasts
    them under the session's threshold, and then old rows are neither sorted nor shuffled. At equal
    load times the new row wins.
    """
    by = [*keys, "_content"]
    stored = _identified(old, optional, order_col)
    times = index.select(*by, F.col(order_col).alias("_new"))
    meet = stored.select(*by, F.col(order_col).alias("_old")).alias("o").join(times.alias("n"), _same(by, "o", "n"))
    older = F.col("_old").isNull() | (F.col("_new") >= F.col("_old"))
    met = scratch.materialise(meet.select(*(F.col(f"n.{k}").alias(k) for k in by), F.coalesce(older, F.lit(False)).alias("_wins")))
    batch = ranking.latest_by(_identified(new, optional, order_col), by, order_col)
    kept = stored.alias("o").join(met.where("_wins").alias("m"), _same(by, "o", "m"), "left_anti")
    added = batch.alias("b").join(met.where("not _wins").alias("m"), _same(by, "b", "m"), "left_anti")
    return kept.unionByName(added).drop("_content")


def upsert(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partitions: Sequence[str],
    order_col: str = "etl_dtm",
    optional: str | None = None,
    max_days: int = MAX_DAYS,
    max_folders: int = MAX_FOLDERS,
) -> Load:
    """Merge ``new`` into a mart, the newest row of each key staying; writes the changed days once.

    The keys of ``new`` are stored first, a small table that names the days and is joined to the
    keys of the mart, see ``merge_by_key``; so ``new`` is computed twice, once for its keys. When the
    keys include the first partition column, only the days of ``new`` are read and written, however
    large the mart is. Other keys can move rows between days, so all days are.

    A row whose key column ``optional`` is NULL has no id of its own; its content stands for it.
    Columns that only the mart has are kept.
    """
    first = partitions[0]
    base = versions.manifest(spark, path)
    stored = base.struct or StructType()
    extra = [f for f in stored.fields if f.name not in new.columns]
    new = new.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in extra))
    by = [*keys, "_content"]
    named = _identified(new, optional, order_col)
    newest = F.max(order_col).alias(order_col)
    index = scratch.materialise(named.groupBy(*dict.fromkeys([*by, first])).agg(newest))
    days = _bounded_days(spark, index, first, max_days)
    if first not in keys:
        days = sorted({*days, *base.days})
        index = index.groupBy(*by).agg(newest)
    if not any(d in base.days for d in days):
        merged = ranking.latest_by(named, by, order_col).drop("_content")
    else:
        old = versions.read_days(spark, path, base, days, new.schema)
        merged = merge_by_key(old, new, index, keys, order_col, optional)
    return publish(spark, merged, path, Layout(partitions), days, base, max_folders)


def append(
    spark: SparkSession, rows: DataFrame, path: str, partitions: Sequence[str], max_folders: int = MAX_FOLDERS
) -> Load:
    """Add rows to a mart. Running it twice stores the rows twice."""
    return publish(spark, rows, path, Layout(partitions), None, versions.manifest(spark, path), max_folders)


def replace_days(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    layout: Layout,
    days: Sequence[str | date | None] | None = None,
    max_days: int = MAX_DAYS,
    max_folders: int = MAX_FOLDERS,
) -> Load:
    """Replace whole days by ``rows``, which may read the mart; readers see the old days or the new.

    Given ``days`` are replaced also where ``rows`` has none of them, and rows of other days are
    refused. By default the days of ``rows`` are, which takes a pass over their day column.
    """
    base, column = versions.manifest(spark, path), layout.partitions[0]
    if days is None:
        folders = _bounded_days(spark, rows, column, max_days)
    else:
        folders = [versions.day_folder(spark, column, day) for day in days]
    return publish(spark, rows, path, layout, folders, base, max_folders)


def forget(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` manifests, and the versions that none of those names.

    Loads under way lose what they have written, and readers of older loads their files, so run it
    when neither are about.
    """
    numbers = versions.manifests(spark, path)
    for number in numbers[keep:]:
        storage.delete(spark, versions.manifest_file(path, number))
    used = {v for n in numbers[:keep] for own in versions.manifest(spark, path, n).days.values() for v in own}
    data = versions.data_folder(path)
    gone = [n for n in storage.names(spark, data) if n.removeprefix(f"{versions.VERSION}=") not in used]
    for name in gone:
        storage.delete(spark, f"{data}/{name}")
    return gone
