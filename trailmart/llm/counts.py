"""Operator 10, token counts by a digest cache.

A cache row is (digest of the content, tokenizer version, number of tokens). Documents are joined
to the cache by digest; only contents that no row has are encoded, each once, and appended. The
content is the text with null as empty, and nothing else is normalised: any other change could
change the count. The version is the digest of the vocabulary file, so another file never meets
the counts of this one.

Null and empty texts count 0. Equal texts share a cache row, however many they are: they are cut
to one row in the map tasks before the shuffle. Rows that are repeated as a whole stay repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm import bpe

CACHE = "digest binary, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()[:32]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bpe.pieces(whole):
                counts = bpe.id_counts(batch.column(1), path)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts)], ["digest", "n_tokens"]
                )

    return run


def read_cache(df: DataFrame, cache: str) -> DataFrame:
    """The stored counts; an absent cache is empty."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)


def count_tokens(
    df: DataFrame, keep: Sequence[str], text_col: str, path: str, cache: str
) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` for every row; new counts are appended to ``cache``.

    ``cache`` is a folder that all executors share. Two runs at a time may both append a count;
    equal rows of the cache are read as one.
    """
    version = tokenizer_version(path)
    content = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest")

    def known() -> DataFrame:
        rows = read_cache(df, cache).where(F.col("version") == version)
        return rows.select("digest", "n_tokens").dropDuplicates(["digest"])

    texts = df.select(digest, content.alias("text"))
    missing = texts.join(known().select("digest"), "digest", "left_anti").dropDuplicates(["digest"])
    counted = missing.mapInArrow(_count(path), "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode(
        "append"
    ).parquet(cache)
    # Renamed, as ``df`` may have columns of the same names.
    rows = df.select(digest.alias("_digest"), F.struct(*keep).alias("_kept"))
    counts = known().toDF("_digest", "n_tokens")
    return rows.join(counts, "_digest").select("_kept.*", "n_tokens")


def fresh_cache(df: DataFrame) -> str:
    """A path for a cache that holds nothing yet, in the shared folder."""
    return scratch.new_folder(df.sparkSession, "token-counts")
