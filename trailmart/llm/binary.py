"""Operator 6, token ids in ORC files.

Each row is (doc_id, part, n_tokens, ids). The files hold ascending, disjoint ranges of
``doc_id``, and rows ascend within each. ORC writes integers with run-length encoding, cuts files
into stripes that are read by different tasks, and keeps an index with minimum and maximum of
each ``INDEX_ROWS`` rows and a Bloom filter on ``doc_id``, so that a lookup by id reads the files,
stripes and row groups that can hold it.

Null and empty texts have the end id alone. Rows with equal ids follow one another in the order
of their texts. Null ids come first. An empty table makes an empty folder of files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.llm import bpe

STRIPE_BYTES = 16 << 20
FILE_BYTES = 128 << 20
INDEX_ROWS = 1000
STORED = "doc_id long, part int, n_tokens long, ids array<int>"


def _ids(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for whole in batches:
            for batch in bpe.pieces(whole):
                ids = bpe.id_lists(batch.column(1), path)
                ends = ids.offsets.to_numpy()[1:]
                flat = np.insert(ids.values.to_numpy(), ends, end_id).astype(np.int32)
                offsets = np.append(0, ends + np.arange(1, len(ends) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(len(batch), part, np.int32)),
                        pa.array(np.diff(offsets).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    ["doc_id", "part", "n_tokens", "ids"],
                )

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> None:
    """Encode texts, append ``end_id`` to each and write them in ascending order of ids.

    The texts are sorted before they are encoded, so that only text is shuffled and sampling for
    the ranges encodes nothing. ``partitions`` is the number of files. If not given, it grows with
    the texts, ``FILE_BYTES`` of text to a file, from ``spark.sql.shuffle.partitions`` on. Rows
    with one id, or none, are dealt by how their texts begin, so they may lie in several files.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if partitions is None:
        size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + size // FILE_BYTES)
    ranges = rows.repartitionByRange(partitions, "doc_id", F.substring("text", 1, 64))
    ordered = ranges.sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(_ids(path, end_id), STORED)
        .write.option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(INDEX_ROWS))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows; a filter on ``doc_id`` is pushed down to the files' indexes."""
    return spark.read.schema(STORED).orc(folder)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(flat[s:e]) for s, e in zip(offsets, offsets[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(sums, pa.int64())],
            ["doc_id", "part", "n_tokens", "ids_crc32"],
        )


def token_positions(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of stored rows.

    ``start`` is the number of ids of all documents before, in the files' order: the sum over
    earlier parts, of which there are as many as files, and a running sum within the part.
    """
    rows = stored.select("doc_id", "part", "n_tokens", "ids").mapInArrow(
        _checksums, "doc_id long, part int, n_tokens long, ids_crc32 long"
    )
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("doc_id", "n_tokens", "ids_crc32")
    running = F.sum("n_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1))
    return rows.join(parts, "part").select(
        "doc_id",
        (F.col("before") + F.coalesce(running, F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
