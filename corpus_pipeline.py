"""The corpus pipeline: documents of a known language, one of each group of near copies, without
benchmark passages, encoded. Each stage works on all rows that the one before it kept.

Null and empty texts have no language and go in the first stage; repeated rows whose text stays
are near copies of one another. An empty table passes through as an empty one. Columns other than
``doc_id``, ``text`` and ``lang`` are carried along whatever their names; ``n_tokens`` and ``ids``, which
the last stage adds, take the place of columns with those names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm import bpe, decontaminate, jaccard, language
from trailmart.llm.queries import VOCABULARY


def _carried(docs: DataFrame) -> Column:
    """All columns but the text as one, so that no name meets one that a stage uses."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("carried")


def _unpacked(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` again, from ``carried`` and ``text``."""
    return [F.col("text") if c == "text" else F.col("carried")[c].alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain, by dictionaries made from the labelled ones."""
    dictionaries = language.learn(docs.select("text", "lang"))
    found = language.identify(docs.select(_carried(docs), "text"), dictionaries, keep=["carried", "text"])
    return found.where("accepted").select(*_unpacked(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id, and of rows with
    that id the first by a digest of all their columns."""
    rows = docs.select(_carried(docs), "text", F.col("doc_id").alias("id"))
    digest = F.sha2(F.to_json(F.struct("carried", "text")).cast("binary"), 256)
    keyed = scratch.materialise(rows.select("*", digest.alias("digest"), F.monotonically_increasing_id().alias("row")))
    classes = jaccard.shingle_classes(keyed.select("row", "text"), id_col="row", text_col="text")
    first = F.min(F.struct(F.col("id").isNull(), "id", "digest", "row")).alias("first")
    chosen = (
        classes.join(keyed.select("id", "digest", "row"), "row")
        .groupBy("component_id")
        .agg(first)
        .select(F.col("first.row").alias("row"))
    )
    return keyed.join(chosen, "row", "left_semi").select(*_unpacked(docs))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the text that they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    # Written between, so that a task needs one Python worker at a time and not two.
    ids = scratch.materialise(bpe.encode(docs.select(_carried(docs), "text"), ["carried"], "text", path))
    with_ids = bpe.decode(ids, ["carried", "ids"], "ids", path)
    kept = [c for name, c in zip(docs.columns, _unpacked(docs), strict=True) if name not in ("n_tokens", "ids")]
    return with_ids.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("without_benchmark", without_benchmark),
    ("encode", encode),
]

#: Compression and the tokenizer's merges have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
