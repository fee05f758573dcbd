"""Operator 1, language identification by compression.

For each language a raw-content Zstandard dictionary is made from sampled pieces of its texts.
A text is compressed whole, in blocks, once with each dictionary; the language whose dictionary
gives the fewest bytes is chosen. The score is the saving over the second best, from 0 to 1; a
text whose saving is under ``min_margin`` is rejected.

A text that is null or has no letter is ``und`` with score 0 and rejected. Ties go to the first
language in order. Without any labelled text every text is ``und``; with one language, all texts
with letters are of it, with score 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trailmart.llm.words import held, in_small_batches

UNKNOWN = "und"
#: The dictionaries are fitted on a sample: so many pieces of so many characters for a language.
SAMPLE_PIECES = 256
PIECE_CHARS = 800
#: Parts of a language's pieces that are put in order apart.
PARTS = 64
#: More languages than this are refused, so that the dictionaries stay small (50 MB at most).
MAX_LANGUAGES = 256
BLOCK_BYTES = 2048
MIN_MARGIN = 0.005
#: Texts whose saving is under ``CLOSE`` are compressed again at the finer level.
LEVEL, FINE_LEVEL, CLOSE = 6, 19, 0.02
SHORT_BYTES = 256


def learn(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    pieces: int = SAMPLE_PIECES,
    piece_chars: int = PIECE_CHARS,
) -> dict[str, bytes]:
    """A dictionary for each language, from a bounded sample of labelled texts.

    Pieces are taken in the order of a hash of their content, so equal texts are taken once and
    the sample does not depend on how the rows are stored. One piece is taken from each text, at
    a place given by the hash of the text.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"), F.lower(F.col(text_col)).alias("text")
    ).where("lang is not null and trim(text) != ''")
    if not _few(rows.select("lang").distinct()):
        return {}
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - piece_chars, F.lit(0)) + 1)
    cut = rows.select(
        "lang", F.substring(F.col("text"), (place + 1).cast("int"), F.lit(piece_chars)).alias("piece")
    )
    # Each hash once, then the first of each part of a language's hashes and of all its parts, so
    # that neither copies nor a common language load one task. Only hashes are dealt out.
    cut = cut.withColumn("order", F.xxhash64("piece", F.lit("sample")))
    first = cut.select("lang", "order").distinct()
    part = F.pmod("order", F.lit(PARTS))
    for by in (["lang", part], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("order"))
        first = first.withColumn("rank", rank).where(F.col("rank") <= pieces)
    taken = cut.join(F.broadcast(first), ["lang", "order"]).groupBy("lang", "rank").agg(F.min("piece").alias("piece"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in taken.select("lang", "rank", "piece").collect():
        texts.setdefault(r["lang"], []).append((r["rank"], r["piece"]))
    return {
        lang: " ".join(p for _, p in sorted(own)).encode() for lang, own in sorted(texts.items())
    }


def _few(counts: DataFrame) -> list:
    rows = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return rows


class _Model:
    def __init__(self, content: tuple[tuple[str, bytes], ...]) -> None:
        self.names = [lang for lang, _ in content]
        self._content = content
        self._by_level: dict[int, list] = {}

    def _compressors(self, level: int) -> list:
        if level not in self._by_level:
            import zstandard

            made = []
            for _, data in self._content:
                held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=level)
                made.append(
                    zstandard.ZstdCompressor(
                        level=level, dict_data=held, write_content_size=False, write_dict_id=False
                    )
                )
            self._by_level[level] = made
        return self._by_level[level]

    def _best(self, blocks: list[bytes], level: int) -> tuple[str, float]:
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self._compressors(level)]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = min((s for k, s in enumerate(sizes) if k != best), default=None)
        return self.names[best], 1.0 if rest is None else (rest - sizes[best]) / rest

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = f" {text.lower()} ".encode()
        if len(data) < SHORT_BYTES:
            # Blocks that save next to nothing are stored as they are; in a text that repeats,
            # what the dictionary saves in its first copy shows.
            data *= 4
        blocks = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
        lang, score = self._best(blocks, LEVEL)
        return self._best(blocks, FINE_LEVEL) if score < CLOSE else (lang, score)


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    keep: Sequence[str],
    text_col: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """The columns ``keep`` and (lang_pred, score, accepted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(dictionaries.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held(_Model, shared.value)
        for batch in batches:
            found = [model.predict(x.as_py()) for x in batch.column(len(keep))]
            langs, scores = [f[0] for f in found], [f[1] for f in found]
            ok = [s >= min_margin and lang != UNKNOWN for lang, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(ok, pa.bool_()),
                ],
                [*keep, "lang_pred", "score", "accepted"],
            )

    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )
    return in_small_batches(docs).select(*keep, text_col).mapInArrow(run, schema)
