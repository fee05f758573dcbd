"""Operator 13, removal of word sequences that occurred before, with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document; words are the runs of characters other
than space and 0x09-0x0D, unchanged. A word goes if a window over it also starts earlier: in a
document with a smaller id, or earlier in its own. Windows are judged on the input.

Documents are dealt to chunks of some megabytes by hash. Each chunk sketches its windows: for each
block of the sketch, which is a range of hash values, the distinct marks that its windows have
there. A mark gives a window's place in every row of the block. A task per block adds the chunks'
sketches and takes the least count over the rows, which is never too small, and answers each chunk
with its marks that may be repeated. The chunks then send the first of each such window, and a
task per block finds where it occurs first by a hash of 128 bits of mixed 128-bit word hashes. All
other windows of a chunk are never sent. Chunks and blocks are counted from the size of the texts,
so a task's work does not grow with the corpus, and a window that stands in very many documents
comes once from each chunk.

Null and empty texts have no words. Rows with an equal id come in the order of their texts'
hashes; rows equal in id and text are one document and get equal results. A null id comes before
all others. Very long texts are worked on whole, in one chunk. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmart.llm.words import mix

WINDOW = 20
#: Bytes of text in a chunk, and bytes of text whose windows make a block of the sketch.
CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20
SKETCH_ROWS = 2
#: Places in a row of a block, for each mark in it.
SPARSITY = 4

RESULT = ("n_words", "n_removed", "kept", "removed")
_SKETCH = "block int, chunk int, once binary, more binary"
_ANSWER = "chunk int, block int, marks binary"
_FIRSTS = "block int, chunk int, marks binary, keys binary, spots binary, owners binary, sizes binary"
_LATER = "chunk int, spots binary"
_RESULT = "n_words long, n_removed long, kept string, removed array<struct<start: int, stop: int>>"


def pack(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as compressed steps, the bytes of equal weight together."""
    steps = np.diff(ascending.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    steps = np.ascontiguousarray(planes.T).reshape(-1).view("<u4")
    return np.cumsum(steps, dtype=np.uint32)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and where each text's words begin (one more entry)."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy()
    values = lists.values
    there = pc.greater(pc.binary_length(values), 0)
    before = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))
    return values.filter(there), before[offsets].astype(np.int64)


class Chunk:
    """The distinct documents of a chunk in order, their words and windows."""

    def __init__(self, table: pa.Table, blocks: int, window: int) -> None:
        lowest = np.iinfo(np.int64).min
        ids = pc.fill_null(table["id"].combine_chunks(), lowest).to_numpy()
        ties = table["tie"].to_numpy()
        self.order = np.lexsort((ties, ids))
        ids, ties = ids[self.order], ties[self.order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])
        #: For each row in order, the document that it is.
        self.document = np.cumsum(new) - 1
        self.owners = np.column_stack((ids[new], ties[new]))
        texts = table["text"].combine_chunks().take(pa.array(self.order[new]))
        self.words, self.bounds = split_words(texts)
        self._hash(window)
        self.block = ((self.first >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
        self.mark = (self.first & np.uint64(0xFFFFFFFF)).astype(np.int64)
        #: Block and mark of the distinct windows, which of them each window is, and how many are.
        self.place, self.which, self.count = np.unique(
            self.block << 32 | self.mark, return_inverse=True, return_counts=True
        )

    def _hash(self, window: int) -> None:
        coded = self.words.dictionary_encode()
        raw = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        lanes = np.frombuffer(raw, "<u8").reshape(-1, 2)
        code = coded.indices.to_numpy()
        n = max(len(code) - window + 1, 0)
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))[:n]
        #: The word that each window starts with.
        self.spot = np.flatnonzero(np.arange(n) + window <= ends)
        hashes = []
        for lane, base in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
            own = np.ascontiguousarray(lanes[:, lane])[code]
            total = np.zeros(n, np.uint64)
            for k in range(window):
                total += own[k : k + n] * np.uint64(pow(base, k + 1, 1 << 64))
            hashes.append(mix(total[self.spot]))
        self.first, self.second = hashes

    def firsts(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows among ``wanted`` that stand first in the chunk, and the later ones."""
        order = wanted[np.lexsort((wanted, self.second[wanted], self.first[wanted]))]
        new = np.ones(len(order), bool)
        new[1:] = (self.first[order[1:]] != self.first[order[:-1]]) | (
            self.second[order[1:]] != self.second[order[:-1]]
        )
        return np.sort(order[new]), order[~new]


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) for the runs of sorted numbers."""
    if not len(values):
        return []
    starts = np.flatnonzero(np.diff(values, prepend=values[0] - 1))
    ends = np.append(starts[1:], len(values))
    return list(zip(values[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.table(
        [pa.array(list(c), t) for c, (_, t) in zip(columns, schema, strict=True)],
        names=[n for n, _ in schema],
    )


def _fields(said: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return [(n, kinds[t]) for n, t in (field.split() for field in said.split(", "))]


def _sketch(blocks: int, window: int):
    """A chunk's part of the sketch: its marks in each block, those that it has once and more often."""

    def run(table: pa.Table) -> pa.Table:
        chunk, own = table["chunk"][0].as_py(), Chunk(table, blocks, window)
        marks, often = own.place & 0xFFFFFFFF, own.count > 1
        rows = []
        for block, lo, hi in _runs(own.place >> 32):
            here, more = marks[lo:hi], often[lo:hi]
            rows.append((block, chunk, pack(here[~more]), pack(here[more])))
        return _table(rows, _fields(_SKETCH))

    return run


def estimates(marks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often each mark was added, by the least count of its places; never too few."""
    width = 1 << max(10, int(SPARSITY * len(marks)).bit_length())
    least = np.full(len(marks), np.inf)
    for row in range(SKETCH_ROWS):
        place = mix(marks.astype(np.uint64) + np.uint64(row + 1 << 40)) & np.uint64(width - 1)
        place = place.astype(np.int64)
        counts = np.bincount(place, weights, width)
        np.minimum(least, counts[place], out=least)
    return least


def _merge(table: pa.Table) -> pa.Table:
    """Add the sketches of a block; each chunk gets its marks back that may stand elsewhere too."""
    block, chunks = table["block"][0].as_py(), table["chunk"].to_pylist()
    once = [unpack(p) for p in table["once"].to_pylist()]
    more = [unpack(p) for p in table["more"].to_pylist()]
    marks = np.concatenate(once + more)
    weights = np.ones(len(marks), np.int8)
    weights[sum(map(len, once)) :] = 2
    likely = estimates(marks, weights) > 1
    rows, at = [], 0
    for chunk, own in zip(chunks, once, strict=True):
        hit = own[likely[at : at + len(own)]]
        at += len(own)
        if len(hit):
            rows.append((chunk, block, pack(hit)))
    return _table(rows, _fields(_ANSWER))


def _first_places(blocks: int, window: int):
    """The windows of a chunk that may be repeated, the first of each, with their documents."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, own = table["chunk"][0].as_py(), Chunk(table, blocks, window)
        told = [
            unpack(m).astype(np.int64) | b << 32
            for b, m in zip(answers["block"].to_pylist(), answers["marks"].to_pylist(), strict=True)
        ]
        likely = own.count > 1
        if told:
            likely[np.searchsorted(own.place, np.concatenate(told))] = True
        first, _ = own.firsts(np.flatnonzero(likely[own.which]))
        first = first[np.argsort(own.block[first], kind="stable")]
        document = np.searchsorted(own.bounds, own.spot[first], "right") - 1
        rows = []
        for block, lo, hi in _runs(own.block[first]):
            here, runs = first[lo:hi], _runs(document[lo:hi])
            rows.append(
                (
                    block,
                    chunk,
                    own.mark[here].astype("<u4").tobytes(),
                    own.second[here].astype("<u8").tobytes(),
                    pack(own.spot[here]),
                    own.owners[[d for d, _, _ in runs]].astype("<i8").tobytes(),
                    np.array([t - f for _, f, t in runs], "<u4").tobytes(),
                )
            )
        return _table(rows, _fields(_FIRSTS))

    return run


def _resolve(table: pa.Table) -> pa.Table:
    """Which windows of each chunk stand in an earlier document of another chunk."""
    pieces = table.to_pylist()
    joined = lambda name, kind: np.frombuffer(b"".join(p[name] for p in pieces), kind)
    marks, keys = joined("marks", "<u4"), joined("keys", "<u8")
    owners = np.repeat(joined("owners", "<i8").reshape(-1, 2), joined("sizes", "<u4"), axis=0)
    order = np.lexsort((owners[:, 1], owners[:, 0], keys, marks))
    later = np.zeros(len(order), bool)
    later[order[1:]] = (marks[order[1:]] == marks[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]])
    rows, at = [], 0
    for piece in pieces:
        spots = unpack(piece["spots"])
        hit = spots[later[at : at + len(spots)]]
        at += len(spots)
        if len(hit):
            rows.append((piece["chunk"], pack(hit)))
    return _table(rows, _fields(_LATER))


def _remove(blocks: int, window: int):
    """The documents of a chunk without the words under later windows."""

    def run(table: pa.Table, later: pa.Table) -> pa.Table:
        own = Chunk(table, blocks, window)
        _, within = own.firsts(np.flatnonzero((own.count > 1)[own.which]))
        spots = [own.spot[within], *(unpack(s).astype(np.int64) for s in later["spots"].to_pylist())]
        step = np.zeros(len(own.words) + window + 1, np.int64)
        for part in spots:
            np.add.at(step, part, 1)
            np.add.at(step, part + window, -1)
        gone = np.cumsum(step)[: len(own.words)] > 0
        before = np.append(0, np.cumsum(gone))[own.bounds]
        n_words, n_removed = np.diff(own.bounds), np.diff(before)
        kept = pc.binary_join(
            pa.ListArray.from_arrays(
                pa.array(own.bounds - before, pa.int32()), own.words.filter(pa.array(~gone))
            ),
            " ",
        )
        edge = np.zeros(len(gone) + 1, bool)
        edge[own.bounds] = True
        starts = np.flatnonzero(gone & (edge[:-1] | ~np.append(False, gone[:-1])))
        stops = np.flatnonzero(gone & (edge[1:] | ~np.append(gone[1:], False))) + 1
        document = np.searchsorted(own.bounds, starts, "right") - 1
        base = own.bounds[document]
        removed = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(starts, own.bounds), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(starts - base, pa.int32()), pa.array(stops - base, pa.int32())], ["start", "stop"]
            ),
        )
        rows = pa.array(own.document)
        return pa.table(
            [
                table["carried"].combine_chunks().take(pa.array(own.order)),
                pa.array(n_words).take(rows),
                pa.array(n_removed).take(rows),
                kept.take(rows),
                removed.take(rows),
            ],
            names=["carried", *RESULT],
        )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``keep`` (the id if not given) and, for every document, the number of words and
    of removed ones, the kept words joined by one space, and the removed ranges of words.

    A column of ``keep`` that is named like one of the results gives way to it. All steps are one
    plan, in which the dealing of the texts to chunks stands once and is used three times.
    """
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    chunks, blocks = (1 + size // part for part in (chunk_bytes, block_bytes))
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = [c for c in (keep or [id_col]) if c not in RESULT]
    row = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text).alias("tie"),
        text.alias("text"),
        F.struct(*carried, F.lit(None).cast("int").alias("_")).alias("carried"),
    )
    chunk = F.pmod(F.xxhash64("id", "tie"), F.lit(chunks)).cast("int").alias("chunk")
    dealt = row.select(chunk, "id", "tie", "text", "carried")
    by_chunk = dealt.groupBy("chunk")
    sketches = by_chunk.applyInArrow(_sketch(blocks, window), _SKETCH)
    answers = sketches.groupBy("block").applyInArrow(_merge, _ANSWER)
    firsts = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_first_places(blocks, window), _FIRSTS)
    later = firsts.groupBy("block").applyInArrow(_resolve, _LATER)
    schema = StructType([dealt.schema["carried"], *StructType.fromDDL(_RESULT)])
    result = by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(_remove(blocks, window), schema)
    return result.select(*(F.col("carried")[c].alias(c) for c in carried), *RESULT)
