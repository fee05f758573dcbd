"""Operator 8, benchmark decontamination by SimHash windows.

Texts are taken in item-sized windows. Both items and windows have a 128-bit SimHash of their
five-word shingles, weighted by how often each occurs. The fingerprints of the items are indexed
by their 16 bytes: two fingerprints within ``RADIUS`` bits differ by at most ``RADIUS // 16`` bits
in some byte, so looking up every such byte finds all items within the radius. They are verified
by exact weighted Jaccard similarity, the sum of smaller counts over the sum of larger ones.

Windows are laid with a shingle of an item in the item's place, and also from each shingle of an
item on, where the shingles of the item in the window are enough to reach the similarity. A window
that begins elsewhere can be moved right to the next such shingle and loses nothing by it, so no
other window is more similar to an item.
At similarity 0.75 fingerprints differ by 21 bits of 128 on average, and by more than ``RADIUS``
less than once in ten thousand.

Null and empty texts and items match nothing. A text or item of under five words is one shingle,
the whole of it, so a short item is found in texts that have its words and no others. A
text shorter than an item is one window. Items with the same words, whatever their case and white
space, are one item, named by the smallest id. Repeated rows each have their matches. Without items every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.llm import words

SIMILARITY = 0.75
RADIUS = 40
PARTS = 16
#: Items and their bytes to a pass over the documents; more items take more passes.
PASS_ITEMS = 8192
PASS_BYTES = 32 << 20

_NEAR = np.array(
    [[bin(a ^ b).count("1") <= RADIUS // PARTS for b in range(256)] for a in range(256)]
)
_ONES = np.array([bin(a).count("1") for a in range(256)], np.uint8)


def simhash(shingles: np.ndarray) -> np.ndarray:
    """The 16 bytes of a bag's fingerprint: the majority of each bit, ones in a tie."""
    pair = np.empty((len(shingles), 2), np.uint64)
    pair[:, 0] = words.mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    pair[:, 1] = words.mix(shingles ^ np.uint64(0xE7037ED1A0B428DB))
    bits = np.unpackbits(pair.view(np.uint8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) >= len(shingles))


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two bags of shingles."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


class Match(NamedTuple):
    item: int
    start: int
    similarity: float


def _bag(hashes: np.ndarray) -> np.ndarray:
    """The shingles of a text's words; under five words are one shingle."""
    return words.shingle_hashes(hashes) if len(hashes) >= words.SHINGLE else words.short_hash(hashes)


class Index:
    """Fingerprints and shingles of items."""

    def __init__(self, items: Sequence[tuple[int, str]], similarity: float = SIMILARITY) -> None:
        self.similarity = similarity
        names: dict[bytes, int] = {}
        texts = pa.array([t for _, t in items], pa.string())
        bags: dict[bytes, np.ndarray] = {}
        for part in words.words(texts):
            bounds = part.bounds.tolist()
            for k, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                if hi > lo:
                    own = part.hashes[lo:hi]
                    key, name = own.tobytes(), items[part.first + k][0]
                    bags.setdefault(key, _bag(own))
                    old = names.get(key)
                    names[key] = name if old is None else old if name is None else min(old, name)
        self.names = list(names.values())
        self.bags = [bags[k] for k in names]
        size = [len(b) for b in self.bags]
        flat = np.concatenate([np.zeros(0, np.uint64), *self.bags])
        order = np.argsort(flat, kind="stable")
        self._hash = flat[order]
        self._item = np.repeat(np.arange(len(size)), size)[order]
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self._place = place[order].astype(np.int64)
        self._maybe = np.zeros(1 << 20, bool)
        self._maybe[(flat >> np.uint64(44)).astype(np.int64)] = True
        self._length = np.array(size, np.int64)
        self._prints = np.array([simhash(b) for b in self.bags], np.uint8).reshape(-1, PARTS)
        self._by_byte = [
            [np.flatnonzero(_NEAR[value][self._prints[:, j]]) for value in range(256)]
            for j in range(PARTS)
        ]

    def within_radius(self, print_: np.ndarray) -> np.ndarray:
        """All items whose fingerprint differs by at most ``RADIUS`` bits."""
        found = [self._by_byte[j][value] for j, value in enumerate(print_.tolist())]
        some = np.unique(np.concatenate(found))
        far = _ONES[self._prints[some] ^ print_].sum(axis=1)
        return some[far <= RADIUS]

    def windows(self, grams: np.ndarray) -> set[tuple[int, int]]:
        """(start, shingles) of the item-sized windows that are worth a fingerprint."""
        at = np.flatnonzero(self._maybe[(grams >> np.uint64(44)).astype(np.int64)])
        lo = np.searchsorted(self._hash, grams[at], "left")
        many = np.searchsorted(self._hash, grams[at], "right") - lo
        if not many.any():
            return set()
        seed = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        at, item = np.repeat(at, many), self._item[seed]
        size = np.minimum(self._length[item], len(grams))
        last = len(grams) - size
        start = np.clip(at - self._place[seed], 0, last)
        found = set(zip(start.tolist(), size.tolist(), strict=True))
        # Each place of a text that holds a shingle of an item, once for the item, in order.
        place = np.unique(item * (len(grams) + 1) + at)
        item, at = place // (len(grams) + 1), place % (len(grams) + 1)
        length = self._length[item]
        size = np.minimum(length, len(grams))
        start = np.minimum(at, len(grams) - size)
        base = place - at
        most = np.searchsorted(place, base + start + size) - np.searchsorted(place, base + start)
        enough = most * (1 + self.similarity) >= self.similarity * (size + length) - 1e-6
        return found | set(zip(start[enough].tolist(), size[enough].tolist(), strict=True))

    def matches(self, grams: np.ndarray) -> list[Match]:
        """The best window for each item that the text holds."""
        best: dict[int, Match] = {}
        for start, size in sorted(self.windows(grams)):
            bag = grams[start : start + size]
            for k in self.within_radius(simhash(bag)).tolist():
                alike = weighted_jaccard(bag, self.bags[k])
                if alike >= self.similarity and (k not in best or alike > best[k].similarity):
                    best[k] = Match(k, start, alike)
        return [best[k] for k in sorted(best)]


def _passes(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of bounded size, collected one after another."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "))
    rows = items.select(F.col(id_col).alias("id"), plain.alias("text")).where("text <> ''")
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // PASS_ITEMS), -(-(size or 0) // PASS_BYTES))
    # Items with the same words fall into one block.
    block = F.pmod(F.xxhash64("text"), F.lit(2 * blocks if blocks > 1 else 1))
    for k in range(2 * blocks if blocks > 1 else 1):
        found = rows.where(block == k).groupBy("text").agg(F.min("id").alias("id"))
        yield tuple(sorted(((r["id"], r["text"]) for r in found.collect()), key=str))


def _grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for part in words.words(column):
        grams = words.shingle_hashes(part.hashes)
        bounds = part.bounds.tolist()
        for k, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if hi - lo >= words.SHINGLE:
                yield part.first + k, grams[lo : hi - words.SHINGLE + 1]
            elif hi > lo:
                yield part.first + k, words.short_hash(part.hashes[lo:hi])


def find(
    docs: DataFrame,
    items: DataFrame,
    keep: Sequence[str],
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The columns ``keep`` and (item_id, start_word, similarity) for every item that a text holds.

    ``start_word`` counts from 0 and names the window that is most similar, of equals the first.
    """
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("item_id", T.LongType()),
            T.StructField("start_word", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    out = None
    for block in _passes(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = words.held(Index, shared.value, similarity)
            for batch in batches:
                rows = [
                    (at, index.names[m.item], m.start, m.similarity)
                    for at, grams in _grams(batch.column(len(keep)))
                    for m in index.matches(grams)
                ]
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(at) for c in batch.columns[: len(keep)]),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.float64()),
                    ],
                    [*keep, "item_id", "start_word", "similarity"],
                )

        found = words.in_small_batches(docs).select(*keep, text_col).mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    place = docs.columns.index(text_col)
    names = docs.columns
    for block in _passes(items, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = words.held(Index, shared.value, similarity)
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for at, grams in _grams(batch.column(place)):
                    clean[at] = not index.matches(grams)
                yield pa.RecordBatch.from_arrays(batch.filter(pa.array(clean)).columns, names)

        docs = words.in_small_batches(docs).mapInArrow(run, docs.schema)
    return docs
