"""Words and five-word shingles of whole texts as 64-bit hashes, batch by batch in numpy.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Texts are UTF-8, in
which no other character holds these bytes, so working on bytes equals working on characters.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHINGLE = 5
#: Texts are worked on in slices of about this many bytes, so that memory stays flat.
SLICE_BYTES = 1 << 18

#: Rows that Spark hands to Python at a time; its default of 10,000 whole texts takes much memory.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(texts: DataFrame) -> DataFrame:
    """The same frame, in a session whose Arrow batches hold at most ``BATCH_ROWS`` rows.

    A session that was set to fewer rows keeps its setting.
    """
    rows = int(texts.sparkSession.conf.get(_BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        texts.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return texts


#: Models that a Python worker keeps. It lives on and serves one operator after another.
HELD_MODELS = 2
_held: dict[tuple, Any] = {}


def held(make: Callable, *key) -> Any:
    """``make(*key)``, kept in this worker for the tasks that follow; the oldest model gives way."""
    name = (make, *key)
    found = _held.pop(name, None)
    if found is None:
        if len(_held) >= HELD_MODELS:
            del _held[next(iter(_held))]
            gc.collect()
        found = make(*key)
    _held[name] = found
    return found


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACES = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(SHINGLE)], np.uint64)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of consecutive texts: hashes, and where each text's words begin (one more entry)."""

    first: int  # the place of the first text in its column
    hashes: np.ndarray
    bounds: np.ndarray


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each text's offsets; null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8), offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes; a longer text is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words(column: pa.Array) -> Iterator[Words]:
    """All words of a string column, in slices."""
    data, offsets = text_buffers(column)
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        begins = offsets[lo : hi + 1] - offsets[lo]
        n = len(part)
        inside = np.zeros(n + 2, bool)
        np.logical_not(_SEPARATOR[part], out=inside[1:-1])
        edge = np.zeros(n + 1, bool)
        edge[begins] = True
        starts = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]))
        ends = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
        power, inverse = _power_tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_LOWER[part] * power[:n], out=total[1:])
        hashes = (total[ends] - total[starts]) * inverse[starts]
        hashes = mix(hashes + (ends - starts).astype(np.uint64) * _BASE)
        yield Words(lo, hashes, np.searchsorted(starts, begins))


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """The hash of the five words from each place on; the last four places are left out."""
    n = max(len(hashes) - SHINGLE + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += hashes[k : k + n] * _PLACES[k]
    return mix(total)


def short_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for the whole of a text of under five words; none for a text without words."""
    k = len(hashes)
    if not k:
        return np.zeros(0, np.uint64)
    total = (hashes * _PLACES[:k]).sum(dtype=np.uint64, keepdims=True)
    return mix(total + _PLACES[k - 1])


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Each text's place and its sorted distinct shingles."""
    for part in words(column):
        grams = shingle_hashes(part.hashes)
        bounds = part.bounds.tolist()
        for k in range(len(bounds) - 1):
            lo, hi = bounds[k], bounds[k + 1]
            if hi - lo >= SHINGLE:
                own = np.sort(grams[lo : hi - SHINGLE + 1])
                keep = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                yield part.first + k, own[keep]
            else:
                yield part.first + k, short_hash(part.hashes[lo:hi])
