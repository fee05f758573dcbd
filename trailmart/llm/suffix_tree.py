"""Operator 7, scores by a probabilistic suffix tree over words.

Symbols are the words of a text and one end. Counts of all training words give the root of the
tree, an add-one distribution that also covers unknown words. A node is a context of one or more
words before a symbol. It lists the symbols whose own part of its divergence from its parent, times
how often it occurs, exceeds half the logarithm of the corpus size, with discounted frequencies,
and leaves the rest of its mass to its parent, so every node is a distribution. A node is kept if
its whole divergence repays all that it lists. A symbol is scored by the longest context that was
kept.

A follower seen once never repays its place: its parent gives it at least two in the size of the
corpus and its words. The tree grows by one word at a time, without a limit, until no kept context
can have a longer one. A longer context is tried below a kept one that has several followers;
below one that is always followed by the same symbol, longer ones say the same and would not be
kept. A follower that could not repay its place below a context even if it always followed is not
counted there.

Every word, context and listed follower that occurs ``LEAST`` times counts, however large the
corpus is, so all of them stay tables. The logarithm of a symbol's probability is a sum over the
runs of words that end with it: each word adds its part of the root, each listed follower what it
gains over the parent, and each kept context what it leaves to its parent. So runs are looked up
by one hash each, in buckets, and added up by text. Only bounded things are sent to the tasks, and
none changes a result: the most frequent words, as short numbers while runs are counted, the most
frequent runs with their values while texts are scored, and sieves of bits that let through all
runs of a table and few others. Runs leave a task packed by bucket, where numpy sums them up, so
that Spark has rows only of those that occur ``LEAST`` times. The whole tree is packed too, and so
are the rare runs of a lot of texts: ascending hashes, by the steps between them, and beside each
its text's place in the lot.

Null and empty texts are the end alone. Ids may repeat or be null; every row has its own score.
Without training texts the root gives every symbol probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm import words

#: Runs that make up ``1 / MAX_WORDS`` of the corpus are looked up in the tasks, others are joined.
MAX_WORDS = 1 << 20
#: Contexts and listed followers occur at least this often; those seen once fail the test.
LEAST = 2
#: Bits of a hash that a sieve tells apart, and pieces in which it is put together.
SIEVE_BITS = 27
SIEVE_PARTS = 16
DISCOUNT = 0.5
BUCKET_TOKENS = 1_500_000
#: The same while texts are scored: every bucket sends each text one sum.
LOOK_UP_TOKENS = 6_000_000
#: Bits of the buckets of words, which are counted before the size of the corpus is known.
COUNT_BITS = 9
#: Texts that a task scores before it sends their rare runs on, if those do not fill it earlier.
HELD_TEXTS = 100_000
#: Runs that a task holds before it sums them up and packs them.
HELD_RUNS = 2_000_000
#: Bits of a frequent word's number; three words make up a run in one whole number.
NUMBER_BITS = 21
#: Beyond four words, runs are counted for so many sizes in one pass over the texts.
AHEAD = 4
END = np.uint64(0x3C6EF372FE94F82A)

#: Spark's setting to delete the files of a query's shuffles when it ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of whole numbers may go to Python in larger batches than texts.
_LARGE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "65536"}
#: While the tree grows, tables of which each key has one row are hashed and not sorted to be joined.
_GROWING = {_CLEAN: "true", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m"}
_STEP = np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def _settings(spark: SparkSession, own: dict[str, str]) -> Iterator[None]:
    """The session with these settings; afterwards with its former ones."""
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, tokens, where each text's begin) with an end after each text."""
    for part in words.words(column):
        tokens = np.insert(part.hashes, part.bounds[1:], END)
        yield part.first, tokens, part.bounds + np.arange(len(part.bounds))


def _count(keys_of):
    """Counts of the int64 keys that ``keys_of`` makes of tokens, summed up within each task, by bucket."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
        held.clear()
        rows = [
            (bucket, hi - lo, _squeezed_keys(keys[lo:hi]), _squeezed(n[lo:hi].astype(np.uint32)))
            for bucket, lo, hi in _buckets(keys, COUNT_BITS)
        ]
        return _batch(rows, _COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            for _, tokens, bounds in _tokens(batch.column(0)):
                held.append(keys_of(tokens, bounds))
                rows += len(held[-1])
                if rows > 2 * HELD_RUNS:
                    yield packed(held)
                    rows = 0
        if held:
            yield packed(held)

    return run


def _summed_counts(table: pa.Table) -> pa.Table:
    found = [
        (_unsqueezed_keys(r["keys"], r["rows"]), _unsqueezed(r["times"], r["rows"], np.uint32))
        for r in table.to_pylist()
    ]
    keys, times = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(keys)
    first = _firsts(keys[order])
    n = np.add.reduceat(times[order], first, dtype=np.int64)
    return pa.table([pa.array(keys[order[first]].view(np.int64)), pa.array(n)], ["key", "n"])


def _counts(texts: DataFrame, keys_of) -> DataFrame:
    made = texts.mapInArrow(_count(keys_of), _COUNTS)
    return made.groupBy("bucket").applyInArrow(_summed_counts, "key long, n long")


def _look_up(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each key in a sorted array, or -1."""
    if not len(known):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return np.where(known[at] == keys, at, -1)


def _run_hash(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The hash of runs by those of all but their last and all but their first word."""
    return words.mix(context * _STEP + suffix)


def _place(bounds: np.ndarray) -> np.ndarray:
    """How many tokens of its text stand before each token."""
    return np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))


def _longer(shorter: np.ndarray) -> np.ndarray:
    """The hashes of the runs that end with each token, from those of runs shorter by a word. Those
    that do not lie within one text mean nothing."""
    longer = np.zeros_like(shorter)
    longer[1:] = _run_hash(shorter[:-1], shorter[1:])
    return longer


def _in_sieve(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether hashes may be in the table that the sieve was made of."""
    place = keys >> np.uint64(64 - len(bits).bit_length() - 2)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _sieve(table: DataFrame, keys_of=lambda batch: batch.column(0).to_numpy().view(np.uint64)) -> np.ndarray:
    """A bit for the first ``SIEVE_BITS`` bits of each key that ``keys_of`` gives of a batch."""
    shift, size = np.uint64(64 - SIEVE_BITS), 1 << (SIEVE_BITS - 3)
    own = size // SIEVE_PARTS

    def mark(bits: np.ndarray, held: list[np.ndarray]) -> None:
        places = np.sort(np.concatenate(held))
        held.clear()
        byte = places >> np.uint32(3)
        first = _firsts(byte)
        marks = np.left_shift(1, places & np.uint32(7)).astype(np.uint8)
        bits[byte[first]] |= np.bitwise_or.reduceat(marks, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, rows = None, [], 0
        for batch in batches:
            if not len(keys := keys_of(batch)):
                continue
            bits = np.zeros(size, np.uint8) if bits is None else bits
            held.append((keys >> shift).astype(np.uint32))
            rows += len(keys)
            if rows > HELD_RUNS:
                mark(bits, held)
                rows = 0
        if held:
            mark(bits, held)
        if bits is not None:
            parts = [(k, _squeezed(bits[k * own : (k + 1) * own])) for k in range(SIEVE_PARTS)]
            yield _batch(parts, "part int, bits binary")

    def merged(table: pa.Table) -> pa.Table:
        bits = np.zeros(own, np.uint8)
        for x in table["bits"]:
            bits |= _unsqueezed(x.as_py(), own, np.uint8)
        return pa.table([table["part"][:1], pa.array([_squeezed(bits)], pa.binary())], ["part", "bits"])

    parts = table.mapInArrow(run, "part int, bits binary").groupBy("part")
    bits = np.zeros(size, np.uint8)
    with _settings(table.sparkSession, _LARGE):
        rows = parts.applyInArrow(merged, "part int, bits binary").collect()
    for r in rows:
        bits[r["part"] * own : (r["part"] + 1) * own] = _unsqueezed(bytes(r["bits"]), own, np.uint8)
    return bits


@dataclass
class Known:
    """Sorted hashes, and where those of each leading bits begin."""

    keys: np.ndarray
    first: np.ndarray
    most: int  # hashes with the same leading bits

    @classmethod
    def of(cls, keys: np.ndarray) -> Known:
        keys = np.sort(keys)
        bits = len(keys).bit_length() + 2
        starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        first = np.searchsorted(keys, starts).astype(np.int32)
        return cls(keys, first, int(np.diff(first, append=len(keys)).max()))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        bits = len(self.first).bit_length() - 1
        at = np.minimum(self.first[keys >> np.uint64(64 - bits)], len(self.keys) - 1).astype(np.int64)
        own = self.keys[at]
        out = np.where(own == keys, at, -1)
        left = np.flatnonzero(own < keys)
        for k in range(1, self.most):
            at_left = np.minimum(at[left] + k, len(self.keys) - 1)
            own = self.keys[at_left]
            found = own == keys[left]
            out[left[found]] = at_left[found]
            left = left[own < keys[left]]
        return out


@dataclass
class Shorter:
    """What tasks know of shorter runs while they count those of one length."""

    contexts: np.ndarray  # sieve of runs that may be the context, or hold it but for its first word
    suffixes: np.ndarray  # sieve of runs that may be what follows the first word


def _often(vocabulary: DataFrame, corpus: int) -> Known:
    """The most frequent words."""
    often = vocabulary.where(F.col("n") >= max(LEAST, corpus / MAX_WORDS))
    return Known.of(often.select("key").toArrow()["key"].to_numpy().view(np.uint64))


def _own_runs(
    tokens: np.ndarray, bounds: np.ndarray, size: int, known: Shorter
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, context, suffix) of the runs of ``size`` words of a slice of texts that may count.

    Up to three words, all shorter runs were counted: both within a run occur as often as it, so
    they must be in the sieves. For more, the context must be longer by a word than a kept one;
    runs that cannot be listed have suffix 0. Beyond four words, runs of ``AHEAD`` sizes are given
    that end so; which of the longer ones count is known when their parents are.
    """
    place = _place(bounds)
    at = np.flatnonzero(place >= size - 1)
    run = tokens
    for _ in range(size - 2 - (size > 3)):
        run = _longer(run)
    if size <= 3:
        at = at[_in_sieve(known.suffixes, run[at])]
        at = at[_in_sieve(known.contexts, run[at - 1])]
        return at, run[at - 1], run[at]
    at = at[_in_sieve(known.contexts, run[at - 1])]
    ahead = AHEAD if size > 4 else 1
    # The runs of size - 1 words that end at a place, a word before it and so on.
    ends = [_run_hash(run[np.maximum(at - k - 1, 0)], run[np.maximum(at - k, 0)]) for k in range(ahead + 1)]
    listed = _in_sieve(known.suffixes, ends[0])
    out = []
    for longer in range(size, size + ahead):
        some = np.flatnonzero(place[at] >= longer - 1)
        at, listed, ends = at[some], listed[some], [x[some] for x in ends]
        out.append((at, ends[1], np.where(listed, ends[0], np.uint64(0))))
        ends = [_run_hash(before, own) for own, before in pairwise(ends)]
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _numbered(numbers: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Runs of words as one whole number of their words' numbers, 0 if one of them has none."""
    run, every = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for k in range(size - 1, -1, -1):
        own = numbers[at - k]
        run = (run << NUMBER_BITS) | own
        every &= own > 0
    return np.where(every, run, 0)


def _named(runs: np.ndarray, often: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of context and suffix of numbered runs."""
    shift = [NUMBER_BITS * k for k in range(size - 1, -1, -1)]
    own = [often[((runs >> k) & ((1 << NUMBER_BITS) - 1)) - 1] for k in shift]
    return (own[0], own[1]) if size == 2 else (_run_hash(own[0], own[1]), _run_hash(own[1], own[2]))


def _key(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The hash of runs; with suffix 0 that of all occurrences of a context."""
    return np.where(suffix == 0, words.mix(context), _run_hash(context, suffix))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: first all their lowest bytes, then all the next ones."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, rows: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, rows * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, rows).T).view(kind).ravel()


def _squeezed_keys(ordered: np.ndarray) -> bytes:
    """Ascending whole numbers, by the steps between them."""
    return _squeezed(np.diff(ordered, prepend=ordered.dtype.type(0)))


def _unsqueezed_keys(data: bytes, rows: int, kind: type = np.uint64) -> np.ndarray:
    return np.cumsum(_unsqueezed(data, rows, kind), dtype=kind)


def _buckets(ordered: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the ascending hashes that begin with the same bits."""
    bucket = ordered >> np.uint64(64 - bits)
    first = _firsts(bucket).tolist()
    yield from zip(bucket[first].tolist(), first, [*first[1:], len(ordered)][: len(first)], strict=True)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """A batch of rows; columns at the end that they do not have are null."""
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = [pa.array(x, _KINDS[k]) for x, k in zip(zip(*rows, strict=True), kinds)]  # noqa: B905
    columns += [pa.nulls(len(rows), _KINDS[k]) for k in kinds[len(columns) :]]
    return pa.RecordBatch.from_arrays(columns, list(names))


_COUNTS = "bucket int, rows int, keys binary, times binary"


# Contexts are the steps between them. Numbered runs stand in their place and have no suffixes.
_RUNS = "bucket int, rows int, contexts binary, suffixes binary, times binary"


def _by_bucket(
    hashes: np.ndarray, bits: int, times: np.ndarray, contexts: np.ndarray, suffixes: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    bucket = hashes >> np.uint64(64 - bits)
    # By context too, but for its last bits, as the steps between ordered ones are short.
    by = bucket if suffixes is None else (bucket << np.uint64(64 - bits)) | (contexts >> np.uint64(bits))
    order = np.argsort(by, kind="stable")
    first = _firsts(bucket[order])
    times, contexts = times[order].astype(np.uint32), contexts[order]
    suffixes = None if suffixes is None else suffixes[order]
    rows = []
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        more = None if suffixes is None else _squeezed(suffixes[lo:hi])
        own = _squeezed_keys(contexts[lo:hi])
        rows.append((int(bucket[order[lo]]), hi - lo, own, more, _squeezed(times[lo:hi])))
    names = [x.split()[0] for x in _RUNS.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    for lo in range(0, len(rows), 256):
        own = zip(*rows[lo : lo + 256], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(own, kinds, strict=True)], names)


def _packed_runs(size: int, shared, often, bits: int):
    """The runs of ``size`` words that ``_own_runs`` gives, summed up within each task, by bucket.
    Beyond three words, also all occurrences of each context, with suffix 0."""

    def packed(numbers: list[np.ndarray], found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        runs = np.sort(np.concatenate(numbers)) if numbers else np.zeros(0, np.int64)
        if len(runs):
            first = _firsts(runs)
            times, runs = np.diff(first, append=len(runs)), runs[first]
            yield from _by_bucket(words.mix(runs.view(np.uint64)), bits, times, runs, None)
        numbers.clear()
        keys, context, suffix = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        if len(keys):
            order = np.argsort(keys)
            first = _firsts(keys[order])
            times, order = np.diff(first, append=len(order)), order[first]
            yield from _by_bucket(keys[order], bits, times, context[order], suffix[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Shorter = shared.value
        frequent: Known = often.value
        numbers: list[np.ndarray] = []
        found: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            for _, tokens, bounds in _tokens(batch.column(0)):
                at, context, suffix = _own_runs(tokens, bounds, size, known)
                if size <= 3:
                    whole = _numbered(frequent.places(tokens) + 1, at, size)
                    numbers.append(whole[whole > 0])
                    listed = whole == 0
                else:
                    found.append((words.mix(context), context, np.zeros_like(context)))
                    listed = suffix > 0
                    rows += int(listed.sum())
                context, suffix = context[listed], suffix[listed]
                found.append((_run_hash(context, suffix), context, suffix))
                rows += len(at)
                if rows > HELD_RUNS:
                    yield from packed(numbers, found)
                    rows = 0
        if found:
            yield from packed(numbers, found)

    return run


def _count_runs(texts: DataFrame, size: int, shared, often, bits: int) -> DataFrame:
    """(key, context, suffix, n) of the runs of ``_packed_runs`` that occur ``LEAST`` times."""

    def summed(table: pa.Table) -> pa.Table:
        numbers, others = [], []
        for r in table.to_pylist():
            times = _unsqueezed(r["times"], r["rows"], np.uint32)
            if r["suffixes"] is None:
                numbers.append((_unsqueezed_keys(r["contexts"], r["rows"], np.int64), times))
            else:
                context, suffix = _unsqueezed_keys(r["contexts"], r["rows"]), _unsqueezed(r["suffixes"], r["rows"], np.uint64)
                others.append((context, suffix, times))
        out = []
        if numbers:
            runs, times = map(np.concatenate, zip(*numbers, strict=True))
            order = np.argsort(runs)
            first = _firsts(runs[order])
            n = np.add.reduceat(times[order], first, dtype=np.int64)
            runs, n = runs[order[first[n >= LEAST]]], n[n >= LEAST]
            out.append((*_named(runs, often.value.keys, size), n))
        if others:
            context, suffix, times = map(np.concatenate, zip(*others, strict=True))
            keys = _key(context, suffix)
            order = np.argsort(keys)
            first = _firsts(keys[order])
            n = np.add.reduceat(times[order], first, dtype=np.int64)
            own, n = order[first[n >= LEAST]], n[n >= LEAST]
            out.append((context[own], suffix[own], n))
        context, suffix, n = map(np.concatenate, zip(*out, strict=True))
        arrays = [pa.array(x.view(np.int64)) for x in (_key(context, suffix), context, suffix)]
        return pa.table([*arrays, pa.array(n)], ["key", "context", "suffix", "n"])

    made = texts.mapInArrow(_packed_runs(size, shared, often, bits), _RUNS)
    return made.groupBy("bucket").applyInArrow(summed, "key long, context long, suffix long, n long")


def _level(
    counted: DataFrame, totals: DataFrame, shorter: DataFrame, corpus: int, every: bool
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the contexts of counted runs, (context, total) given in ``totals``.

    Gives the runs, (key, n, log, value, open), where ``log`` is the log10 probability of the last
    word after the others and ``value`` is what the run adds to it, null where its context is not
    kept or does not list it; and the kept nodes, (context, total, rest, open). A kept context with
    more than one follower is open, and so are its runs that could repay a place below it. Runs that
    are neither open nor listed are given only if ``every`` run is needed.
    """
    parents = shorter.where("open").select(F.col("key").alias("suffix"), F.col("log").alias("parent"))
    rows = scratch.materialise(
        counted.join(parents, "suffix")
        .join(totals, "context")
        .select("key", "context", "n", "total", "parent")
    )
    share, parent = (F.col("n") - DISCOUNT) / F.col("total"), F.col("parent")
    between = lambda x: F.least(F.greatest(x, F.lit(1e-9)), F.lit(1.0))
    # Rounded, so that the order of the sums does not show; ``round`` goes by way of decimals.
    rounded = lambda x, to: F.rint(x * 10.0**to) / 10.0**to
    cost = 0.5 * float(np.log10(max(corpus, 10)))
    pays = (F.col("n") - DISCOUNT) * (F.log10(share) - parent) > cost
    nodes = (
        rows.where(pays)
        .groupBy("context")
        .agg(
            F.max("total").alias("total"),
            F.max("n").alias("most"),
            F.count("*").alias("listed"),
            between(rounded(1 - F.sum(share), 12)).alias("left"),
            between(rounded(1 - F.sum(F.pow(F.lit(10.0), parent)), 12)).alias("over"),
            F.sum(share * (F.log10(share) - parent)).alias("gain"),
        )
        .withColumn("rest", rounded(F.log10(F.col("left") / F.col("over")), 9))
        .withColumn("gain", rounded(F.col("gain") + F.col("left") * F.col("rest"), 9))
    )
    several = (F.col("most") < F.col("total")).alias("open")
    nodes = scratch.materialise(
        nodes.where(F.col("total") * F.col("gain") > cost * F.col("listed")).select(
            "context", "total", "rest", several
        )
    )
    rest = F.coalesce("rest", F.lit(0.0))
    listed = F.col("rest").isNotNull() & pays
    log = F.when(listed, F.log10(share)).otherwise(parent + rest)
    found = rows.join(nodes.drop("total"), "context", "left").select(
        "key",
        "n",
        log.alias("log"),
        F.when(listed, log - parent - rest).alias("value"),
        (F.coalesce("open", F.lit(False)) & ((F.col("n") - DISCOUNT) * -log > cost)).alias("open"),
    )
    found = scratch.materialise(found if every else found.where("open or value is not null"))
    scratch.discard(rows)
    return found, nodes


def _grow(
    texts: DataFrame, vocabulary: DataFrame, corpus: int, base: float, bits: int
) -> tuple[DataFrame, int, int]:
    """The tree of ``_packed_tree``: the count of words, how often a run occurs, and what it adds to
    the scores of the root as a follower or, in a row of its own, as a context; how many words the
    longest runs have; and the bits of the buckets that the tree is in."""
    send = texts.sparkSession.sparkContext.broadcast
    row = lambda t, key, n, often, v: t.select(
        F.col(key).alias("key"), n.cast("long").alias("n"), often.alias("often"), v.alias("value")
    )
    none = F.lit(0)
    stored = [vocabulary]
    values = row(vocabulary, "key", F.col("n"), F.col("n"), F.lit(0.0))
    often = send(_often(vocabulary, corpus))
    shorter = vocabulary.where(F.col("n") >= LEAST).withColumn("log", F.log10(F.col("n") + 1) - base)
    shorter = shorter.withColumn("open", F.lit(True))
    nodes, longest, size, passes = None, 1, 2, []
    while True:
        if size <= 5 or (size - 5) % AHEAD == 0:
            contexts = shorter if size <= 3 else nodes.where("open").select(F.col("context").alias("key"))
            suffixes = _sieve(shorter.where("open").select("key"))
            # All words are open.
            shared = send(Shorter(suffixes if size == 2 else _sieve(contexts.select("key")), suffixes))
            counted = _count_runs(texts, size, shared, often, bits)
            if size > 3:
                counted = scratch.materialise(counted)
                shared.destroy()
                scratch.discard(*passes)
                passes = [counted]
        if size <= 3:
            totals = shorter.select(F.col("key").alias("context"), F.col("n").alias("total"))
        else:
            totals = counted.where("suffix = 0").select("context", F.col("n").alias("total"))
        # Of runs counted ahead, those have a parent whose turn it is.
        # All runs of two words may be contexts of the next size, with their totals.
        shorter, nodes = _level(counted.where("suffix <> 0"), totals, shorter, corpus, size == 2)
        if size <= 3:
            shared.destroy()
        stored += [shorter, nodes]
        if nodes.isEmpty():
            break
        longest = size
        kept = row(shorter.where("value is not null"), "key", none, F.col("n"), F.col("value"))
        context = row(nodes, "context", none, F.col("total"), F.col("rest"))
        values = values.union(kept).union(context)
        if nodes.where("open").isEmpty():
            break
        size += 1
    often.destroy()
    look_up = max(3, (corpus // LOOK_UP_TOKENS).bit_length())
    with _settings(texts.sparkSession, _LARGE):
        packed = _packed_tree(max(LEAST, corpus / MAX_WORDS), look_up)
        tree = scratch.materialise(values.mapInArrow(packed, _TREE))
    scratch.discard(*stored, *passes)
    return tree, longest, look_up


# Words have times and no values, longer runs values and no times; bucket -1 repeats the most frequent.
_TREE = "bucket int, rows int, keys binary, times binary, added binary"


def _packed_tree(least: float, bits: int):
    """(key, n, often, value) to the words and runs of each bucket, and again those that occur often."""

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, n, often, value = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        keys, rows = keys.view(np.uint64), []
        for some in (n > 0, n == 0):
            order = np.flatnonzero(some)
            order = order[np.argsort(keys[order])]
            hot = order[often[order] >= least]
            found = [(bucket, order[lo:hi]) for bucket, lo, hi in _buckets(keys[order], bits)]
            for bucket, own in [*found, (-1, hot)]:
                if len(own):
                    times = _squeezed(n[own].astype(np.uint64)) if n[own[0]] else None
                    added = None if n[own[0]] else _squeezed(value[own])
                    rows.append((bucket, len(own), _squeezed_keys(keys[own]), times, added))
        return _batch(rows, _TREE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            rows += len(batch)
            if rows > HELD_RUNS:
                yield packed(held)
                rows = 0
        if rows:
            yield packed(held)

    return run


def _tree_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, and the count and value of each, of packed rows of the tree."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0))]
    for r in table.to_pylist():
        rows = r["rows"]
        n = np.zeros(rows, np.uint64) if r["times"] is None else _unsqueezed(r["times"], rows, np.uint64)
        value = np.zeros(rows) if r["added"] is None else _unsqueezed(r["added"], rows, np.float64)
        found.append((_unsqueezed_keys(r["keys"], rows), n, value))
    keys, n, value = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(keys)
    # A run has one row as a follower and one as a context at most, so the sum has no order.
    first = _firsts(keys[order]) if len(keys) else order
    return keys[order[first]], *(np.add.reduceat(x[order], first) if len(keys) else x for x in (n, value))


def _keys_of_runs(batch: pa.RecordBatch) -> np.ndarray:
    keys = [_unsqueezed_keys(r["keys"], r["rows"]) for r in batch.to_pylist()]
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


@dataclass
class Hot:
    """The most frequent runs, and the sieve of kept contexts and of what they list."""

    keys: Known
    logs: np.ndarray  # log10(count + 1) of words, 0 for longer runs; a 0 more, as in ``values``
    values: np.ndarray
    bits: np.ndarray
    size: float  # log10(N + V + 1)
    longest: int


def _hot(tree: DataFrame, size: float, longest: int) -> Hot:
    # A run occurs as often as a follower as it does as a context, so both its rows are there.
    keys, n, values = _tree_rows(tree.where("bucket = -1").toArrow())
    runs = tree.where("bucket >= 0 and times is null").select("rows", "keys")
    return Hot(
        Known.of(keys),
        np.append(np.log10(n + 1.0), 0.0),
        np.append(values, 0.0),
        _sieve(runs, _keys_of_runs),
        size,
        longest,
    )


_TEXT = "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double"
_ROW = [x.split()[0] for x in _TEXT.split(", ")]
_DEALT = "bucket int, lot long, rows int, keys binary, texts binary, " + _TEXT


def _deal(shared, bits: int):
    """(id, held_out, text) to one row for each text, and for each lot of texts packed rare runs
    for each bucket. Places of texts are those within their lot."""
    names = [x.split()[0] for x in _DEALT.split(", ")]

    def packed(lot: int, rare: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        own, keys = map(np.concatenate, zip(*rare, strict=True))
        rare.clear()
        order = np.argsort(keys, kind="stable")
        keys, own = keys[order], own[order]
        rows = [
            (bucket, lot, hi - lo, _squeezed_keys(keys[lo:hi]), _squeezed(own[lo:hi]))
            for bucket, lo, hi in _buckets(keys, bits)
        ]
        return _batch(rows, _DEALT) if rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot: Hot = shared.value
        lot = TaskContext.get().partitionId() << 40
        rare: list[tuple[np.ndarray, np.ndarray]] = []
        seen = runs = 0
        for batch in batches:
            for first, tokens, bounds in _tokens(batch.column(2)):
                texts = len(bounds) - 1
                row = seen + np.arange(texts)
                size = np.diff(bounds)
                own = np.repeat(np.arange(texts), size)
                at = hot.keys.places(tokens)
                found = at >= 0
                # Place -1 holds what runs that are not there add.
                known = np.bincount(own, found, texts).astype(np.int64)
                plain = np.bincount(own, hot.logs[at], texts) - size * hot.size
                score = plain + np.bincount(own, hot.values[at], texts)
                rare.append(((seen + own[~found]).astype(np.uint32), tokens[~found]))
                # Only contexts list, and without its first word a context is one too.
                place, run = _place(bounds), tokens
                node = _in_sieve(hot.bits, tokens)
                for longer in range(2, hot.longest + 1):
                    node[1:] |= node[:-1]
                    ends = np.flatnonzero(node & (place >= longer - 1))
                    if not len(ends):
                        break
                    run = _longer(run)
                    ends = ends[_in_sieve(hot.bits, run[ends])]
                    node = np.zeros(len(tokens), bool)
                    node[ends] = True
                    ends, keys = own[ends], run[ends]
                    at = hot.keys.places(keys)
                    found = at >= 0
                    score += np.bincount(ends[found], hot.values[at[found]], texts)
                    rare.append(((seen + ends[~found]).astype(np.uint32), keys[~found]))
                    runs += len(rare[-1][0])
                runs += len(tokens)
                home = np.full(texts, _home(lot, bits), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(home),
                        pa.array(np.full(texts, lot, np.int64)),
                        pa.nulls(texts, pa.int32()),
                        *[pa.nulls(texts, pa.binary())] * 2,
                        pa.array(row),
                        *(c.slice(first, texts) for c in batch.columns[:2]),
                        *(pa.array(x) for x in (size, known, plain, score)),
                    ],
                    names,
                )
                seen += texts
                if runs > HELD_RUNS or seen > HELD_TEXTS:
                    if (sent := packed(lot, rare)) is not None:
                        yield sent
                    lot, seen, runs = lot + 1, 0, 0
        if rare and (sent := packed(lot, rare)) is not None:
            yield sent

    return run


def _home(lot: int, bits: int) -> int:
    """The bucket in which the rows of a lot's texts pass the join."""
    return int(words.mix(np.array([lot], np.uint64))[0] >> np.uint64(64 - bits))


_PARTS = "lot long, rows int, texts binary, known binary, logs binary, added binary, " + _TEXT


def _join_counts(dealt: pa.Table, tree: pa.Table) -> pa.Table:
    """Look a bucket's words and longer runs up. What they add to each text goes on packed by lot,
    in which a text's own row already is."""
    packed = dealt["keys"].is_valid()
    own = dealt.filter(pa.compute.invert(packed))
    nulls = {c: pa.nulls(len(own), pa.binary()) for c in ("texts", "known", "logs", "added")}
    out = pa.table({"lot": own["lot"], "rows": own["rows"], **nulls, **{c: own[c] for c in _ROW}})
    keys, counted, added = _tree_rows(tree)
    logs = np.log10(counted + 1.0)
    rows = []
    for r in dealt.filter(packed).select(["lot", "rows", "keys", "texts"]).to_pylist():
        at = _look_up(_unsqueezed_keys(r["keys"], r["rows"]), keys)
        found = at >= 0
        at, texts = at[found], _unsqueezed(r["texts"], r["rows"], np.uint32)[found]
        if len(at):
            some = np.flatnonzero(np.bincount(texts)).astype(np.uint32)
            sums = [np.bincount(texts, x)[some] for x in (counted[at] > 0, logs[at], added[at])]
            sums[0] = sums[0].astype(np.uint32)
            rows.append((r["lot"], len(some), _squeezed_keys(some), *map(_squeezed, sums)))
    if not rows:
        return out
    return pa.concat_tables([out, pa.Table.from_batches([_batch(rows, _PARTS)]).cast(out.schema)])


def _whole(table: pa.Table) -> pa.Table:
    """The rows of a lot's texts with what their words add."""
    packed = table["texts"].is_valid()
    own = table.filter(pa.compute.invert(packed)).select(_ROW).sort_by("row")
    found = [
        (
            _unsqueezed_keys(r["texts"], r["rows"], np.uint32),
            *(_unsqueezed(r[c], r["rows"], k) for c, k in (("known", np.uint32), ("logs", float), ("added", float))),
        )
        for r in table.filter(packed).to_pylist()
    ]
    if not found:
        return own
    texts, known, logs, values = map(np.concatenate, zip(*found, strict=True))
    # Summed in the order of size, so that the result does not depend on how buckets arrive.
    order = np.lexsort((values, logs, texts))
    at = np.searchsorted(own["row"].to_numpy(), texts[order])
    known = np.bincount(at, known[order], len(own)).astype(np.int64)
    logs = np.bincount(at, logs[order], len(own))
    values = np.bincount(at, values[order], len(own))
    changed = {
        "n_known": own["n_known"].to_numpy() + known,
        "base": own["base"].to_numpy() + logs,
        "score": own["score"].to_numpy() + logs + values,
    }
    return pa.table({c: changed.get(c, own[c]) for c in _ROW})


def score(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Rows for which ``held_out`` is true are not learned from. Scores are log10 probabilities.
    """
    spark = docs.sparkSession
    docs = words.in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    texts = rows.where(~F.col("held_out")).select("text")
    # The tables of the tree are written level by level; what was shuffled for one is not kept.
    with _settings(spark, _GROWING):
        vocabulary = scratch.materialise(_counts(texts, lambda t, b: t.view(np.int64)))
        corpus, distinct = vocabulary.agg(F.sum("n"), F.count("*")).first()
        corpus = corpus or 0
        size = float(np.log10(corpus + distinct + 1))
        bits = max(3, (int(corpus) // BUCKET_TOKENS).bit_length())
        tree, longest, look_up = _grow(texts, vocabulary, corpus, size, bits)
        shared = spark.sparkContext.broadcast(_hot(tree, size, longest))

    dealt = rows.mapInArrow(_deal(shared, look_up), _DEALT)
    parts = (
        dealt.groupBy("bucket")
        .cogroup(tree.where("bucket >= 0").groupBy("bucket"))
        .applyInArrow(_join_counts, _PARTS)
    )
    whole = parts.groupBy("lot").applyInArrow(_whole, _TEXT)
    return whole.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
