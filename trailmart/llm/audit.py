"""Operator 11, how filters on texts act together: in every order, what each one removes.

Texts go through a byte transducer of two states, in a word and between words. Its table says for
each state and class of byte what is counted and where words begin and end. Every class leads to
one state whatever the state before, so the states of all bytes are looked up at once and a text
is passed once. Word spans enter a hash table by document and hash; a span counts as known only
if its bytes equal those of the span that holds the place.

Filters fail a document on its own counts (A to D) or if an equal text has a smaller id (E).
Documents are counted by part and set of failed filters, at most 32 rows a part, and all orders
are computed from these counts.

A null text is an empty one and fails A only, unless it is repeated; a null part is the empty
string. A document without an id fails E never and makes no other fail. Rows with equal id and text are
no copies of one another, yet each is counted. A document is good or toxic if any of its labels
says so; labels without a document count nowhere. Columns of other names are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmart import scratch
from trailmart.llm.words import _power_tables, mix, slices, text_buffers

FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "#$%&*|"

# Classes of bytes.
GAP, PLAIN, CAPITAL, SYMBOL, FOLLOWING = range(5)
CLASS = np.full(256, PLAIN, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = GAP
CLASS[ord("A") : ord("Z") + 1] = CAPITAL
CLASS[[ord(c) for c in SYMBOLS]] = SYMBOL
CLASS[0x80:0xC0] = FOLLOWING  # within a character of UTF-8

# States, and what a transition puts out.
BETWEEN, INSIDE = range(2)
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_POINT = (1 << k for k in range(5))
_PUT = {GAP: IS_POINT, PLAIN: IS_POINT, CAPITAL: IS_POINT | IS_CAPITAL, SYMBOL: IS_POINT | IS_SYMBOL, FOLLOWING: 0}
#: The state after a byte of each class, from either state.
AFTER = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
#: What is put out, by state and class.
OUTPUT = np.array(
    [
        [_PUT[c] | (BEGINS if s == BETWEEN and AFTER[c] == INSIDE else 0) | (ENDS if s == INSIDE and AFTER[c] == BETWEEN else 0) for c in _PUT]
        for s in (BETWEEN, INSIDE)
    ],
    np.uint8,
)

COUNTS = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes from ``a`` and from ``b`` on are equal; ``data`` goes on for 8 bytes."""
    word = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    same = ((word[a] ^ word[b]) & _KEEP[np.minimum(size, 8)]) == 0
    long = np.flatnonzero(same & (size > 8))
    if len(long):
        rest = size[long] - 8
        ends = np.cumsum(rest)
        step = np.arange(ends[-1]) - np.repeat(ends - rest, rest) + 8
        unlike = data[np.repeat(a[long], rest) + step] != data[np.repeat(b[long], rest) + step]
        same[long] = np.add.reduceat(unlike, ends - rest, dtype=np.int64) == 0
    return same


def first_spans(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, owner: np.ndarray
) -> np.ndarray:
    """Whether each span is the one that its owner's equal spans are known by.

    A hash table with open places: spans of equal owner, hash and bytes ask for the same places in
    the same rounds, so one of them takes a place and the others find it there.
    """
    n = len(starts)
    places = 1 << max(4, (2 * n).bit_length())
    last = places - 1
    holder = np.full(places, -1, np.int64)
    at = (mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(last)).astype(np.int64)
    first, todo = np.zeros(n, bool), np.arange(n)
    while len(todo):
        here = at[todo]
        free = holder[here] < 0
        holder[here[free]] = todo[free]
        held = holder[here]
        won = held == todo
        first[todo[won]] = True
        todo, held = todo[~won], held[~won]
        known = (hashes[todo] == hashes[held]) & (owner[todo] == owner[held]) & (sizes[todo] == sizes[held])
        asked = np.flatnonzero(known)
        known[asked] = _equal(data, starts[todo[asked]], starts[held[asked]], sizes[todo[asked]])
        todo = todo[~known]
        at[todo] = (at[todo] + 1) & last
    return first


def transduce(texts: pa.Array) -> np.ndarray:
    """The counts of ``COUNTS`` for every text, one row each."""
    # A blank after each text ends its last word, so every text begins between words.
    closed = pc.binary_join_element_wise(texts.fill_null(""), pa.scalar("", texts.type), pa.scalar(" ", texts.type))
    data, offsets = text_buffers(closed)
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for lo, hi in slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        begins = offsets[lo:hi] - offsets[lo]
        classes = CLASS[part]
        states = np.empty(len(part), np.uint8)
        states[0], states[1:] = BETWEEN, AFTER[classes[:-1]]
        put = OUTPUT[states, classes]
        for column, flag in ((2, IS_CAPITAL), (3, IS_SYMBOL), (4, IS_POINT)):
            out[lo:hi, column] = np.add.reduceat((put & flag) != 0, begins, dtype=np.int64)
        out[lo:hi, 4] -= 1
        starts, ends = np.flatnonzero(put & BEGINS), np.flatnonzero(put & ENDS)
        power, inverse = _power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * inverse[starts])
        owner = np.searchsorted(begins, starts, "right") - 1
        padded = np.append(part, np.zeros(8, np.uint8))
        first = first_spans(padded, starts, ends - starts, hashes, owner)
        out[lo:hi, 0] = np.bincount(owner, minlength=hi - lo)
        out[lo:hi, 1] = np.bincount(owner[first], minlength=hi - lo)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = transduce(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("kept"), *(pa.array(np.ascontiguousarray(c)) for c in counts.T)], ["kept", *COUNTS]
        )


def measure(docs: DataFrame, keep: Sequence[str | Column], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` in a struct ``kept``, and ``COUNTS`` of every text."""
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text_col).alias("text"))
    schema = StructType.fromDDL(", ".join(f"{c} long" for c in COUNTS))
    return rows.mapInArrow(_count, StructType([rows.schema["kept"], *schema]))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, failed) for every document; bit k of ``failed`` is filter k of ``FILTERS``."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    counted = measure(
        docs,
        [F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), digest.alias("digest")],
        text_col,
    )
    own = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"),
        100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    bits = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(own)), F.lit(0))
    # Written once, as the texts' first rows are looked up in it.
    rows = scratch.materialise(counted.select("kept.*", bits.cast("int").alias("own")))
    firsts = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    # Joined by id and digest, not by digest alone, so that no group of copies meets in one task.
    marked = rows.join(firsts.withColumn("is_first", F.lit(True)), ["digest", "id"], "left")
    copied = F.when(F.col("id").isNotNull() & F.col("is_first").isNull(), 1 << len(own)).otherwise(0)
    return marked.select("id", "part", (F.col("own") + copied).alias("failed"))


def combinations(
    failed: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", toxic_col: str = "toxic"
) -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and set of failed filters."""
    said = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col(good_col) == 1).cast("int")).alias("good"),
        F.max((F.col(toxic_col) == 1).cast("int")).alias("toxic"),
    )
    return (
        failed.join(said, "id", "left")
        .groupBy("part", "failed")
        .agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")))
    )


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the rows of ``combinations``.

    For each set of filters the documents are summed that pass all of it; every figure is a
    difference of such sums. The number of orders is that of all permutations.
    """
    sets = range(1 << len(filters))
    passes = lambda s: (F.col("failed").bitwiseAND(F.lit(s)) == 0)
    sums = {
        c: F.array(*(F.sum(F.when(passes(s), F.col(c)).otherwise(0)) for s in sets)).alias(c) for c in ("n", "good", "toxic")
    }
    left = counts.groupBy("part").agg(*sums.values())

    def removed(c: str, before: int, bit: int) -> Column:
        return F.col(c)[before] - F.col(c)[before | bit]

    k = len(filters)
    shares = []
    for f in range(k):
        others = [s for s in sets if not s >> f & 1]
        weights = [factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) for s in others]
        shares.append(sum(w * removed("n", s, 1 << f) for s, w in zip(others, weights, strict=True)))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(filters)))
    steps = (
        left.select("part", "n", "good", "toxic", F.array(*shares).alias("shares"), F.explode(orders).alias("filter_order"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
        .withColumn("which", F.transform(F.split("filter_order", ""), lambda c: F.instr(F.lit(filters), c) - 1))
        .withColumn("bits", F.transform("which", lambda w: F.call_function("shiftleft", F.lit(1), w)))
        .withColumn("before", F.aggregate(F.slice("bits", 1, F.col("step") - 1), F.lit(0), lambda a, b: a + b))
        .withColumn("bit", F.element_at("bits", F.col("step")))
    )
    whole = (1 << k) - 1
    before, after = F.col("before"), F.col("before") + F.col("bit")
    gone = lambda c: F.col(c)[before] - F.col(c)[after]
    fails = F.col("n")[0] - F.col("n")[F.col("bit")]
    return steps.select(
        "part",
        "filter_order",
        "step",
        F.col("n")[after].alias("kept"),
        gone("n").alias("removed"),
        (fails - gone("n")).alias("redundant"),
        (F.col("n")[F.lit(whole) - F.col("bit")] - F.col("n")[whole]).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        F.element_at("shares", F.element_at("which", F.col("step")) + 1).alias("shapley"),
    )
