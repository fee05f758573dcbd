"""Operator 12, a trie of conversation prefixes with subtree totals by tree contraction.

The turns of a conversation follow one another by turn, null first, then by role and by the SHA-256
of the text. A node is a distinct sequence of first turns. It is known by a 128-bit sum, over its
turns, of hashes of place, role and text, so the nodes of all prefixes come from running sums.
Subtree totals come from ``contraction.subtree_totals``.

No step holds a conversation or a node's members in one task: turns are numbered within sorted
ranges of all turns, sums run over segments of a conversation, and a node's members are counted in
the map tasks first. A node's member ids are joined to texts range by range; only their hash,
which can't be split, passes over a node's texts one after another.

A null role or text is empty. Rows without a conversation id belong to no conversation and are not
counted. Repeated rows are turns of their own. Columns of other names are not read. An empty
table has no conversation and gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm.contraction import subtree_totals

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation whose sums run in one task.
SEGMENT = 10_000
#: Conversations that share the first turns of one of them, and how many turns at most are shared.
FAMILY, SHARED = 20, 3
_INDEX_BITS = 33  # of monotonically_increasing_id, below the number of the partition
_LOW = 0xFFFFFFFF


def numbered_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, pos, n_turns, content, words), with places from 1 on, as a stored table.

    The turns are sorted in ranges, and a range's part of a conversation begins where the parts of
    the ranges before it end.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        # Parts rows that are equal, which a range can't.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = scratch.materialise(rows).repartitionByRange(n, *order).sortWithinPartitions(*order)
    content = F.sha2(F.concat(F.sha2(F.col("role").cast("binary"), 256), "digest").cast("binary"), 256)
    ordered = scratch.materialise(
        ordered.select("conv", content.alias("content"), "words", F.monotonically_increasing_id().alias("at"))
    )
    part = F.call_function("shiftright", F.col("at"), F.lit(_INDEX_BITS)).alias("part")
    ordered = ordered.select("*", part)
    parts = ordered.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("conv")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv",
        "part",
        (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0)) - 1).alias("base"),
        F.sum("n").over(whole).alias("n_turns"),
    )
    placed = ordered.join(parts, ["conv", "part"])
    return scratch.materialise(placed.select("conv", (F.col("at") - F.col("base")).alias("pos"), "n_turns", "content", "words"))


def shared_turns(conv: Column) -> Column:
    """How many turns of a conversation come from the first of its family."""
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(SHARED + 1))


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first one of their family.

    (conv, depth, content, words, is_last) of all turns, and (conv, length) of all conversations.
    """
    conv = F.col("conv")
    own = numbered.where("pos = 1").select("conv", "n_turns", shared_turns(conv).alias("h"), (conv - conv % FAMILY).alias("base"))
    bases = own.where(conv == F.col("base")).select("base", F.col("n_turns").alias("n_base"))
    own = own.join(bases, "base", "left").select(
        "conv", "base", "n_turns", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")
    )
    length = (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).cast("long").alias("length")
    own = scratch.materialise(own.select("*", length))
    heads = numbered.where((F.col("pos") <= SHARED) & (conv % FAMILY == 0)).select(
        F.col("conv").alias("base"), F.col("pos").alias("depth"), "content", "words"
    )
    first = own.where("taken > 0").join(heads, "base").where("depth <= taken")
    # Only the shift of a conversation is joined to its turns, by conversation and thousand of turns.
    lot = F.floor(F.col("pos") / 1000).alias("lot")
    shifts = own.where("n_turns > h").select(
        "conv", "h", "taken", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_turns") / 1000))).alias("lot")
    )
    rest = numbered.where(F.col("pos") > shared_turns(conv)).select("*", lot).join(shifts, ["conv", "lot"])
    rest = rest.withColumn("depth", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv", "depth", "content", "words", (F.col("depth") == F.col("length")).alias("is_last")]
    return first.select(*columns).union(rest.select(*columns)), own.select("conv", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (conv, depth, content, words, is_last) with the node (a, b) of the prefix that ends there, and
    its parent (pa, pb); the root is (0, 0). A stored table."""
    lanes = [F.xxhash64("content", "depth", F.lit(salt)) for salt in (1, 2)]
    halves = [h for x in lanes for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(_LOW)))]
    cells = [f"h{k}" for k in range(4)]
    rows = turns.select("*", F.floor(F.col("depth") / SEGMENT).alias("segment"), *(h.alias(c) for h, c in zip(halves, cells, strict=True)))
    rows = scratch.materialise(rows)
    earlier = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv", "segment").agg(*(F.sum(c).alias(c) for c in cells))
    bases = totals.select("conv", "segment", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"s{c}") for c in cells))
    running = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.select("*", *(F.sum(c).over(running).alias(f"r{c}") for c in cells)).join(bases, ["conv", "segment"])

    def joined(high: Column, low: Column) -> Column:
        return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))

    upto = [F.col(f"s{c}") + F.col(f"r{c}") for c in cells]
    before = [s - F.col(c) for s, c in zip(upto, cells, strict=True)]
    return scratch.materialise(
        sums.select(
            "conv", "depth", "words", "is_last",
            joined(*upto[:2]).alias("a"), joined(*upto[2:]).alias("b"),
            joined(*before[:2]).alias("pa"), joined(*before[2:]).alias("pb"),
        )
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow one another in a batch, as a text."""
    for batch in batches:
        keys = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True))
        ids = batch.column("conv").to_pylist()
        cuts = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]] + [len(keys)]
        rows = [(*keys[f], ids[f], ",".join(map(str, ids[f:t]))) for f, t in zip(cuts, cuts[1:], strict=False)]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["a", "b", "first", "ids"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's texts joined by commas; texts of one node follow one another."""
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if (a, b) == key:
                state.update(b",")
            else:
                if state:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield _hash_rows(done)
    if state:
        yield _hash_rows([(*key, state.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, sha = (list(c) for c in zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha)], ["a", "b", "ends_sha256"])


def member_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from (a, b, conv): the hash of each node's ids, ascending."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ends.select("a", "b", "conv").repartitionByRange(n, "a", "b", "conv").sortWithinPartitions("a", "b", "conv")
    texts = ranges.mapInArrow(_texts, "a long, b long, first long, ids string")
    return (
        texts.repartition("a", "b")
        .sortWithinPartitions("a", "b", "first")
        .mapInArrow(_hashes, "a long, b long, ends_sha256 string")
    )


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node from the results of ``rebuilt``: smallest member, depth, the parent's, members,
    children, leaves below, words that sharing the prefix saves below, hash of the members that end here."""
    rows = prefixes(turns)
    nodes = rows.groupBy("a", "b").agg(
        F.min("conv").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        # Equal for all members.
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
        F.min("words").alias("words"),
    )
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("a"), zero.alias("b"), "conv_id", zero.alias("depth"), "n_convs", none.alias("pa"), none.alias("pb"), zero.alias("words")
    )
    nodes = scratch.materialise(nodes.select(*root.columns).union(root))
    children = nodes.where("pa is not null").groupBy("pa", "pb").agg(F.count("*").alias("n_children")).toDF("a", "b", "n_children")
    nodes = scratch.materialise(nodes.join(children, ["a", "b"], "left").fillna(0, ["n_children"]))
    values = nodes.select(
        "a", "b", "pa", "pb",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = subtree_totals(values, ("a", "b"), ("pa", "pb"), ("n_leaves", "saved_tokens"))
    ends = rows.where("is_last").select("a", "b", "conv").union(
        lengths.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv")
    )
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, ["pa", "pb"], "left")
        .join(totals, ["a", "b"])
        .join(member_hashes(ends), ["a", "b"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
