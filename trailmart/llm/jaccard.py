"""Operator 4, n-gram Jaccard join by a token-group matrix.

Tokens are five-word shingles (``words``). Texts with the same set are one class. The join is
exact: every link of Jaccard similarity 3/4 or more between classes takes part in the components.

1. **Matrix of singletons.** Tokens go to buckets by hash. A bucket knows which of its tokens
   belong to two or more classes; the sum over the buckets bounds the overlap of a class with
   all others. A class whose shared tokens are under 3/4 of its set has no partner.
2. **Groups.** The rest is ordered by rarity: of each class, the rarest quarter of the set plus
   one token is kept (any two classes with a link share one of them). Classes that share such a
   token are compared with the token's most typical class; verified links form the groups.
3. **Token-group matrix.** Rows (rare token, group). A class meets only the groups that share a
   rare token with it and are not its own. Groups are cut to ``GROUP_ROWS`` members. The union
   of a group's tokens bounds the overlap with each of its members; a group whose union holds
   under 3/4 of the class is not opened. Opened groups are compared member by member.

Null and empty texts, and texts without words, have an empty set and no link. A text of one to
four words is one token. Rows with equal ids or equal rows keep their number; a null id takes
part, but a component is named by its smallest non-null id (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm import words
from trailmart.llm.components import connected_components

#: 100 * intersection >= 75 * union.
SHARE, WHOLE = 3, 4
GROUP_ROWS = 64
#: Text bytes to a bucket of tokens, and comparisons to a task's group.
BUCKET_BYTES = 8 << 20
COMPARISONS = 512
#: Tokens that a task sorts into buckets at a time.
DEAL_TOKENS = 750_000
#: Bits of the map of row keys: 8 MB.
KEY_BITS = 1 << 26

_U32 = np.uint64(0xFFFFFFFF)


def set_print(tokens: np.ndarray) -> int:
    """A 64-bit print of a set, the same for equal sets."""
    if not len(tokens):
        return 0
    total = words.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    total += np.array([len(tokens)], np.uint64)
    return int(words.mix(total).view(np.int64)[0])


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    data = np.ascontiguousarray(values)
    offsets = (np.asarray(bounds, np.int64) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def _dealt(prints: np.ndarray, sets: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Tokens of many sets by bucket: one row for each bucket, with packed arrays."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    bucket = (tokens >> np.uint64(64 - bits)).astype(np.uint32)
    order = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    low = ((tokens[order] >> np.uint64(32 - bits)) & _U32).astype(np.uint32)
    new_entry = np.ones(len(order), bool)
    new_entry[1:] = (owner[1:] != owner[:-1]) | (bucket[1:] != bucket[:-1])
    entry_at = np.flatnonzero(new_entry)
    entry_size = np.diff(np.append(entry_at, len(order))).astype(np.uint32)
    new_row = np.ones(len(entry_at), bool)
    new_row[1:] = bucket[entry_at[1:]] != bucket[entry_at[:-1]]
    row_at = np.flatnonzero(new_row)
    row_bounds = np.append(row_at, len(entry_at))
    token_bounds = np.append(entry_at[row_at], len(order))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[entry_at[row_at]].astype(np.int32)),
            _blobs(prints[owner[entry_at]], row_bounds),
            _blobs(entry_size, row_bounds),
            _blobs(low, token_bounds),
        ],
        ["bucket", "prints", "sizes", "tokens"],
    )


_DEALT = "bucket int, prints binary, sizes binary, tokens binary"


def _empty_dealt(rows: int) -> list[pa.Array]:
    return [pa.nulls(rows, t) for t in (pa.binary(), pa.binary(), pa.binary())]


def _deal_texts(bits: int):
    """(row_key, text) to bucket rows, and a row with the sets' sizes for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            prints = np.zeros(len(batch), np.int64)
            sizes = np.zeros(len(batch), np.int64)
            held: list[np.ndarray] = []
            places: list[int] = []
            waiting = 0
            for at, own in words.shingle_sets(batch.column(1)):
                prints[at], sizes[at] = set_print(own), len(own)
                held.append(own)
                places.append(at)
                waiting += len(own)
                if waiting >= DEAL_TOKENS:
                    yield _with_rows(_dealt(prints[places], held, bits))
                    held, places, waiting = [], [], 0
            if waiting:
                yield _with_rows(_dealt(prints[places], held, bits))
            # These rows are dealt to buckets of their own, past those of the tokens.
            spread = (prints.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((spread + (1 << bits)).astype(np.int32)),
                    *_empty_dealt(len(batch)),
                    keys,
                    pa.array(prints),
                    pa.array(sizes),
                ],
                ["bucket", "prints", "sizes", "tokens", "row_key", "print", "n"],
            )

    def _with_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, as_long = len(batch), pa.int64()
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.nulls(n, as_long) for _ in range(3))],
            ["bucket", "prints", "sizes", "tokens", "row_key", "print", "n"],
        )

    return run


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct classes of a bucket: prints, numbers of tokens, tokens."""
    prints = np.concatenate([np.frombuffer(x, np.int64) for x in table["prints"].to_pylist()])
    sizes = np.concatenate([np.frombuffer(x, np.uint32) for x in table["sizes"].to_pylist()])
    tokens = np.concatenate([np.frombuffer(x, np.uint32) for x in table["tokens"].to_pylist()])
    _, first = np.unique(prints, return_index=True)
    if len(first) < len(prints):
        keep = np.zeros(len(prints), bool)
        keep[first] = True
        tokens = tokens[np.repeat(keep, sizes)]
        prints, sizes = prints[keep], sizes[keep]
    return prints, sizes.astype(np.int64), tokens


def _classes_with(tokens: np.ndarray) -> np.ndarray:
    """For each token: in how many classes it is."""
    order = np.argsort(tokens)
    ranked = tokens[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    run = np.cumsum(fresh) - 1
    out = np.empty(len(tokens), np.int64)
    out[order] = np.bincount(run)[run]
    return out


def _shared(table: pa.Table) -> pa.Table:
    """Of each class, how many of a bucket's tokens other classes have; (class, size) as they are."""
    whole = table["tokens"].is_valid()
    plain = table.filter(pa.compute.invert(whole))
    out = [plain.select(["row_key", "print", "n"]).append_column("shared", pa.nulls(len(plain), pa.int64()))]
    table = table.filter(whole)
    if len(table):
        prints, sizes, tokens = _entries(table)
        many = (_classes_with(tokens) > 1).astype(np.int64)
        count = np.add.reduceat(many, np.cumsum(sizes) - sizes)
        some = count > 0
        nothing = pa.nulls(int(some.sum()), pa.int64())
        out.append(
            pa.table(
                {"row_key": nothing, "print": prints[some], "n": nothing, "shared": count[some]}
            )
        )
    return pa.concat_tables([t.cast(_SHARED) for t in out])


_SHARED = pa.schema([(c, pa.int64()) for c in ("row_key", "print", "n", "shared")])


def _sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(print, n, tokens) of the wanted classes, from rows (row_key, text).

    While the wanted rows are few, a bitmap of their keys goes to the tasks, so that other texts
    are not shuffled; its size is fixed. Beyond, the texts are joined by key.
    """
    few = wanted.count() <= KEY_BITS // 16
    if few:
        bit = F.pmod(F.col("row_key"), F.lit(KEY_BITS))
        maps = wanted.groupBy((bit / 32768).cast("int").alias("k")).agg(
            F.bitmap_construct_agg(bit % 32768).alias("bits")
        )
        known = np.zeros(KEY_BITS // 8, np.uint8)
        for row in maps.collect():
            own = np.frombuffer(row["bits"], np.uint8)
            known[row["k"] * 4096 : row["k"] * 4096 + len(own)] = own
        shared = rows.sparkSession.sparkContext.broadcast(known)
    else:
        rows = rows.join(wanted.select("row_key"), "row_key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if few:
                at = batch.column(0).to_numpy() % KEY_BITS
                hit = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                batch = batch.filter(pa.array(hit.astype(bool)))
            keys = batch.column(0).to_numpy()
            out = [
                (int(keys[at]), set_print(own), len(own), own.tobytes())
                for at, own in words.shingle_sets(batch.column(1))
            ]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)],
                ["row_key", "print", "n", "tokens"],
            )

    made = rows.mapInArrow(run, "row_key long, print long, n long, tokens binary")
    return made.join(wanted, ["row_key", "print"], "left_semi").select(
        "print", "n", "tokens"
    ).dropDuplicates(["print"])


def _deal_sets(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 1000):
                batch = whole.slice(lo, 1000)
                sets = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
                yield _dealt(batch.column(0).to_numpy(), sets, bits)

    return run


def _rarity(table: pa.Table) -> pa.Table:
    """(print, number of classes << 40 | token) of a bucket, packed by class."""
    prints, sizes, tokens = _entries(table)
    bucket = table["bucket"][0].as_py()
    known = np.minimum(_classes_with(tokens), (1 << 23) - 1).astype(np.uint64)
    # 23 bits of rarity and 41 of the token: enough to order by, as ties only cost candidates.
    mixed = (tokens.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32))) & np.uint64((1 << 41) - 1)
    return pa.table(
        {
            "print": prints,
            "ranks": _blobs((known << np.uint64(41)) | mixed, np.append(0, np.cumsum(sizes))),
        }
    )


def _rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed ranks, sorted by class, to the rare tokens of each class that can have a partner."""

    def close(name: int, parts: list[np.ndarray]):
        ranks = np.sort(np.concatenate(parts))
        n = len(ranks)
        alone = int(np.searchsorted(ranks, np.uint64(2 << 41)))
        shared = n - alone
        if WHOLE * shared >= SHARE * n:
            keep = ranks[alone : n - -(-SHARE * n // WHOLE) + 1]
            return name, n, alone, (keep & np.uint64((1 << 41) - 1)).astype(np.int64)
        return None

    def pack(rows):
        sizes = np.array([len(r[3]) for r in rows], np.int64)
        at = lambda k: np.repeat(np.array([r[k] for r in rows], np.int64), sizes)
        tokens = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, np.int64)
        rank = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = at(1) - at(2) - rank
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (tokens, at(0), at(1), left)], ["token", "print", "n", "left"]
        )

    name, parts, rows, waiting = None, [], [], 0
    for batch in batches:
        for own, ranks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != name and parts:
                if row := close(name, parts):
                    rows.append(row)
                    waiting += len(row[3])
                parts = []
            name = own
            parts.append(np.frombuffer(ranks, np.uint64))
        if waiting > 100_000:
            yield pack(rows)
            rows, waiting = [], 0
    if parts and (row := close(name, parts)):
        rows.append(row)
    yield pack(rows)


def _open_groups(members: pa.Table, queries: pa.Table) -> pa.Table:
    """Compare classes with the groups whose token union can hold enough of them.

    ``members`` (group, print, tokens), ``queries`` (group, print, tokens); gives links (a, b).
    """
    a: list[int] = []
    b: list[int] = []
    groups: dict[int, list[tuple[int, np.ndarray]]] = {}
    for group, name, tokens in zip(
        *(members[c].to_pylist() for c in ("group", "print", "tokens")), strict=True
    ):
        groups.setdefault(group, []).append((name, np.frombuffer(tokens, np.uint64)))
    unions = {g: np.unique(np.concatenate([t for _, t in m])) for g, m in groups.items()}
    for group, name, packed in zip(
        *(queries[c].to_pylist() for c in ("group", "print", "tokens")), strict=True
    ):
        own = np.frombuffer(packed, np.uint64)
        union = unions.get(group)
        if union is None or WHOLE * _overlap(own, union) < SHARE * len(own):
            continue
        for other, tokens in groups[group]:
            most = min(len(own), len(tokens))
            if WHOLE * most < SHARE * max(len(own), len(tokens)):
                continue
            both = _overlap(own, tokens)
            if WHOLE * both >= SHARE * (len(own) + len(tokens) - both):
                a.append(name)
                b.append(other)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many tokens two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _compare(sets: DataFrame, members: DataFrame, queries: DataFrame) -> DataFrame:
    """Links of ``queries`` (print, group) with the ``members`` (print, group) of those groups.

    Groups share a task's group by hash; the queries of a group are cut into blocks of about
    ``COMPARISONS``, to each of which its members are copied, so a group that very many classes
    ask for is spread over many tasks.
    """
    asked = queries.groupBy("group").agg(F.ceil(F.count("*") / COMPARISONS).alias("blocks"))
    asked = scratch.materialise(asked)
    total = asked.agg(F.sum("blocks"), F.count("*")).first()
    bins = max(1, -(-(total[1] or 0) // 64))
    bin_of = F.pmod(F.xxhash64("group"), F.lit(bins)).alias("bin")
    left = (
        members.join(asked, "group")
        .select("print", "group", bin_of, F.explode(F.sequence(F.lit(1), "blocks")).alias("block"))
        .join(sets.select("print", "tokens"), "print")
    )
    right = (
        queries.join(asked, "group")
        .select(
            "print", "group", bin_of, (F.pmod(F.xxhash64("print"), F.col("blocks")) + 1).alias("block")
        )
        .join(sets.select("print", "tokens"), "print")
    )
    # New names, as both sides come from the same tables.
    right = right.toDF("print", "group", "bin_", "block_", "tokens")
    return (
        left.groupBy("bin", "block")
        .cogroup(right.groupBy("bin_", "block_"))
        .applyInArrow(_open_groups, "a long, b long")
    )


def _enough(n: str, left: str, other_n: str, other_left: str) -> Column:
    """Whether two classes can be linked if this is the rarest token that they share.

    ``left`` counts the tokens of a class from this one on, so the smaller bounds the overlap,
    which has to be 3/7 of both sizes.
    """
    most = F.least(F.col(left), F.col(other_left))
    return (SHARE + WHOLE) * most >= SHARE * (F.col(n) + F.col(other_n))


def shingle_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row; see the module's text."""
    spark = docs.sparkSession
    docs = words.in_small_batches(docs).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, (size // BUCKET_BYTES).bit_length())
    row_key = F.xxhash64("id", "text").alias("row_key")

    # 1: tokens in buckets; what each class shares with any other.
    dealt = docs.select(row_key, "text").mapInArrow(
        _deal_texts(bits), f"{_DEALT}, row_key long, print long, n long"
    )
    counted = scratch.materialise(
        dealt.groupBy("bucket").applyInArrow(
            _shared, "row_key long, print long, n long, shared long"
        )
    )
    rows = counted.where("n is not null").select("row_key", "print", "n")
    classes = rows.groupBy("print").agg(F.min("row_key").alias("row_key"), F.first("n").alias("n"))
    shared = counted.where("shared is not null").groupBy("print").agg(F.sum("shared").alias("shared"))
    left = scratch.materialise(
        classes.join(shared, "print")
        .where(F.col("shared") * WHOLE >= F.col("n") * SHARE)
        .select("row_key", "print")
    )

    # 2: the sets of what is left, rarest tokens first.
    sets = scratch.materialise(_sets_of(docs.select(row_key, "text"), left))
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    bits = max(3, (tokens // 1_000_000).bit_length())
    ranks = (
        sets.mapInArrow(_deal_sets(bits), _DEALT)
        .groupBy("bucket")
        .applyInArrow(_rarity, "print long, ranks binary")
    )
    rare = scratch.materialise(
        ranks.repartition("print")
        .sortWithinPartitions("print")
        .mapInArrow(_rarest, "token long, print long, n long, left long")
    )
    typical = rare.groupBy("token").agg(
        F.max(F.struct(F.col("left") / F.col("n"), "n", "print", "left")).alias("hub"),
        F.count("*").alias("classes"),
    )
    typical = typical.where("classes > 1").select(
        "token", F.col("hub.print").alias("group"), F.col("hub.n").alias("hn"),
        F.col("hub.left").alias("hl"),
    )
    pairs = scratch.materialise(
        rare.join(typical, "token")
        .where(F.col("print") != F.col("group"))
        .where(_enough("n", "left", "hn", "hl"))
        .select("print", "group")
        .distinct()
    )
    hubs = pairs.select(F.col("group").alias("print"), "group").distinct()
    links = scratch.materialise(_compare(sets, hubs, pairs))
    grouped = connected_components(links)

    # 3: rare tokens against groups; only groups other than the class's own are met.
    member = scratch.materialise(
        rare.join(grouped.toDF("print", "component"), "print", "left").withColumn(
            "component", F.coalesce("component", "print")
        )
    )
    matrix = member.groupBy("token", "component").agg(
        F.max("left").alias("ml"), F.min("n").alias("mn")
    )
    crowded = matrix.groupBy("token").count().where("count > 1").select("token")
    matrix = matrix.join(crowded, "token", "left_semi").withColumnRenamed("component", "other")
    # Of two groups, the members of the one with the smaller name ask for the other.
    meets = scratch.materialise(
        member.join(crowded, "token", "left_semi")
        .join(matrix, "token")
        .where(F.col("component") < F.col("other"))
        .where(_enough("n", "left", "mn", "ml"))
        .select("print", F.col("other").alias("component"))
        .distinct()
    )
    parts = (
        member.select("print", "component")
        .distinct()
        .join(meets.select("component").distinct(), "component", "left_semi")
    )
    counts = parts.groupBy("component").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("parts"))
    parts = scratch.materialise(
        parts.join(counts, "component").withColumn(
            "group", F.xxhash64("component", F.pmod(F.xxhash64("print"), F.col("parts")))
        )
    )
    asks = scratch.materialise(
        meets.join(parts.select("component", "group").distinct(), "component").select(
            "print", "group"
        )
    )
    further = _compare(sets, parts.select("print", "group"), asks)
    links = scratch.materialise(links.union(further))

    component = connected_components(links).toDF("print", "component")
    named = docs.select("id", row_key).join(
        rows.dropDuplicates(["row_key"]), "row_key"
    ).join(component, "print", "left")
    # A document without words is alone, whatever its id.
    named = named.select(
        "id", "n", F.when(F.col("n") > 0, F.coalesce("component", "print")).alias("class")
    )
    named = scratch.materialise(named)
    first = named.where("class is not null").groupBy("class").agg(F.min("id").alias("first"))
    return named.join(first, "class", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("first")).alias("component_id"),
    )
