"""The registered queries of the large-text operators; each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart import scratch
from trailmart.llm import audit, binary, bpe, counts, decontaminate, hosts, hosts_sql, jaccard, language, neighbours, prefix_trie, shards, substrings, suffix_tree

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
SHARDS = 40
NEIGHBOURS = 10
RULES = (
    hosts.Rule("net", "/", "block"),
    hosts.Rule("example.net", "/en/", "allow"),
    hosts.Rule("example.com", "/de/", "block"),
    hosts.Rule("org", "/fr/", "allow"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two folds of three."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    dictionaries = language.learn(docs.where(~held_out))
    found = language.identify(docs, dictionaries, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and back."""
    path = public_tokenizers.path(VOCABULARY)
    docs = _table(spark, sf_dir, "documents")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    encoded = bpe.encode(docs, ["doc_id"], "text", path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        "ids",
    )
    decoded = bpe.decode(encoded, ["doc_id", "n_tokens", "ids_sha256"], "ids", path)
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth vector."""
    rows = _table(spark, sf_dir, "embeddings")
    index = neighbours.build_index(rows, "vec_id", "embedding")
    queries = rows.where(F.pmod("vec_id", F.lit(100)) == 0)
    return neighbours.nearest(index, queries, "vec_id", "embedding", NEIGHBOURS)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return jaccard.shingle_classes(_table(spark, sf_dir, "documents"))


def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards in a tree, and where documents go when one more is added."""
    tree = shards.Tree.even(SHARDS)
    return shards.assign(_table(spark, sf_dir, "documents"), tree, tree.grow())


def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in ORC files, read back."""
    folder = scratch.new_folder(spark, "tokens")
    docs = _table(spark, sf_dir, "documents")
    binary.write_tokens(docs, folder, public_tokenizers.path(VOCABULARY))
    return binary.token_positions(binary.read_tokens(spark, folder))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from six folds of seven."""
    docs = _table(spark, sf_dir, "documents")
    return suffix_tree.score(docs, F.coalesce(_fold(7) == 2, F.lit(False)))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.find(docs, items, keep=["doc_id"])


def op9_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page."""
    return hosts.judge(_table(spark, sf_dir, "pages"), RULES)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a cache that is empty at first."""
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    path = public_tokenizers.path(VOCABULARY)
    counted = counts.count_tokens(rows, ["doc_id", "n_bytes"], "text", path, counts.fresh_cache(docs))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each source, in every order."""
    failed = audit.failures(_table(spark, sf_dir, "documents"))
    return audit.audit(audit.combinations(failed, _table(spark, sf_dir, "labels")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the rebuilt conversations."""
    turns, lengths = prefix_trie.rebuilt(prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, lengths)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of twenty words that occurred before."""
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_bpe,
        op3_graph_neighbours,
        op4_ngram_jaccard,
        op5_hash_tree,
        op6_orc_tokens,
        op7_suffix_tree,
        op8_decontaminate,
        op9_link_trust,
        op10_token_counts,
        op11_filter_audit,
        op12_prefix_trie,
        op13_substring_dedup,
    )
}

_UPPER, _LOWER = hosts.UPPER, hosts.LOWER

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard": rf"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end s
  from w),
t as materialized (select doc_id, len(s) n, unnest(s) t from s),
l as materialized (
  select a.doc_id a, b.doc_id b from t a join t b on a.t = b.t and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r as (select doc_id, doc_id other from s union select r.doc_id, l.b from r join l on l.a = r.other)
select s.doc_id, len(s)::bigint n_shingles, min(r.other) component_id
from s join r using (doc_id) group by s.doc_id, s.s""",
    "op9_link_trust": hosts_sql.judge_sql(RULES),
    "op11_filter_audit": r"""
with t as (select doc_id, coalesce(source, '') part, coalesce(text, '') t from documents),
w as (
  select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
    min(doc_id) over (partition by t) earliest from t),
d as materialized (
  select doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > earliest, false)] f from w),
l as (select doc_id, max(coalesce(quality = 1, false)::int) good, max(coalesce(toxic = 1, false)::int) toxic
  from labels group by doc_id),
c as materialized (
  select part, f, count(*) n, sum(coalesce(good, 0)) good, sum(coalesce(toxic, 0)) toxic
  from d left join l using (doc_id) group by part, f),
x as (select unnest(range(1, 6)) x),
o as (
  select [a.x, b.x, c.x, d.x, e.x] o from x a, x b, x c, x d, x e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select o, unnest(range(1, 6)) step from o),
r as (
  select part, list_aggregate(list_transform(o, lambda k: substr('ABCDE', k, 1)), 'string_agg', '') filter_order, step,
    n, good, toxic, o[step] own, f[o[step]] fails, len(list_filter(o[1:step - 1], lambda k: f[k])) earlier,
    len(list_filter(f, lambda b: b)) failed
  from c, s),
g as materialized (
  select part, filter_order, step, own, sum(n) filter (earlier = 0 and not fails) kept,
    sum(n) filter (earlier = 0 and fails) removed, sum(n) filter (earlier > 0 and fails) redundant,
    sum(n) filter (fails and failed = 1) unique_fails, sum(good) filter (earlier = 0 and fails) good_lost,
    sum(toxic) filter (earlier = 0 and fails) toxic_lost
  from r group by part, filter_order, step, own)
select part, filter_order, step, coalesce(kept, 0)::bigint kept, coalesce(removed, 0)::bigint removed,
  coalesce(redundant, 0)::bigint redundant, coalesce(unique_fails, 0)::bigint unique_fails,
  coalesce(good_lost, 0)::bigint good_lost, coalesce(toxic_lost, 0)::bigint toxic_lost,
  (sum(coalesce(removed, 0)) over (partition by part, own))::bigint shapley
from g""",
    "op12_prefix_trie": r"""
with t as materialized (select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
c as materialized (
  select conv_id c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) own
  from conversations where conv_id is not null group by conv_id),
h as (
  select c, own, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(c::varchar) + 1),
    lambda i: ascii(substr(c::varchar, i, 1))::bigint)),
    lambda a, b: xor(a >> 8, t.t[(xor(a, b) & 255) + 1])), 4294967295) % 4 h from c, t),
r as materialized (
  select h.c, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) s
  from h left join c b on b.c = h.c - h.c % 20),
p as materialized (
  select c, d, s[1:d] k, len(s) = d ends from (select c, s, unnest(range(len(s) + 1)) d from r)),
n as materialized (
  select k, d, min(c) c, count(*) n,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) ends from p group by k, d),
x as materialized (
  select n.*, u.c up, (select count(*) from n m where m.d = n.d + 1 and m.k[1:n.d] = n.k) kids,
    case when d = 0 then 0 else (n - 1) * len(list_filter(regexp_split_to_array(k[d].t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) end saved
  from n left join (select k uk, c from n) u on n.d > 0 and u.uk = n.k[1:n.d - 1]),
z as (select k[1:v] k, sum((kids = 0)::int) leaves, sum(saved) saved
  from (select k, kids, saved, unnest(range(d + 1)) v from x) group by 1)
select x.c conv_id, x.d depth, x.up parent_conv_id, x.n n_convs, x.kids n_children,
  z.leaves::bigint n_leaves, z.saved::bigint saved_tokens, x.ends ends_sha256
from x join z using (k)""",
    "op13_substring_dedup": r"""
with w as materialized (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
g as materialized (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 18)) i from w)),
later as (select doc_id, i from g qualify row_number() over (partition by g order by doc_id, i) > 1),
gone as (select distinct doc_id, i + unnest(range(20)) i from later),
p as (select doc_id, unnest(w) word, unnest(range(1, len(w) + 1)) i from w),
k as (
  select p.doc_id, string_agg(word, ' ' order by p.i) filter (gone.i is null) kept, count(gone.i) n
  from p left join gone on gone.doc_id = p.doc_id and gone.i = p.i group by p.doc_id)
select w.doc_id, len(w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(kept, '')) kept_sha256
from w left join k using (doc_id)""",
}
