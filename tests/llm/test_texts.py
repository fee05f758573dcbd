import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from plain import EN, FR, ROWS, classes, passages, sequence_log, shingles, suffix_nodes, words
from pyspark.sql import functions as F

from trailmart.llm import decontaminate, jaccard, language, suffix_tree
from trailmart.llm import words as W


def test_words_and_shingles_are_those_of_the_pattern():
    texts = [t for _, t, _ in ROWS]
    sets = dict(W.shingle_sets(pa.array(texts)))
    assert [len(sets[k]) for k in range(len(texts))] == [len(shingles(t)) for t in texts]
    whole = pa.array(["x", *texts, "y"])
    sliced = dict(W.shingle_sets(whole.slice(1, len(texts))))
    assert all((sliced[k] == sets[k]).all() for k in sets)
    assert jaccard.set_print(sets[5]) == jaccard.set_print(sets[6]) != jaccard.set_print(sets[7])


def test_classes_of_odd_texts(odd_docs, no_docs):
    rows = [tuple(r) for r in jaccard.shingle_classes(odd_docs).collect()]
    assert Counter(rows) == Counter(classes([(i, t) for i, t, _ in ROWS]))
    assert jaccard.shingle_classes(no_docs).count() == 0


def test_classes_of_families_of_near_copies(spark):
    draw = np.random.default_rng(3)
    rows = []
    for family in range(12):
        base = [f"f{family}w{k}" for k in draw.integers(0, 400, 120)]
        for _ in range(14):
            own = list(base)
            for k in draw.integers(0, 120, draw.integers(0, 9)):
                own[k] = f"x{draw.integers(0, 10**6)}"
            cut = draw.integers(0, 12)
            rows.append((len(rows), " ".join(own[cut:])))
    common = " ".join(f"c{k}" for k in range(40))
    rows += [(len(rows) + k, common + f" own{k} " + " ".join(f"u{k}v{j}" for j in range(30))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ours = [tuple(r) for r in jaccard.shingle_classes(df).collect()]
    assert Counter(ours) == Counter(classes(rows))


def test_blocks_of_comparisons_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMPARISONS", 3)
    monkeypatch.setattr(jaccard, "KEY_BITS", 1 << 15)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[: 60 - k % 8])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.shingle_classes(df).collect()) == Counter(classes(rows))
    monkeypatch.setattr(jaccard, "KEY_BITS", 16)  # texts joined by key
    assert Counter(tuple(r) for r in jaccard.shingle_classes(df).collect()) == Counter(classes(rows))


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.where("doc_id % 3 != 1")
    found = language.identify(docs.where("doc_id % 3 = 1"), language.learn(train), keep=["lang"])
    rows = found.collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert sum(r["accepted"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_texts(odd_docs, no_docs):
    model = language.learn(odd_docs)
    assert sorted(model) == ["en", "fr"]
    rows = language.identify(odd_docs, model, keep=["doc_id", "text", "label"]).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        nothing = not any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == nothing
        assert not (nothing and (r["accepted"] or r["score"]))
    by_text = {r["text"]: r["lang_pred"] for r in rows}
    assert by_text[EN * 3] == "en" and by_text[FR * 4] == "fr"
    assert language.learn(no_docs) == {}
    assert {r["lang_pred"] for r in language.identify(odd_docs, {}, ["doc_id"]).collect()} == {"und"}
    assert language.identify(no_docs, model, ["doc_id"]).count() == 0


def test_sample_does_not_depend_on_partitions(odd_docs):
    assert language.learn(odd_docs) == language.learn(odd_docs.repartition(7))


def test_copies_take_no_place_in_the_sample(spark):
    own = spark.range(300).selectExpr("'en' as lang", "concat('text number ', id) as text")
    copies = spark.range(200_000).selectExpr("'en' as lang", "'the same text' as text")
    pieces = 64
    sample = language.learn(own.union(copies), pieces=pieces)["en"].decode()
    assert sample.count("number") + sample.count("same") == pieces
    assert sample == language.learn(own.union(copies.limit(1)), pieces=pieces)["en"].decode()


def test_passages_are_those_of_all_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = decontaminate.find(docs, items, keep=["doc_id"]).collect()
    plain = passages(
        [(r["doc_id"], r["text"]) for r in docs.collect()],
        [(r["item_id"], r["text"]) for r in items.collect()],
    )
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in found} == plain
    clean = decontaminate.remove_contaminated(docs, items)
    assert clean.columns == docs.columns
    ids = {r["doc_id"] for r in clean.collect()}
    assert ids == {r["doc_id"] for r in docs.collect()} - {d for d, _ in plain}


def test_passages_with_words_put_in_and_left_out(spark):
    draw = np.random.default_rng(11)
    items, docs = [], []
    for k in range(12):
        size = int(draw.integers(12, 90))
        base = [f"i{k}w{w}" for w in draw.integers(0, 60 if k % 3 else 9, size)]
        items.append((k, " ".join(base)))
        for _ in range(12):
            own = list(base)
            for _ in range(draw.integers(0, 3)):
                at, many = int(draw.integers(0, len(own))), int(draw.integers(1, 4))
                own[at:at] = [f"n{w}" for w in draw.integers(0, 10**6, many)]
            for _ in range(draw.integers(0, 3)):
                at = int(draw.integers(0, len(own)))
                del own[at : at + int(draw.integers(1, 4))]
            lead, tail = ([f"o{w}" for w in draw.integers(0, 10**6, draw.integers(0, 30))] for _ in "ab")
            docs.append((len(docs), " ".join([*lead, *own, *tail])))
    plain = passages(docs, items)
    found = decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        keep=["doc_id"],
    ).collect()
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in found} == plain


def test_all_items_within_the_radius_are_found():
    draw = np.random.default_rng(0)
    text = " ".join(f"w{k}" for k in range(4000))
    items = [(k, " ".join(text.split()[20 * k : 20 * k + 20])) for k in range(200)]
    index = decontaminate.Index(items)
    prints = index._prints
    for _ in range(200):
        one = np.packbits(np.unpackbits(prints[draw.integers(200)]) ^ (draw.random(128) < 0.25))
        far = np.array([np.unpackbits(p ^ one).sum() for p in prints])
        assert index.within_radius(one).tolist() == np.flatnonzero(far <= decontaminate.RADIUS).tolist()


def test_passages_in_odd_texts(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(5, EN), (3, EN.upper()), (None, EN), (7, None), (8, "too short"), (9, "")],
        "item_id long, text string",
    )
    found = decontaminate.find(odd_docs, items, keep=["text", "token"]).collect()
    assert {r["item_id"] for r in found} == {3}
    assert Counter(r["text"] for r in found) == Counter(t for _, t, _ in ROWS if t and t.startswith(EN))
    assert decontaminate.find(no_docs, items, keep=["doc_id"]).count() == 0
    assert decontaminate.find(odd_docs, items.limit(0), keep=["doc_id"]).count() == 0
    assert decontaminate.remove_contaminated(odd_docs, items.limit(0)).count() == len(ROWS)


def test_scores_agree_with_plain_counts(spark, odd_docs):
    held = F.coalesce(F.col("doc_id") % 3 == 2, F.lit(False))
    rows = suffix_tree.score(odd_docs, held).collect()
    assert len(rows) == len(ROWS)
    count = Counter()
    for name, text, _ in ROWS:
        if not (name is not None and name % 3 == 2):
            count.update([*words(text), None])
    n, v = sum(count.values()), len(count)
    expected = Counter()
    for name, text, _ in ROWS:
        own = [*words(text), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        expected[name, len(own), sum(count[w] > 0 for w in own), n, round(base, 6)] += 1
    ours = Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows
    )
    assert ours == expected


def test_every_node_is_a_distribution(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    nodes, log, count = suffix_nodes(texts)
    symbols = [*count, "\n"]  # and one unknown word
    for size in sorted({len(c) for c in nodes}):
        for context in [c for c in nodes if len(c) == size][:10]:
            assert sum(10 ** log(context, w) for w in symbols) == pytest.approx(1, abs=1e-6)


def test_held_out_scores_beat_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.col("doc_id") % 7 == 2
    rows = [r for r in suffix_tree.score(docs, held).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def _plain_scores(rows, learned):
    _, log, _ = suffix_nodes([t for _, t in learned])
    return sorted((i, pytest.approx(sequence_log(log, t), abs=1e-4)) for i, t in rows)


def test_scores_are_those_of_a_plain_tree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = suffix_tree.score(docs, F.col("doc_id") % 5 == 0).collect()
    expected = _plain_scores(rows, [r for r in rows if r[0] % 5])
    assert sorted((r["doc_id"], r["score"]) for r in found) == expected


def test_contexts_grow_as_long_as_they_tell_followers_apart(spark):
    draw = np.random.default_rng(5)
    table = draw.dirichlet([0.2] * 4, (4, 4, 4))  # what follows any three words
    rows = []
    for k in range(60):
        own = [0, 1, 2]
        for _ in range(200):
            own.append(int(draw.choice(4, p=table[tuple(own[-3:])])))
        rows.append((k, " ".join(f"w{x}" for x in own)))
    nodes, _, _ = suffix_nodes([t for _, t in rows])
    assert max(map(len, nodes)) >= 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((r["doc_id"], r["score"]) for r in suffix_tree.score(docs, F.lit(False)).collect())
    assert found == _plain_scores(rows, rows)


def test_the_tree_keeps_rare_contexts_however_large_the_corpus_is(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    # As if the corpus were so large that next to no word made up the least share of it.
    monkeypatch.setattr(suffix_tree, "MAX_WORDS", 16)
    monkeypatch.setattr(suffix_tree, "SIEVE_BITS", 15)
    found = sorted((r["doc_id"], r["score"]) for r in suffix_tree.score(docs, F.lit(False)).collect())
    assert found == _plain_scores(rows, rows)


def test_contexts_of_many_words_are_counted_ahead(spark):
    draw = np.random.default_rng(7)
    rows = []
    for k in range(80):
        own = []
        for _ in range(60):
            own += ["a"] * int(draw.choice([11, draw.integers(1, 11)], p=[0.8, 0.2])) + ["b"]
        rows.append((k, " ".join(own)))
    nodes, _, _ = suffix_nodes([t for _, t in rows])
    assert max(map(len, nodes)) > suffix_tree.AHEAD + 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r["doc_id"], r["score"]) for r in suffix_tree.score(docs, F.lit(False)).collect())
    assert found == _plain_scores(rows, rows)


@pytest.mark.parametrize("most", [1 << 20, 8])
def test_runs_leave_a_task_in_few_bytes_and_are_counted_whole(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_tree, "MAX_WORDS", most)
    monkeypatch.setattr(suffix_tree, "HELD_RUNS", 20_000)
    draw = np.random.default_rng(3)
    weights = 1 / np.arange(1, 2001)
    texts = [" ".join(f"w{x}" for x in draw.choice(2000, 500, p=weights / weights.sum())) for _ in range(100)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    words_ = suffix_tree._counts(docs, lambda t, b: t.view(np.int64)).cache()
    often = spark.sparkContext.broadcast(suffix_tree._often(words_, 50_100))
    for size in (2, 3):
        every = np.full(1 << (suffix_tree.SIEVE_BITS - 3), 255, np.uint8)
        shared = spark.sparkContext.broadcast(suffix_tree.Shorter(every, every))
        runs = suffix_tree._count_runs(docs, size, shared, often, 3)
        count = Counter(
            tuple(own[k : k + size])
            for own in ([*words(t), None] for t in texts)
            for k in range(len(own) - size + 1)
        )
        found = runs.collect()
        assert Counter(r["n"] for r in found) == Counter(n for n in count.values() if n > 1)
        assert len({r["key"] for r in found}) == len(found)
        if most > 8:
            made = docs.mapInArrow(suffix_tree._packed_runs(size, shared, often, 3), suffix_tree._RUNS)
            sent = made.selectExpr("sum(octet_length(contexts) + octet_length(times)) n").first()["n"]
            assert sent < 8 * len(count)


def test_tree_and_rare_runs_are_shuffled_in_few_bytes(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "MAX_WORDS", 16)  # so that all runs are rare
    draw = np.random.default_rng(9)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 3000, 100)) for _ in range(600)]
    docs = spark.createDataFrame([(k, False, t) for k, t in enumerate(texts)], "id long, held_out boolean, text string")
    docs = docs.repartition(2)
    own = docs.select("text")
    counted = suffix_tree._counts(own, lambda t, b: t.view(np.int64)).cache()
    n = counted.count()
    assert n == len({w for t in texts for w in t.split()}) + 1
    tree, longest, bits = suffix_tree._grow(own, counted, 60_600, np.log10(60_601 + n), 3)
    # 20 bytes a row before: key, count and value, one row each.
    sent = tree.where("bucket >= 0 and times is not null").selectExpr("sum(octet_length(keys) + octet_length(times)) b", "sum(rows) n").first()
    assert sent["b"] < 10 * sent["n"]
    shared = spark.sparkContext.broadcast(suffix_tree._hot(tree, np.log10(60_601 + n), longest))
    dealt = docs.mapInArrow(suffix_tree._deal(shared, bits), suffix_tree._DEALT)
    # 8 bytes of hash, 4 of times and 12 of text before.
    sent = dealt.selectExpr("sum(octet_length(keys) + octet_length(texts)) b", "sum(rows) n").first()
    assert sent["n"] >= 60_000 and sent["b"] < 7 * sent["n"]


def test_sieves_have_a_bit_for_each_key(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "SIEVE_BITS", 15)
    monkeypatch.setattr(suffix_tree, "HELD_RUNS", 500)
    keys = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 3000)
    table = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(3)
    bits = suffix_tree._sieve(table)
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == sorted(
        set((keys.view(np.uint64) >> np.uint64(49)).tolist())
    )
    assert not suffix_tree._sieve(table.limit(0)).any()


def test_scores_of_empty_tables(no_docs, odd_docs):
    assert suffix_tree.score(no_docs, F.lit(False)).count() == 0
    rows = suffix_tree.score(odd_docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in rows} == {0} and {r["score"] for r in rows} == {0.0}




def test_languages_are_those_of_the_smallest_sizes(spark, odd_docs):
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dictionaries = language.learn(docs)
    names = sorted(dictionaries)
    rows = docs.select("doc_id", "text").limit(80).collect() + odd_docs.where("doc_id in (3, 5, 8, 11)").select("doc_id", "text").collect()

    def sizes(blocks, level):
        out = []
        for name in names:
            held = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            press = zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_dict_id=False)
            out.append(sum(len(press.compress(b)) for b in blocks))
        return out

    def plain(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        data = f" {text.lower()} ".encode()
        data = data * 4 if len(data) < language.SHORT_BYTES else data
        blocks = [data[k : k + language.BLOCK_BYTES] for k in range(0, len(data), language.BLOCK_BYTES)]
        for level in (language.LEVEL, language.FINE_LEVEL):
            order = sorted(zip(sizes(blocks, level), names, strict=True))
            margin = (order[1][0] - order[0][0]) / order[1][0]
            if margin >= language.CLOSE:
                break
        return order[0][1], margin

    frame = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(rows)], "n long, text string")
    found = {r["n"]: (r["lang_pred"], r["score"]) for r in language.identify(frame, dictionaries, keep=["n"]).collect()}
    agree = 0
    for k, r in enumerate(rows):
        lang, score = plain(r["text"])
        agree += found[k][0] == lang and found[k][1] == pytest.approx(score, abs=1e-12)
    assert agree == len(rows)
