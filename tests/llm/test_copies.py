"""Substring dedup, filter audit and prefix trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from plain import CLASH, ROWS

from trailmart.llm import audit, prefix_trie, substrings
from trailmart.llm.contraction import subtree_totals

SEPARATED = re.compile(r"[^\x20\x09-\x0D]+")


def kept_words(rows, window):
    """{(id, text): (words, removed, kept text)} of [(id, text)]; null ids first."""
    known = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    # Rows with one id come in the order of a hash that this does not know: give each an id of its own.
    seen, out = set(), {}
    for there, i, text in known:
        words = SEPARATED.findall(text)
        gone = set()
        for k in range(len(words) - window + 1):
            own = tuple(words[k : k + window])
            if own in seen:
                gone.update(range(k, k + window))
            seen.add(own)
        left = [w for k, w in enumerate(words) if k not in gone]
        out[i if there else None, text] = (len(words), len(gone), " ".join(left), gone)
    return out


def _mix(draw, n):
    passages = [[f"w{draw.randrange(40)}" for _ in range(draw.randrange(3, 30))] for _ in range(25)]
    return " ".join(w for _ in range(n) for w in draw.choice(passages))


@pytest.mark.parametrize("chunk_bytes, block_bytes", [(1 << 20, 1 << 20), (500, 300)])
def test_later_windows_go(spark, chunk_bytes, block_bytes):
    draw = random.Random(7)
    rows = [(k, _mix(draw, draw.randrange(6))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "a b c"), (None, rows[5][1]), (204, rows[9][1]), (204, rows[9][1])]
    rows += [(205, "same " * 50), (206, "x  same\v" + "same " * 8)]
    df = spark.createDataFrame([(*r, "n", "x") for r in rows], "doc_id long, text string, n_words string, kept string")
    found = substrings.remove_repeats(
        df.repartition(5), keep=["doc_id", "text", "n_words"], window=6, chunk_bytes=chunk_bytes, block_bytes=block_bytes
    ).collect()
    plain = kept_words(rows, 6)
    assert len(found) == len(rows)
    for r in found:
        n, removed, kept, gone = plain[r["doc_id"], r["text"] or ""]
        assert (r["n_words"], r["n_removed"], r["kept"]) == (n, removed, kept), r["doc_id"]
        assert {k for s in r["removed"] for k in range(s["start"], s["stop"])} == gone


def test_odd_documents_keep_their_rows(spark, odd_docs, no_docs):
    found = substrings.remove_repeats(odd_docs, keep=["doc_id", "text", "ids", "n"]).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _, _ in ROWS)
    by_id = defaultdict(list)
    for r in found:
        by_id[r["doc_id"]].append(r)
    # The text without an id comes first, so its copies go whole.
    assert by_id[5][0]["kept"] == by_id[6][0]["kept"] == ""
    assert by_id[7][0]["kept"] == "x" or by_id[7][0]["n_removed"] > 0
    # Rows that are equal are one document.
    assert [r["n_removed"] for r in by_id[12]] == [0, 0]
    assert by_id[10][0]["n_removed"] == 0 and by_id[10][0]["n_words"] > 60_000
    assert substrings.remove_repeats(no_docs).count() == 0


def test_the_sketch_never_counts_too_few():
    draw = np.random.default_rng(3)
    marks = np.concatenate([np.unique(draw.integers(0, 5000, 900)) for _ in range(6)])
    weights = draw.integers(1, 3, len(marks)).astype(np.int8)
    true = defaultdict(int)
    for m, w in zip(marks.tolist(), weights.tolist(), strict=True):
        true[m] += w
    said = substrings.estimates(marks, weights)
    assert all(s >= true[m] for m, s in zip(marks.tolist(), said.tolist(), strict=True))
    assert np.mean([s == true[m] for m, s in zip(marks.tolist(), said.tolist(), strict=True)]) > 0.8
    assert substrings.unpack(substrings.pack(np.unique(marks))).tolist() == np.unique(marks).tolist()
    assert len(substrings.unpack(substrings.pack(np.zeros(0, np.int64)))) == 0


def _measures(text):
    words = SEPARATED.findall(text)
    return [
        len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text)), len(text),
    ]


def test_the_transducer_counts_as_plain_python(monkeypatch):
    from trailmart.llm import words

    draw = random.Random(11)
    letters = "ab AB \t\n\v#|é日\U0001f600 x" + "\x85　"
    texts = [t for _, t, _ in ROWS] + ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(300)]
    texts += ["prefix-of-a-long-word-" * 3 + c for c in ("a b", "b a b", "a")] + ["ab" * 50 + " " + "ab" * 49 + "ac " + "ab" * 50]
    for size in (1 << 18, 40):
        monkeypatch.setattr(words.slices, "__defaults__", (size,))
        found = audit.transduce(pa.array(texts))
        assert found.tolist() == [_measures(t or "") for t in texts]


def test_equal_hashes_are_told_apart_by_their_bytes():
    data = np.frombuffer(b"one two one longer-than-eight longer-than-eighT longer-than-eight" + bytes(8), np.uint8)
    starts = np.array([0, 4, 8, 12, 30, 48])
    sizes = np.array([3, 3, 3, 17, 17, 17])
    hashes = np.array([5, 5, 5, 5, 5, 5], np.uint64)
    owner = np.zeros(6, np.int64)
    first = audit.first_spans(data, starts, sizes, hashes, owner)
    assert first.sum() == 4  # one, two, and both long ones
    assert audit.first_spans(data, starts, sizes, hashes, np.arange(6)).all()


def plain_audit(rows, labels):
    """{(part, order, step): figures} of rows (id, text, part) and labels (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = defaultdict(list)
    for i, text, part in rows:
        n, distinct, capitals, symbols, points = _measures(text or "")
        copied = i is not None and i > least[text or ""]
        fails = {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * points, "D": symbols > 0, "E": copied}
        parts[part or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, docs in parts.items():
        whole = Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                stay = [d for d in left if not d[0][f]]
                failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), step] = [
                    len(stay), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
                whole[f] += len(gone)
                left = stay
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(whole[order[step - 1]])
    return out


def test_the_audit_agrees_with_every_order(spark, odd_docs, no_docs):
    draw = random.Random(5)
    pool = ["word " * 60, "A lot OF Capitals HERE", "# " + " ".join(f"u{k}" for k in range(70)), " ".join(f"u{k}" for k in range(70))]
    rows = [(k % 50, draw.choice(pool), draw.choice(["s", "t", None, ""])) for k in range(80)]
    rows += [(i, t, lang) for i, t, lang in ROWS] + [(None, pool[0], "s"), (9_000, None, "none")]
    labels = [(k % 60, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for k in range(70)] + [(None, 1, 1), (77_777, 1, 1)]
    extra = "failed string, id string, digest string, own string, kept string, n_words string"
    docs = spark.createDataFrame([(*r, *"abcdef") for r in rows], f"doc_id long, text string, source string, {extra}")
    said = spark.createDataFrame([(*x, "i") for x in labels], "doc_id long, quality int, toxic int, id string")
    failed = audit.failures(docs.repartition(4))
    found = audit.audit(audit.combinations(failed, said)).collect()
    assert {(r[0], r[1], r[2]): list(r)[3:] for r in found} == plain_audit(rows, labels)
    assert len(found) == 600 * len({r[2] or "" for r in rows})
    assert audit.audit(audit.combinations(audit.failures(no_docs, part_col="lang"), said)).count() == 0


def plain_trie(rows):
    """Rows of the trie from [(conv, turn, role, text)]."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = int(np.fix(c / 20)) * 20
        line = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(line) + 1):
            members[line[:d]].append(c)
        ends[line].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, convs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(convs) - 1) * (len(SEPARATED.findall(k[-1][1])) if k else 0)
    return sorted(
        (min(convs), len(k), min(members[k[:-1]]) if k else -1, len(convs), kids[k], leaves[k], saved[k],
         hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
        for k, convs in members.items()
    )


def _trie(df):
    turns, lengths = prefix_trie.rebuilt(prefix_trie.numbered_turns(df))
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, prefix_trie.trie(turns, lengths).collect()))


def test_the_trie_agrees_with_plain_python(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 7)
    draw = random.Random(2)
    texts = ["hello there", "hello  there", "", None, "one", "two words\v", "x " * 30]
    rows = []
    for c in [*range(0, 70), -3, -20, -21, 141, 147, 10**12]:
        for turn in range(draw.randrange(1, 7)):
            rows.append((c, turn, draw.choice(["user", None, "assistant"]), draw.choice(texts)))
    rows += [(80, k, "user", f"turn {k % 3}") for k in range(60)] + [(81, k, "user", f"turn {k % 3}") for k in range(60)]
    rows += [(90, None, None, "late"), (90, None, "user", None), (90, 1, "user", "a"), (90, 1, "user", "a"), (None, 0, "user", "lost")]
    schema = f"conv_id long, turn long, role string, text string, {CLASH}, conv string, pos string, depth string, a string"
    extra = ("i", 1, "p", "c", "t", "d", "x", "l", "h", "v", "p", "d", "a")
    df = spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(6)
    assert _trie(df) == plain_trie(rows)
    assert _trie(df.limit(0)) == []


def test_long_texts_of_ids_are_hashed_over_all_ranges(spark):
    ends = spark.range(5_000).selectExpr("7L as a", "-id % 2 as b", "id - 1000 as conv")
    found = {r["b"]: r["ends_sha256"] for r in prefix_trie.member_hashes(ends.repartition(8)).collect()}
    for b in (0, -1):
        ids = ",".join(str(k - 1000) for k in range(5_000) if -(k % 2) == b)
        assert found[b] == hashlib.sha256(ids.encode()).hexdigest()


@pytest.mark.parametrize("shape", ["random", "chain", "star", "brooms"])
def test_contraction_gives_every_subtree_total(spark, shape):
    draw = random.Random(shape)
    n = 150
    parents = {
        "random": [None, None] + [draw.randrange(k) for k in range(2, n)],
        "chain": [None] + list(range(n - 1)),
        "star": [None] + [0] * (n - 1),
        "brooms": [None] + [k - 1 if k % 30 < 20 and k % 30 else draw.randrange(k) for k in range(1, n)],
    }[shape]
    values = [draw.randrange(-5, 100) for _ in parents]
    rows = [(f"n{k}", None if p is None else f"n{p}", v, 1) for k, (p, v) in enumerate(zip(parents, values, strict=True))]
    df = spark.createDataFrame(rows, "name string, up string, weight long, one long").repartition(4)
    found = {r["name"]: (r["weight"], r["one"]) for r in subtree_totals(df, ["name"], ["up"], ["weight", "one"]).collect()}
    total, size = list(values), [1] * n
    for k in range(n - 1, 0, -1):
        if parents[k] is not None:
            total[parents[k]] += total[k]
            size[parents[k]] += size[k]
    assert found == {f"n{k}": (total[k], size[k]) for k in range(n)}
    assert subtree_totals(df.limit(0), ["name"], ["up"], ["one"]).count() == 0
