"""Plain Python counterparts of the operators, for comparison on small tables."""

import math
import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    own = words(text)
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[k : k + 5]) for k in range(len(own) - 4))


def classes(rows):
    """[(id, text)] to the list of (id, set size, smallest id reachable) in order."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = []
    for k, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k)]
        known = [i for i in ids if i is not None]
        out.append((name, len(sets[k]), min(known) if known else None))
    return out


def passages(docs, items, similarity=0.75):
    """{(doc, item): best similarity} over all windows of an item's size."""
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    found = {}
    for name, text in docs:
        own = grams(words(text))
        for item, passage in items:
            bag = grams(words(passage))
            if set(own).isdisjoint(bag):
                continue
            best = 0.0
            for at in range(max(1, len(own) - len(bag) + 1)):
                a, b = Counter(own[at : at + len(bag)]), Counter(bag)
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= similarity:
                found[name, item] = best
    return found


def suffix_nodes(texts, discount=0.5):
    """Kept contexts, log10 P(word | context) and word counts; None is the end of a text."""
    rows = [[*words(t), None] for t in texts]
    count = Counter(w for r in rows for w in r)
    n, size = sum(count.values()), sum(count.values()) + len(count) + 1
    cost = 0.5 * math.log10(max(n, 10))
    nodes = {}

    def log(context, word):
        while context and context not in nodes:
            context = context[1:]
        if not context:
            return math.log10((count[word] + 1) / size)
        rest, listed = nodes[context]
        return listed[word] if word in listed else rest + log(context[1:], word)

    length, below = 1, {()}
    while below:
        follow = defaultdict(Counter)
        for r in rows:
            for k in range(length, len(r)):
                context = tuple(r[k - length : k])
                if context[1:] in below:
                    follow[context][r[k]] += 1
        kept, below = {}, set()
        for context, found in follow.items():
            total = sum(found.values())
            share = {w: (k - discount) / total for w, k in found.items() if k >= 2}
            parent = {w: log(context[1:], w) for w in share}
            share = {w: s for w, s in share.items() if total * s * (math.log10(s) - parent[w]) > cost}
            parent = {w: parent[w] for w in share}
            left = max(1 - sum(share.values()), 1e-9)
            rest = math.log10(left / max(1 - sum(10**p for p in parent.values()), 1e-9))
            gain = sum(s * (math.log10(s) - parent[w]) for w, s in share.items()) + left * rest
            if share and total * gain > cost * len(share):
                kept[context] = (rest, {w: math.log10(s) for w, s in share.items()})
                if max(found.values()) < total:
                    below.add(context)
        nodes.update(kept)
        length += 1
    return nodes, log, count


def sequence_log(log, text):
    own = [*words(text), None]
    return sum(log(tuple(own[max(0, k - 12) : k]), w) for k, w in enumerate(own))


EN = "the cat and the dog went to the old house near the river and then they slept all night long "
FR = "le chat et le chien sont partis dans la vieille maison pres de la riviere et ils ont dormi "

#: Columns that the operators also use inside or return.
CLASH = "ids string, n long, print string, component string, token string, digest string, text_ string, label string, host string"

ROWS = [
    (0, None, "en"),
    (1, "", "en"),
    (2, " \t\n ", None),
    (3, "One two", "en"),
    (4, "one TWO", "en"),
    (5, EN * 3, "en"),
    (6, EN * 3, "en"),
    (7, EN * 3 + "x", "en"),
    (8, FR * 4, "fr"),
    (9, FR * 4 + "<|endoftext|> fin", "fr"),
    (10, "word%d " * 1 % 7 + " ".join(f"w{k}" for k in range(60_000)), "en"),
    (11, "12 34 --- !!", None),
    (12, "naïve café   　 日本語 \U0001f600 it's we'll  x\n\n\ny", "fr"),
    (12, "naïve café   　 日本語 \U0001f600 it's we'll  x\n\n\ny", "fr"),
    (None, EN * 3, None),
    (None, None, None),
    (13, "a" * 20_000, "en"),
]
