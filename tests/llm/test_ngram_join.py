"""The grouped prefix join against all pairs."""

import random

import pytest

from tarnlake.llm import ngram_join
from tarnlake.llm.components import components

SCHEMA = "doc_id long, text string, sid string, rid int, head string, label string"


def _reached(ids, linked):
    """Smallest id that each of ``ids`` reaches by the links."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def _similar(sets, percent):
    return [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]


def _families(rng, tokens, families, size):
    """Sets at, just above and just below the limit, chains of edits, one size with one prefix, and all tokens shared by unlike sets."""
    sets = []
    for _ in range(families):
        base = rng.sample(range(tokens), rng.randrange(3, size))
        for _ in range(rng.randrange(1, 9)):
            x = set(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 8)):
                x.discard(rng.choice(sorted(x)))
                x.add(rng.choice([rng.randrange(tokens), rng.randrange(10**6, 10**7)]))
            sets.append(x)
            if rng.random() < 0.5:
                base = sorted(x)
    return {i: s for i, s in enumerate({frozenset(s) for s in sets if s})}


@pytest.mark.parametrize("seed, tokens, families, size, percent", [(1, 4_000, 30, 60, 90), (2, 60, 25, 40, 90), (3, 150, 20, 30, 80), (4, 40, 12, 30, 70)])
def test_links_join_what_all_pairs_join(spark, seed, tokens, families, size, percent):
    sets = _families(random.Random(seed), tokens, families, size)
    frame = spark.createDataFrame([(i, len(s), sorted(s)) for i, s in sets.items()], "rid long, n long, h array<long>").repartition(3)
    found = ngram_join.set_links(frame, percent)
    linked = _similar(sets, percent)
    got = {(r["a"], r["b"]) for r in found.collect()}
    assert got <= set(linked) and len(linked) > 5
    want = _reached(sets, linked)
    labels = {r["v"]: r["label"] for r in components(found).collect()}
    assert {i: labels.get(i, i) for i in sets} == want


def _plain(docs):
    """docs: (doc_id, text). Rows (doc_id, n_shingles, component_id)."""
    sets = []
    for _, text in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        sets.append({tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set())
    root = _reached(range(len(docs)), [x for x in _similar(dict(enumerate(sets)), 90) if sets[x[0]]])
    out = []
    for i, (doc, _) in enumerate(docs):
        same = [d for j, (d, _) in enumerate(docs) if root[j] == root[i] and d is not None]
        out.append((doc, len(sets[i]), min(same) if same and sets[i] else doc))
    return sorted(out, key=repr)


def test_awkward_documents(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(n))
    base = text(200).split(" ")
    near = []
    for _ in range(40):
        x = list(base)
        for _ in range(rng.randrange(4)):
            x[rng.randrange(200)] = rng.choice(["new", "B", text(1)])
        near.append(" ".join(x))
    texts = [text(rng.randrange(1, 60)) for _ in range(60)] + near + [near[3]] * 20 + [None, "", " \n\t", "Two words", "two WORDS", "one", "ONE\t", "é É", "a b c", "A\x0bB\rC", "x " * 30_000, "z" * 100_000]
    docs = [(rng.randrange(10**6), t) for t in texts] + [(None, near[0]), (None, "lonely text of a null id"), (None, None), (5, text(30)), (5, text(30))]
    docs += [docs[0]] * 3
    frame = spark.createDataFrame([(d, t, "s", 1, "h", "l") for d, t in docs], SCHEMA).repartition(4)
    got = ngram_join.join_documents(frame)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == _plain(docs)


def test_nothing(spark):
    assert ngram_join.join_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, t, "", 1, "", "") for i, t in enumerate([None, "", "a b c d", "e f g h"])]
    assert [tuple(r) for r in ngram_join.join_documents(spark.createDataFrame(rows, SCHEMA)).sort("doc_id").collect()] == [(0, 0, 0), (1, 0, 1), (2, 2, 2), (3, 2, 3)]


def test_bounds():
    for percent in (70, 80, 90, 95):
        for n in range(1, 200):
            least = ngram_join._least(n, percent)
            assert 100 * least >= percent * n and 100 * (least - 1) < percent * n and 1 <= ngram_join._ahead(n, percent) <= least
