"""M-trees and SimHash against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tarnlake.llm import mtree, ngram_join, simhash


def _plain_top(rows, k=20):
    rows = [(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in rows]
    out = []
    for a, (q, v) in enumerate(ints):
        if q % 20 == 0:
            found = sorted((-int(v @ w), i) for b, (i, w) in enumerate(ints) if a != b and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 6) for i in range(700)] + [(3000, None), (3020, [1.0, None] * 3), (3040, [float("nan")] * 6), (3060, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (3080, []), (3100, [2.0, 1.0]), (3101, [1.0, 1.0]), rows[20], (3120, [0.0] * 6)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, shard int")
    got = mtree.top_k(frame, shard_rows=400, query_rows=30).collect()
    assert sorted(map(tuple, got)) == _plain_top(rows)


def test_repeated_rows_count_each(spark):
    """A stored row is a candidate as often as it occurs; a query's copies, and other vectors under its id, are candidates of it, too."""
    rows = [(3, [2.0, 1.0])] * 4 + [(20, [1.0, 1.0])] * 3 + [(20, [1.5, 0.5]), (40, [0.0, 0.0]), (60, [-1.0, 3.0])] + [(5, [1.0, 2.0])] * 30
    got = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), shard_rows=4).collect()
    assert sorted(map(tuple, got)) == _plain_top(rows) and sum(r["vec_id"] == 3 for r in got if r["query_id"] == 60) == 0


def test_scores_beyond_exact_arithmetic(spark):
    big = spark.createDataFrame([(20, [3e6, 0.0]), (21, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="2 \\*\\* 53"):
        mtree.top_k(big)
    assert mtree.top_k(big.where("vec_id = 21")).count() == 0


def test_top_k_of_nothing(spark):
    assert mtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tree_avoids_computations():
    """On clustered points, bounds spare most distances, and the result is still exact."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 60
    points = np.rint(np.repeat(centres, 200, axis=0) + rng.normal(size=(8000, 8)))
    points = np.rint(points / np.linalg.norm(points, axis=1)[:, None] * 500)
    tree = mtree.MTree(np.arange(8000), points, page=64, fanout=8)
    for q in range(0, 8000, 800):
        ids, scores = tree.search(points[q], 20)
        want = sorted((-int(points[q] @ points[i]), i) for i in range(8000))[:20]
        assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == want
    assert tree.computed < 0.5 * 10 * 8000


def test_cells_spare_visits(spark):
    """On clustered vectors most cells can't beat the bound; no better vector is in a cell that is skipped, and the result is exact."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8)) * 2
    centres /= np.linalg.norm(centres, axis=1)[:, None] / 3
    rows = [(i, (centres[i % 12] + rng.normal(size=8) / 50).round(4).tolist()) for i in range(1200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, mtree.top_k(frame, shard_rows=60).collect())) == _plain_top(rows)
    points = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    pivots = points[:24]
    cell = np.argmin(((points[:, None] - pivots) ** 2).sum(axis=2), axis=1)
    radii = np.array([np.sqrt(((points[cell == c] - pivots[c]) ** 2).sum(axis=1)).max() for c in range(24)])
    queries = points[::20]
    scores = queries @ points.T
    least = np.sort(scores, axis=1)[:, -20]
    may = mtree.open_cells(queries, least, pivots, radii)
    assert may.mean() < 0.5 and all(may[q, cell[x]] for q, x in np.argwhere(scores >= least[:, None]))
    assert mtree.open_cells(queries, np.full(len(queries), np.nan), pivots, radii).all()


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _plain_print(text, n=3):
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    h = [xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _plain_components(prints, radius=2):
    """prints: (doc_id, fingerprint). Smallest id reachable."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{p:016x}", least.get(find(i))) for i, (d, p) in enumerate(prints)]


def _near_texts():
    rng = random.Random(4)
    out = []
    for _ in range(25):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 120))]
        out.append(" ".join(words))
        for _ in range(rng.randrange(0, 4)):
            some = list(words)
            some[rng.randrange(len(some))] = "changed"
            out.append("\n".join(some).upper())
    return out


def test_near_duplicates(spark):
    texts = [*_near_texts(), None, "", " \t", "Ab", "ab", "ab c", "É b c", "é b c", "word " * 30_000]
    docs = [(100 - i, t) for i, t in enumerate(texts)] + [(5000, texts[0]), (5000, texts[0]), (None, texts[1]), (None, "alone with a null id")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, fp string, label int").repartition(5)
    got = simhash.near_duplicates(frame).collect()
    want = _plain_components([(d, _plain_print(t)) for d, t in docs])
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    kept = [r["doc_id"] for r in kept.collect()]
    assert sorted(kept, key=repr) == sorted({c for _, _, c in want}, key=repr)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("tree_rows", [4, 4096])
def test_links_across_shards(spark, tree_rows):
    """Many fingerprints in one band group, cut into shards or not: the components stay those of all pairs."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    values = {base ^ sum(1 << rng.randrange(20) for _ in range(rng.randrange(0, 6))) for _ in range(120)} | {rng.getrandbits(64) for _ in range(50)}
    prints = [(i, v) for i, v in enumerate(sorted(values))]
    signed = [(i, v - (v >> 63 << 64)) for i, v in prints]
    frame = spark.createDataFrame(signed, "doc_id long, fp long")
    edges = simhash.links(frame.select("fp"), tree_rows=tree_rows)
    labels = {r["v"]: r["label"] for r in simhash.components(edges).collect()}
    groups = {}
    for i, v in signed:
        groups.setdefault(labels.get(v, v), set()).add(i)
    want = {}
    for i, _, c in _plain_components(prints):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_large_groups_are_taken_apart(spark):
    """Fingerprints that agree in half of their bits: no tree meets a part of its group that can't hold a partner, and no link is lost."""
    rng = random.Random(11)
    values = {0xABCD1234 << 32 | rng.getrandbits(32) for _ in range(1500)}
    values |= {v ^ 1 << rng.randrange(32) ^ 1 << rng.randrange(32) for v in list(values)[:200]}
    frame = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long")
    met = simhash._tree_rows(frame, 2, 100).selectExpr("sum(size(nodes) * size(coalesce(probes, nodes)))").first()[0]
    assert met < len(values) ** 2 / 10
    near = {frozenset((a, b)) for a in values for x in range(32) for y in range(x, 32) if (b := a ^ 1 << x ^ (1 << y if y > x else 0)) in values}
    labels = {r["v"]: r["label"] for r in simhash.components(simhash.links(frame, tree_rows=100)).collect()}
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in near:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    groups = {}
    for v in values:
        groups.setdefault(labels.get(v - (v >> 63 << 64), v), set()).add(find(v))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(v) for v in values})


def test_tree_finds_what_is_within():
    rng = random.Random(3)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree(values)
    for q in values[:40]:
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def test_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["label"] for r in simhash.components(edges).collect()} == {0}


def _shingles(text, n=5):
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(1, 2), (2, 3), (9, 8), (-4, 3), (7, 8)], [(i, i + 1) for i in range(300)], [(0, i) for i in range(1, 200)], [(i * 7919 % 500, i * 104729 % 500) for i in range(400)]])
def test_one_task_and_many_join_alike(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    one, many = ({(r["v"], r["label"]) for r in simhash.components(frame, n).collect()} for n in (10**6, -1))
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if all(root[a] == root[b] for a, b in edges):
            break
    assert one == many == set(root.items())


def _plain_similar(docs, similarity=0.8, radius=2):
    """Smallest id of each component of fingerprint links and of shingle sets at least that similar."""
    prints, sets = [_plain_print(t) for _, t in docs], [_shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            same = sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])
            if same or (prints[i] ^ prints[j]).bit_count() <= radius:
                label[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    return sorted(min(g) for g in groups.values())


def _edited(seed, families=12, copies=14):
    rng = random.Random(seed)
    out = []
    for _ in range(families):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(4, 150))]
        for _ in range(rng.randrange(1, copies)):
            some = list(words)
            for _ in range(rng.randrange(0, 4)):
                some[rng.randrange(len(some))] = f"e{rng.randrange(10**6)}"
            out.append(" ".join(some))
    return out


@pytest.mark.parametrize("leaders", [1, 500])
def test_similar_texts(spark, monkeypatch, leaders):
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    long = " ".join(f"x{i}" for i in range(5_000))
    docs = list(enumerate([*_edited(6), None, "", "a b", "A  b", "a b c", long, long.replace("x7 ", "y "), long[: len(long) // 2]]))
    frame = spark.createDataFrame([(d, t, 1, "p") for d, t in docs], "doc_id long, text string, print int, fp string").repartition(4)
    kept = simhash.drop_near_duplicates(frame, percent=80)
    assert kept.columns == frame.columns
    got = sorted(r["doc_id"] for r in kept.collect())
    assert got == _plain_similar(docs) and len(got) < 0.7 * len(docs)


def _kept(spark, texts):
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(r["doc_id"] for r in simhash.drop_near_duplicates(frame, percent=80).collect())
    assert got == _plain_similar(docs)
    return got


def test_long_texts_at_the_limit(spark):
    """Of n shingles the last k differ: similarity (n - k) / (n + k), 0.8 where n is 9 * k. All sets are larger than a sketch."""
    texts = []
    for f, (n, ks) in enumerate([(450, (49, 50, 51)), (900, (97, 99, 100, 101, 103)), (1_800, (199, 200, 201))] * 2):
        for k in ks:
            words = [f"f{f}k{k}w{i}" for i in range(n + 4)]
            texts += [" ".join(words), " ".join(words[:-k] + [f"o{w}" for w in words[-k:]])]
    assert len(_kept(spark, texts)) == 2 * (4 + 7 + 4)


def test_texts_of_one_fingerprint(spark):
    """One shingle fills over half of each first text, so all these have its fingerprint; each second text is similar to just one of them."""
    texts = []
    for f in range(5):
        words = " ".join(f"f{f}w{i}" for i in range(60))
        texts += ["z " * 200 + words, "z " * 6 + words]
    assert _kept(spark, texts) == [0]


def test_no_similar_pair_is_left_out(spark):
    """Four of five shingles in common. The first seeds share no band of two least hashes, the others differ in over 22 bits of the five-word fingerprint."""
    words = [[f"q{k}x{i}" for i in range(9)] for k in (1097, 13331, 13515, 540, 1454, 6159)]
    assert _kept(spark, [" ".join(w[:n]) for w in words for n in (9, 8)]) == [0, 2, 4, 6, 8, 10]
