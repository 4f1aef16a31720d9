"""Exact top-k by inner product: M-trees searched best first."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import stage

SCALE, TOP = 64, 20
#: Vectors of one tree and queries searched in one task; entries of a page and children of an inner node.
SHARD_ROWS, QUERY_ROWS = 8_192, 4_096
PAGE, FANOUT = 1_024, 16
#: Vectors, those with the least hashes of their ids, by which all are cut into cells. They decide what a search can skip, never its result.
PIVOTS = 512
_SLACK = 1e-6


class Leaf:
    """A page of entries: vectors, their ids, and their distances to the page's pivot."""

    __slots__ = ("vectors", "ids", "to_pivot")

    def __init__(self, vectors, ids, to_pivot):
        self.vectors, self.ids, self.to_pivot = vectors, ids, to_pivot


class Inner:
    """A page of children: their pivots, covering radii, and distances to this node's pivot."""

    __slots__ = ("pivots", "radii", "to_pivot", "children")

    def __init__(self, pivots, radii, to_pivot, children):
        self.pivots, self.radii, self.to_pivot, self.children = pivots, radii, to_pivot, children


def _distance(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - to).sum(axis=1))


def _build(points: np.ndarray, ids: np.ndarray, pivot: np.ndarray, page: int, fanout: int, kind: type) -> Leaf | Inner:
    to_pivot = _distance(points, pivot)
    if len(points) <= page:
        return Leaf(np.ascontiguousarray(points[:, :-1], dtype=kind), ids, to_pivot)
    k = min(fanout, -(-len(points) // page))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)]
    near = np.argmin(np.stack([_distance(points, c) for c in centres]), axis=0)
    cells = [np.flatnonzero(near == i) for i in range(k)]
    if max(map(len, cells)) == len(points):  # equal points: any cut is as good
        cells = np.array_split(np.arange(len(points)), k)
    cells = [c for c in cells if len(c)]
    pivots = np.stack([points[c[np.argmin(_distance(points[c], points[c].mean(axis=0)))]] for c in cells])
    radii = np.array([_distance(points[c], p).max() for c, p in zip(cells, pivots, strict=True)])
    return Inner(pivots, radii, _distance(pivots, pivot), [_build(points[c], ids[c], p, page, fanout, kind) for c, p in zip(cells, pivots, strict=True)])


class MTree:
    """An M-tree over integer vectors for inner-product search.

    Vectors get one component more, the root of what their squared norm lacks to the largest; then the nearest point to (query, 0) has the
    largest inner product, and distances obey the triangle inequality.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        norms = np.square(vectors).sum(axis=1)
        self.top_norm = float(norms.max())
        points = np.hstack([vectors, np.sqrt(self.top_norm - norms)[:, None]])
        self.pivot = points[0]
        # Integers up to 2 ** 24 are exact in 32 bits, and no partial sum exceeds the norms' product.
        self.kind = np.float32 if self.top_norm < 1 << 24 else np.float64
        self.root = _build(points, ids, self.pivot, page, fanout, self.kind)
        self.computed = 0

    def search(self, query: np.ndarray, k: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, ties to smaller ids. With ``least``, a score that k vectors elsewhere reach, those below it may be left out."""
        q = np.append(query, 0.0)
        fixed = float(query @ query) + self.top_norm
        exact = query.astype(self.kind if float(query @ query) < 1 << 24 else np.float64)
        bound = np.sqrt(max(0.0, fixed - 2.0 * least))
        bound += _SLACK * (1 + bound)
        scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        heap: list = [(0.0, 0, float(np.sqrt(np.square(q - self.pivot).sum())), self.root)]
        n = 0
        while heap:
            low, _, to_pivot, node = heapq.heappop(heap)
            if low > bound:
                break
            reach = bound + _SLACK * (1 + bound)
            if isinstance(node, Leaf):
                near = np.abs(to_pivot - node.to_pivot) <= reach
                vectors, names = node.vectors, node.ids
                if 2 * np.count_nonzero(near) < len(near):  # else picking them out costs more than it spares
                    vectors, names = vectors[near], names[near]
                self.computed += len(vectors)
                found = vectors @ exact
                fit = np.flatnonzero(found >= (scores[-1] if len(scores) == k else least))
                if not len(fit):
                    continue
                scores, ids = np.concatenate([scores, np.rint(found[fit]).astype(np.int64)]), np.concatenate([ids, names[fit]])
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
                if len(scores) == k:
                    bound = np.sqrt(max(0.0, fixed - 2.0 * scores[-1]))
                    bound += _SLACK * (1 + bound)
            else:
                near = np.flatnonzero(np.abs(to_pivot - node.to_pivot) - node.radii <= reach)
                away = _distance(node.pivots[near], q)
                self.computed += len(near)
                for i, d in zip(near.tolist(), away.tolist(), strict=True):
                    if (low := max(0.0, d - node.radii[i])) <= reach:
                        n += 1
                        heapq.heappush(heap, (low, n, d, node.children[i]))
        return ids, scores


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(id, v, dims, copies)``: distinct rows of (vec_id, embedding) with floor(scale * x) of every component, and how often each occurs. Rows with a null id, and vectors null, empty, or holding null or non-finite
    components, are left out."""
    x = vectors.select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda e: e.cast("double")).alias("e"))
    fine = F.forall("e", lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(F.coalesce(e, F.lit(float("nan")))))
    x = x.where(F.col("id").isNotNull() & (F.size("e") > 0) & fine).select("id", F.transform("e", lambda e: F.floor(e * scale)).alias("v"), F.size("e").alias("dims"))
    return x.groupBy("id", "v", "dims").agg(F.count(F.lit(1)).alias("copies"))


def _trees(rows: pd.DataFrame) -> pd.DataFrame:
    """A tree over the places of rows in the order of their ids, with ids and copies beside it."""
    rows = rows.sort_values("id", kind="stable")
    tree = MTree(np.arange(len(rows)), np.array(rows["v"].tolist(), dtype=np.float64))
    kept = (tree, rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64))
    return rows[["dims", "cell", "shard"]].iloc[:1].assign(tree=[pickle.dumps(kept, protocol=5)])


_FOUND = ("query_id", "query_hash", "vec_id", "score", "copies")


def _searched(k: int):
    def search(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(trees) and len(queries):
            tree, ids, copies = pickle.loads(trees["tree"].iloc[0])
            for own, v, name, least in zip(queries["id"], queries["v"], queries["query_hash"], queries["least"], strict=True):
                at, scores = tree.search(np.asarray(v, np.float64), k, -np.inf if np.isnan(least) else least)
                out.append(pd.DataFrame(dict(zip(_FOUND, (own, name, ids[at], scores, copies[at]), strict=True))))
        return pd.concat(out) if out else pd.DataFrame({x: pd.Series(dtype="int64") for x in _FOUND})

    return search


def _placed(pivots: dict[int, np.ndarray]):
    """Adds the ``cell`` of the nearest pivot and the distance ``far`` to it. Vectors of as many components as no pivot has are cell -1."""

    def run(frames):
        for rows in frames:
            cell, far = np.full(len(rows), -1), np.zeros(len(rows))
            for dims, at in rows.groupby("dims").indices.items():
                if dims in pivots:
                    x, p = np.stack(rows["v"].iloc[at]).astype(np.float64), pivots[dims]
                    cell[at] = np.argmin(np.square(p).sum(axis=1) - 2.0 * (x @ p.T), axis=1)
                    far[at] = _distance(x, p[cell[at]])
            yield rows.assign(cell=cell, far=far)

    return run


def open_cells(queries: np.ndarray, least: np.ndarray, pivots: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Queries by cells: whether the cell may hold a vector of score ``least`` (NaN: unknown) or more. No vector there scores above query * pivot + |query| * radius."""
    lengths = np.sqrt(np.square(queries).sum(axis=1))
    best = queries @ pivots.T + lengths[:, None] * (radii * (1 + _SLACK) + _SLACK)
    return ~(best < least[:, None])


def _visits(pivots: dict[int, np.ndarray], radii: dict[int, np.ndarray]):
    """Adds ``cells``, those that a query must visit."""

    def run(frames):
        for rows in frames:
            cells: list = [[-1]] * len(rows)
            for dims, at in rows.groupby("dims").indices.items():
                if dims in pivots:
                    may = open_cells(np.stack(rows["v"].iloc[at]).astype(np.float64), rows["least"].iloc[at].to_numpy(np.float64), pivots[dims], radii[dims])
                    for i, some in zip(at, may, strict=True):
                        cells[i] = np.flatnonzero(some).tolist()
            yield rows.assign(cells=cells)

    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = TOP, scale: int = SCALE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each vector whose id is divisible by ``every``, the k largest integer inner products with other vectors.

    Every row is a candidate but the query's own: a row that occurs m times is m candidates, and its copies, like rows of another vector under one id, meet each other; a query that occurs m times has its
    result m times. Vectors meet only vectors of as many components; a squared norm of 2 ** 53 or more is an error, as scores could then be inexact.

    Every vector is in the cell of its nearest pivot, and a cell is cut by a hash of the ids into trees of about ``shard_rows``, so a cell of copies spreads. A query searches the tree that it is in
    itself, then, with the score found there as bound, the trees of the cells that can still beat it, in blocks of about ``query_rows`` queries.
    """
    rows = stage(quantised(vectors, scale), "vectors")
    is_query = F.pmod("id", F.lit(every)) == 0
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, m, most = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1)), F.max(norm)).first()
    if (most or 0) >= 1 << 53:
        raise ValueError("squared norms of 2 ** 53 and more: scores wouldn't be exact; use a smaller scale")
    blocks = max(1, -(-m // query_rows))
    sample: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("id"), "id", "v").limit(min(PIVOTS, n // shard_rows + 1)).collect():
        sample.setdefault(r["dims"], []).append(r["v"])
    pivots = {dims: np.unique(np.array(v, np.float64), axis=0) for dims, v in sample.items()}
    placed = stage(rows.mapInPandas(_placed(pivots), "id long, v array<long>, dims int, copies long, cell int, far double"), "cells-of-vectors")
    cells = stage(placed.groupBy("dims", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")), "cells")
    radii = {dims: np.zeros(len(p)) for dims, p in pivots.items()}
    for r in cells.where("cell >= 0").collect():
        radii[r["dims"]][r["cell"]] = r["radius"]
    key, shards = ["dims", "cell", "shard"], cells.drop("radius")
    dealt = placed.drop("far").join(shards, ["dims", "cell"]).withColumn("shard", F.pmod(F.xxhash64("id"), "shards")).drop("shards")
    trees = stage(dealt.groupBy(*key).applyInPandas(_trees, "dims int, cell int, shard long, tree binary"), "m-trees")
    queries = dealt.where(is_query).withColumn("query_hash", F.xxhash64("v"))
    result = ", ".join(f"{c} long" for c in _FOUND)
    home = queries.withColumn("least", F.lit(float("nan")))
    home = stage(trees.groupBy(*key).cogroup(home.groupBy(*key)).applyInPandas(_searched(k + 1), result), "found-at-home")
    bound = home.groupBy("query_id", "query_hash").agg(F.min("score").cast("double").alias("least"), F.count(F.lit(1)).alias("found")).where(F.col("found") > k)
    known = queries.join(bound.select(F.col("query_id").alias("id"), "query_hash", "least"), ["id", "query_hash"], "left").withColumn("least", F.coalesce("least", F.lit(float("nan"))))
    known = known.select("id", "query_hash", "v", "dims", "cell", "shard", "least", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).alias("block"))
    visits = known.mapInPandas(_visits(pivots, radii), "id long, query_hash long, v array<long>, dims int, cell int, shard long, least double, block long, cells array<int>")
    visits = visits.select("id", "query_hash", "v", "dims", F.col("cell").alias("own_cell"), F.col("shard").alias("own_shard"), "least", "block", F.explode("cells").alias("cell")).join(shards, ["dims", "cell"])
    visits = visits.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).where((F.col("cell") != F.col("own_cell")) | (F.col("shard") != F.col("own_shard")))
    visits = visits.drop("own_cell", "own_shard", "shards")
    needed = trees.join(visits.select(*key, F.col("block").alias("part")).distinct(), key)
    away = needed.groupBy(*key, "part").cogroup(visits.groupBy(*key, "block")).applyInPandas(_searched(k + 1), result)
    # The query's own row is one of those found: it has the query's id, and as score the query's squared norm.
    own = queries.select(F.col("id").alias("query_id"), "query_hash", F.col("copies").alias("times"), norm.cast("long").alias("own_score"))
    found = home.union(away).join(own, ["query_id", "query_hash"])
    mine = Window.partitionBy("query_id", "query_hash", "own").orderBy("score")
    found = found.withColumn("own", (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own_score")))
    found = found.withColumn("copies", F.col("copies") - F.when(F.col("own") & (F.row_number().over(mine) == 1), 1).otherwise(0)).where("copies > 0")
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score")
