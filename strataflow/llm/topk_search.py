"""Exact top-k search with an M-tree.

Largest inner product becomes nearest neighbour: with one more component
sqrt(R^2 - |x|^2) (R: the largest norm) for a row and 0 for a query q,
|q' - x'|^2 = |q|^2 + R^2 - 2 <q, x>. Over that metric an M-tree is built: rows
are dealt to pivots of a bounded sample, each pivot's rows, in parts of at
most about PAGE rows, become a subtree whose leaf nodes hold up to NODE rows.
Every node has a routing object, a covering radius and its distance to its
parent's routing object, every row its distance to its node's.

A query enters nodes best first, by the highest score that a node's radius
allows. Stored parent distances rule nodes and rows out, by the triangle
inequality, before a distance to them is computed. Scores are compared as
exact integers. Queries are taken in blocks of bounded size, each a pass over
the tree; tasks return their k best rows per query that can still count.
"""

from __future__ import annotations

import heapq
import pickle
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import ensure_checkpoint_dir

from .tables import ship_code, written

#: Rows sampled for pivots and for the first bound of each query, and pivots.
SAMPLE, PIVOTS = 2048, 64
#: Rows of a subtree and of a leaf node.
PAGE, NODE = 4096, 128
#: Queries of a block, which each task holds.
QUERY_BLOCK = 4096
#: Subtrees that one task searches.
TREES_PER_TASK = 16
#: Rows that a batch from Python holds at most.
OUT_ROWS = 20_000


def scaled(vector: Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """False for null vectors and those with a null or non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad), F.lit(False))


def _matrix(column: Iterable, dims: int) -> np.ndarray:
    """Vectors as rows, missing components as zero."""
    out = np.zeros((len(column), dims), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """Rows with the component that makes all norms equal."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0.0, norm2 - (x * x).sum(axis=1)))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of a and of b."""
    gap = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(gap, 0.0))


def build_subtree(ids: np.ndarray, x: np.ndarray, norm2: float) -> dict:
    """Leaf nodes of at most NODE rows below one root; rows of a node are near one routing object and of similar distance to it."""
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    y = _lifted(x, norm2)
    wanted = max(1, -(-len(ids) // NODE))
    spread = np.random.default_rng(len(ids)).permutation(len(ids))[:wanted]
    near = _distances(y, y[spread])
    mine = near.argmin(axis=1)
    place = np.lexsort((near[np.arange(len(ids)), mine], mine))
    starts = [0]
    for k in range(1, len(place)):
        if mine[place[k]] != mine[place[k - 1]] or k - starts[-1] == NODE:
            starts.append(k)
    ends = [*starts[1:], len(place)]
    root = y[spread[:1]]
    objects = np.array([y[spread[mine[place[a]]]] for a in starts])
    to_object = [np.sqrt(((y[place[a:b]] - o) ** 2).sum(axis=1)) for a, b, o in zip(starts, ends, objects, strict=True)]
    return {
        "root": root[0], "radius": float(_distances(y, root).max()), "least": int(ids.min()),
        "objects": objects, "to_root": np.sqrt(((objects - root) ** 2).sum(axis=1)), "radii": np.array([d.max() for d in to_object]),
        "leasts": np.array([ids[place[a:b]].min() for a, b in zip(starts, ends, strict=True)]),
        "nodes": [(ids[place[a:b]], x[place[a:b]], d) for a, b, d in zip(starts, ends, to_object, strict=True)],
    }


class _Best:
    """The k best (score, id) found; a bound from outside holds until k are found."""

    def __init__(self, k: int, floor: int | None):
        self.k, self.floor, self.found = k, floor, []

    def can_hold(self, score: float, least: int, slack: float) -> bool:
        """Whether a row of at most this score and at least this id may be among the k best."""
        if self.floor is not None and score + slack < self.floor:
            return False
        if len(self.found) < self.k:
            return True
        worst, minus_id = self.found[0]
        return score + slack >= worst + 1 or score + slack >= worst and least < -minus_id

    def worst(self) -> float:
        bounds = [self.floor] if self.floor is not None else []
        bounds += [self.found[0][0]] if len(self.found) == self.k else []
        return max(bounds, default=-np.inf)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        top = np.lexsort((ids, -scores))[:self.k]
        for s, i in zip(scores[top].tolist(), ids[top].tolist(), strict=True):
            if self.floor is not None and s < self.floor:
                break
            if len(self.found) < self.k:
                heapq.heappush(self.found, (s, -i))
            elif (s, -i) > self.found[0]:
                heapq.heapreplace(self.found, (s, -i))
            else:
                break


def search(trees: list[dict], query_id: int, q: np.ndarray, to_roots: np.ndarray, norm2: float, k: int, floor: int | None) -> list[tuple[int, int]]:
    """Best-first search of one query; to_roots: its distances to the roots. Returns (score, -id)."""
    own2 = float((q.astype(np.float64) ** 2).sum())
    slack = 1e-9 * (own2 + norm2) + 1e-6
    lifted = np.append(q.astype(np.float64), 0.0)
    allows = lambda d: (own2 + norm2 - np.maximum(d, 0.0) ** 2) / 2  # noqa: E731  the highest score at distance d or more
    best, heap = _Best(k, floor), []
    for t, (tree, d) in enumerate(zip(trees, to_roots, strict=True)):
        heap.append((-float(allows(d - tree["radius"])), tree["least"], t, -1, d))
    heapq.heapify(heap)
    while heap:
        minus, least, t, node, d = heapq.heappop(heap)
        if not best.can_hold(-minus, least, slack):
            if -minus + slack < best.worst():
                break
            continue
        tree = trees[t]
        if node < 0:
            # the stored distance to the root bounds the distance to a node's routing object
            may = np.flatnonzero(allows(np.abs(d - tree["to_root"]) - tree["radii"]) + slack >= best.worst())
            gaps = np.sqrt(((tree["objects"][may] - lifted) ** 2).sum(axis=1))
            bounds = allows(gaps - tree["radii"][may])
            for n, gap, bound in zip(may.tolist(), gaps.tolist(), bounds.tolist(), strict=True):
                if best.can_hold(bound, int(tree["leasts"][n]), slack):
                    heapq.heappush(heap, (-bound, int(tree["leasts"][n]), t, n, gap))
            continue
        ids, x, parents = tree["nodes"][node]
        rows = np.flatnonzero((allows(np.abs(d - parents)) + slack >= best.worst()) & (ids != query_id))
        if len(rows):
            best.add(x[rows] @ q, ids[rows])
    return best.found


def _tree_batches(batches: Iterable[pd.DataFrame], ids: np.ndarray, q: np.ndarray, floors: list[int | None], norm2: float, k: int) -> Iterator[pd.DataFrame]:
    trees = [pickle.loads(b) for frame in batches for b in frame["tree"]]
    if not trees or not len(ids):
        return
    to_roots = _distances(np.column_stack([q.astype(np.float64), np.zeros(len(q))]), np.array([t["root"] for t in trees]))
    out: list[tuple[int, int, int]] = []
    for i, query_id in enumerate(ids.tolist()):
        out += [(query_id, -minus, score) for score, minus in search(trees, query_id, q[i], to_roots[i], norm2, k, floors[i])]
        if len(out) >= OUT_ROWS:
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
            out = []
    yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def build(vectors: DataFrame, dims: int, norm2: float, sample: np.ndarray) -> DataFrame:
    """The tree of rows (vec_id, x): one row per subtree, written."""
    ship_code(vectors.sparkSession)
    pivots = _lifted(sample[:PIVOTS], norm2)

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot = _distances(_lifted(_matrix(batch.column(1).to_pylist(), dims), norm2), pivots).argmin(axis=1) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pivot.astype(np.int64)), *batch.columns], names=["pivot", "vec_id", "x"])

    dealt = written(vectors.mapInArrow(nearest, "pivot long, vec_id long, x array<long>"), "vectors")
    parts = F.broadcast(dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("parts")))  # a row per pivot
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))

    def subtree(frame: pd.DataFrame) -> pd.DataFrame:
        tree = build_subtree(frame["vec_id"].to_numpy(np.int64), _matrix(frame["x"].tolist(), dims), norm2)
        return pd.DataFrame({"tree": [pickle.dumps(tree)]})

    return written(dealt.join(parts, "pivot").withColumn("part", part).groupBy("pivot", "part").applyInPandas(subtree, "tree binary"), "m-tree")


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", factor: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query row the k other rows of largest inner product, ties to smaller ids.

    Components become floor(factor * x). Vectors that are null or hold a null
    or non-finite component take no part, nor do rows without an id. Rows that
    repeat an id count once (the smallest vector). Missing components of
    shorter vectors count as zero. Other columns are not read; an empty table
    or no query gives an empty result.
    """
    spark = rows.sparkSession
    ship_code(spark)
    named = rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    vectors = named.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col), factor).alias("x"), is_query.alias("asks"))
    if not vectors.groupBy("vec_id").count().where("count > 1").isEmpty():
        vectors = vectors.groupBy("vec_id").agg(F.min("x").alias("x"), F.max("asks").alias("asks"))
    norm = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    facts = vectors.agg(F.max(F.size("x")).alias("dims"), F.max(norm).alias("norm2"), F.sum(F.col("asks").cast("long")).alias("queries")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not facts["queries"]:
        return empty
    dims, norm2 = max(1, facts["dims"]), facts["norm2"]
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample, sample_ids = _matrix([r["x"] for r in drawn], dims), np.array([r["vec_id"] for r in drawn])
    tree = build(vectors.select("vec_id", "x"), dims, norm2, sample)
    tasks = max(1, -(-tree.count() // TREES_PER_TASK))
    blocks = -(-facts["queries"] // QUERY_BLOCK)
    asked = vectors.where("asks").select("vec_id", "x", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    path = f"{ensure_checkpoint_dir(spark)}/top-k-{uuid.uuid4().hex}"
    for b in range(blocks):
        block = asked.where(F.col("block") == b).collect()
        ids, q = np.array([r["vec_id"] for r in block], dtype=np.int64), _matrix([r["x"] for r in block], dims)
        floors: list[int | None] = []  # the k-th best of the sample bounds a query from the start
        for i in range(len(ids)):
            scores = np.sort((sample @ q[i])[sample_ids != ids[i]])
            floors.append(int(scores[-k]) if len(scores) >= k else None)
        found = tree.repartition(tasks).mapInPandas(lambda it, a=ids, x=q, f=floors: _tree_batches(it, a, x, f, norm2, k), "query_id long, vec_id long, score long")
        found.write.mode("append").parquet(path)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spark.read.schema("query_id long, vec_id long, score long").parquet(path)
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
