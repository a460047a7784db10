"""Vector code compression over anchors-hierarchy metric trees.

Vectors of floor(256 x) integers are cut into PARTS equal parts; each position
gets a codebook of up to ENTRIES entries by Lloyd rounds in integers.

Rows go in chunks of at most PAGE to a task. Per chunk and part position the
sub-vectors become a metric tree, built middle-out: sqrt(n) anchors are taken
one by one, each the point farthest from its own anchor, stealing the points
that are nearer to it (points are only looked at where half the distance of
the anchors does not rule that out); anchors are merged in pairs of the
smallest joint ball up to a root, and each anchor's points are split in the
same way down to leaves. Every ball caches the sum and the count of its
points. The trees are written once and used by all rounds.

A round sends the codebook's entries down the trees: a ball keeps of the
candidates it inherits those that may be nearest to some point in it (by
d(pivot, entry) - d(pivot, nearest entry) <= 2 radius). A ball left with one
candidate is wholly owned: its cached sum and count go to that entry. Leaves
compare their points with the candidates left, in integers, ties to the lower
index.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterable, Iterator
from itertools import count as numbers

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import join_small_or_hot, ship_code, written
from .topk_search import usable

#: Parts of a vector, entries of a codebook, Lloyd rounds.
PARTS, ENTRIES, LLOYD = 16, 64, 2
#: Rows whose parts form a tree, points of a leaf.
PAGE, LEAF = 4096, 64
#: Integers beyond this are kept as Python integers; beyond LARGEST they count as LARGEST.
WIDE, LARGEST = 1 << 26, 1 << 60


def integers(vectors: list[list[float]], dims: int) -> np.ndarray:
    """floor(256 x) of every component as rows of ``dims`` (missing ones 0), exact, int64 or (large ones) Python integers."""
    raw = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        raw[i, :len(v)] = v
    if not len(raw) or np.abs(raw).max() < WIDE / 256:
        return np.floor(raw * 256.0).astype(np.int64)
    whole = [[max(-LARGEST, min(LARGEST, int(x) * 256 if abs(x) >= 2**53 else math.floor(x * 256.0))) for x in v] for v in raw.tolist()]
    return np.array(whole, dtype=object).reshape(raw.shape)


def gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x to those of y, exact."""
    d = x[:, None, :] - y[None, :, :]
    return (d * d).sum(axis=2)


def _reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the rows of x to y, as double."""
    d = x - y
    return np.sqrt((d * d).sum(axis=1))


def _anchors(x: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(pivot, members) of about sqrt(n) anchors over the rows of x (double)."""
    n = len(x)
    own, far = np.zeros(n, np.int64), _reach(x, x[0])
    pivots, radius = [0], [far.max()]
    for a in range(1, max(2, math.isqrt(n))):
        widest = int(np.argmax(radius))
        if radius[widest] == 0:
            break
        new = int(np.argmax(np.where(own == widest, far, -1.0)))
        apart = _reach(x[pivots], x[new])
        # a point nearer to its anchor than half the anchors' distance stays
        near = np.flatnonzero(far > apart[own] / 2)
        d = _reach(x[near], x[new])
        won = near[d < far[near]]
        robbed = np.unique(own[won])
        own[won], far[won] = a, d[d < far[near]]
        pivots.append(new)
        radius.append(far[won].max(initial=0.0))
        for b in robbed:
            radius[b] = far[own == b].max(initial=0.0)
    return [(p, np.flatnonzero(own == a)) for a, p in enumerate(pivots) if (own == a).any()]


class Ball:
    """A node: its pivot and radius, its points as a range of the tree's order, their sum, its children (none: a leaf)."""

    __slots__ = ("pivot", "radius", "first", "last", "total", "kids")

    def __init__(self, x: np.ndarray, exact: np.ndarray, points: np.ndarray, kids: tuple = ()):
        self.pivot = x[points].mean(axis=0)
        self.radius = float(_reach(x[points], self.pivot).max())
        self.first, self.last = 0, len(points)
        self.total, self.kids = exact[points].sum(axis=0), kids

    def placed(self, first: int) -> "Ball":
        """The ball with its range, and its children's, from ``first`` on."""
        todo = [(self, first)]
        while todo:
            ball, at = todo.pop()
            ball.first, ball.last = at, at + ball.last - ball.first
            for kid in ball.kids:
                todo.append((kid, at))
                at += kid.last - kid.first
        return self


def build(exact: np.ndarray) -> tuple[Ball, np.ndarray]:
    """Middle-out tree over the rows of ``exact``, and the order of the rows in it."""
    x = exact.astype(np.float64)

    def grown(points: np.ndarray) -> tuple[Ball, np.ndarray]:
        if len(points) <= LEAF or (x[points] == x[points[0]]).all():
            return Ball(x, exact, points), points
        balls = [grown(points[members]) for _, members in _anchors(x[points])]
        while len(balls) > 1:
            # the pair whose joint ball is smallest
            centre, radius = np.array([b.pivot for b, _ in balls]), np.array([b.radius for b, _ in balls])
            apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
            joint = np.maximum((apart + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
            joint[np.tril_indices(len(balls))] = np.inf
            i, j = divmod(int(np.argmin(joint)), len(balls))
            (one, its), (two, others) = balls[i], balls[j]
            balls = [b for k, b in enumerate(balls) if k not in (i, j)]
            both = np.concatenate([its, others])
            balls.append((Ball(x, exact, both, (one, two)), both))
        return balls[0]

    root, order = grown(np.arange(len(exact)))
    return root.placed(0), order


def owners(tree: Ball, exact: np.ndarray, book: np.ndarray, assign: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points (rows of ``exact`` in the tree's order) nearest to each entry, ties to the lower index; with ``assign``, each point's entry too."""
    sums, held = np.zeros(book.shape, dtype=exact.dtype), np.zeros(len(book), np.int64)
    places = book.astype(np.float64)
    slack = 1e-9 * (1.0 + float(np.abs(places).max()) + float(np.abs(tree.pivot).max()) + tree.radius)
    todo = [(tree, np.arange(len(book)))]
    while todo:
        ball, entries = todo.pop()
        far = _reach(places[entries], ball.pivot)
        entries = entries[far <= far.min() + 2 * ball.radius + slack]
        if len(entries) == 1:
            sums[entries[0]] += ball.total
            held[entries[0]] += ball.last - ball.first
            if assign is not None:
                assign[ball.first:ball.last] = entries[0]
        elif ball.kids:
            todo += [(kid, entries) for kid in ball.kids]
        else:
            points = exact[ball.first:ball.last]
            nearest = entries[np.argmin(gaps(points, book[entries]), axis=1)]
            np.add.at(sums, nearest, points)
            np.add.at(held, nearest, 1)
            if assign is not None:
                assign[ball.first:ball.last] = nearest
    return sums, held


# ---- Spark

def _tree_batches(batches: Iterable[pa.RecordBatch], dims: int, seed: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, vector) rows -> one row per chunk: its ids and labels as Arrow, its integers and trees."""
    ids, labels, vectors = [], [], []
    chunk = numbers()

    def packed() -> pa.RecordBatch:
        whole = integers(vectors, dims)
        trees = [(*build(p), p) for p in np.split(whole, PARTS, axis=1)]
        slim = np.int32 if whole.dtype == np.int64 else object
        blob = pickle.dumps([(tree, order.astype(np.int32), p[order].astype(slim)) for tree, order, p in trees], protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([next(chunk)]), pa.array([list(ids)], pa.list_(seed)), pa.array([list(labels)], pa.list_(pa.string())),
                                           pa.array([blob], pa.binary())], names=["chunk", "ids", "labels", "trees"])

    for batch in batches:
        for i, label, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids.append(i)
            labels.append(label)
            vectors.append(v)
            if len(ids) >= PAGE:
                yield packed()
                ids, labels, vectors = [], [], []
    if ids:
        yield packed()


def _trees(blob: pa.Scalar) -> list[tuple[Ball, np.ndarray, np.ndarray]]:
    """Per part: tree, order, points in that order."""
    return [(tree, order, p if p.dtype == object else p.astype(np.int64)) for tree, order, p in pickle.loads(blob.as_py())]


def _sum_batches(batches: Iterable[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Trees -> (part, entry, count, sums as decimal strings) of a chunk."""
    for batch in batches:
        for blob in batch.column(0):
            rows = []
            for p, ((tree, _, points), book) in enumerate(zip(_trees(blob), books, strict=True)):
                sums, held = owners(tree, points, book)
                rows += [(p, e, int(held[e]), [str(v) for v in sums[e].tolist()]) for e in np.flatnonzero(held).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())), strict=True)],
                                             names=["part", "entry", "n", "sums"])


def _code_batches(batches: Iterable[pa.RecordBatch], books: list[np.ndarray], seed: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(ids, labels, trees) -> (vec_id, label, code, error)."""
    for batch in batches:
        for ids, labels, blob in zip(*batch.columns, strict=True):
            codes, error = np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), dtype=object)
            for p, ((tree, order, points), book) in enumerate(zip(_trees(blob), books, strict=True)):
                entry = np.zeros(len(points), np.int64)
                owners(tree, points, book, entry)
                codes[order, p] = entry
                d = points - book[entry]
                error[order] += (d * d).sum(axis=1).astype(object)
            most = (1 << 63) - 1
            yield pa.RecordBatch.from_arrays([pa.array(ids.as_py(), seed), pa.array(labels.as_py(), pa.string()), pa.array([c.tobytes().hex() for c in codes]),
                                              pa.array([min(int(e), most) for e in error], pa.int64())], names=["vec_id", "label", "code", "error"])


def _next(book: np.ndarray, part: int, found: pd.DataFrame) -> np.ndarray:
    """Entries replaced by floor(sum / count) of their parts; unused ones stay."""
    out = [list(map(int, e)) for e in book]
    for r in found[found["part"] == part].itertuples():
        out[r.entry] = [int(s) // int(r.n) for s in r.sums]
    return _narrow(out, book.shape)


def _narrow(entries: list[list[int]], shape: tuple) -> np.ndarray:
    big = any(abs(v) >= WIDE for e in entries for v in e)
    return np.array(entries, dtype=object if big else np.int64).reshape(shape)


def books_text(books: list[np.ndarray]) -> str:
    """All entries' components by part, entry and place, comma-joined."""
    return ",".join(str(int(v)) for book in books for entry in book for v in entry)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector.

    Rows whose vector is null or holds null or non-finite components are
    dropped. A codebook starts as the parts of the ENTRIES smallest ids'
    vectors (of an id that repeats the smallest vector counts; a null id is
    the largest; fewer ids make a smaller codebook). Vectors shorter than the
    longest, and lengths that PARTS does not divide, are filled up with
    zeros. Components beyond 2^60 count as 2^60; errors beyond 2^63 - 1 are
    given as that. Repeated rows count as often as they are there. An empty
    table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    own = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                         F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    dims = own.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = max(PARTS, -(-dims // PARTS) * PARTS)
    first = own.groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy(F.asc_nulls_last("vec_id")).limit(ENTRIES).collect()
    start = integers([r["vector"] for r in first], dims)
    books = [_narrow(p.tolist(), p.shape) for p in np.split(start, PARTS, axis=1)]
    kind = own.schema["vec_id"].dataType
    seed = to_arrow_type(kind)
    trees = written(own.mapInArrow(lambda it: _tree_batches(it, dims, seed), f"chunk long, ids array<{kind.simpleString()}>, labels array<string>, trees binary"), "trees")
    for _ in range(LLOYD if len(start) else 0):
        found = trees.select("trees").mapInArrow(lambda it, b=books: _sum_batches(it, b), "part int, entry int, n long, sums array<string>")
        total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(dims // PARTS)]
        # at most PARTS x ENTRIES rows
        found = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).select("part", "entry", "n", F.array(*[f"s{i}" for i in range(dims // PARTS)]).alias("sums")).toPandas()
        books = [_next(book, p, found) for p, book in enumerate(books)]
    coded = trees.select("ids", "labels", "trees").mapInArrow(lambda it, b=books: _code_batches(it, b, seed), f"vec_id {kind.simpleString()}, label string, code string, error long")
    coded = written(coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("null"))), "codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    of_label = coded.groupBy("key").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"), F.count(F.lit(1)).alias("rows"))
    out = join_small_or_hot(coded, of_label, "key", "rows")
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(books_text(books).encode()).hexdigest()).alias("codebooks_sha256"))
