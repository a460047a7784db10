"""Links between sets that share a list (of a signature, a band), with fewer rows than members from each list.

Per list the comparisons first go through one centre. Lists with members that
are still in different components afterwards are looked at again: edges
between members that may link by their sketches, fewer than members, join them
to clusters over all lists, so that each set brings its shingles once, to its
cluster. There a union-find decides which comparisons are still needed, and
only links that join two components leave the task.

Lists and clusters too large for a task are split by a second signature level:
the rarest shingles of a set, as many as any linked set must share one of
(n - ceil(0.8 n) + 1), so a template that many sets share opens no list. Only
a rare shingle's list that is still too large is compared block against
block. No linked pair of a list is lost: both ends are in one component in
the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

#: Sets link when their Jaccard similarity is at least NUM / DEN.
NUM, DEN = 80, 100
#: Members of a list, and shingles that they hold, which one task compares with each other; larger lists are split.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22
#: Bits of the table that says how common shingles are.
CELL_BITS = 22


@dataclass(frozen=True)
class Prune:
    """What sketches say. ``near``: whether the sets a and b (columns n_a, s_a, n_b, s_b) may link. ``among``: from (i, sizes, sketches as
    rows, other members) those of the others that may link with i. ``dtype``: of the sketches' numbers."""

    near: Column
    among: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    dtype: type = np.int64


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * DEN >= NUM * (len(x) + len(y) - both)


def sizes_allow(i: int, n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Those of ``other`` whose sizes leave a link with i possible."""
    return other[(n[other] * DEN >= n[i] * NUM) & (n[i] * DEN >= n[other] * NUM)]


def _partners(mine: np.ndarray, i: int) -> np.ndarray:
    """Members that i is compared with: later ones in a block, those of the second block across two."""
    return np.arange(i + 1, len(mine)) if mine[0] == mine[-1] else np.flatnonzero(mine != mine[0])


def _blocks(batches: Iterable[pa.RecordBatch], solved: Callable[[tuple, list[tuple]], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``solved`` of each run of rows with equal (gid, one, two)."""
    now, rows = None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r[:3] != now and rows:
                yield solved(now, rows)
                rows = []
            now = r[:3]
            rows.append(r[3:])
    if rows:
        yield solved(now, rows)


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def edge_batches(batches: Iterable[pa.RecordBatch], prune: Callable, dtype: type) -> Iterator[pa.RecordBatch]:
    """Rows (gid, one, two, mine, set_id, n, label, sketch) of lists in one block -> edges (a, b) that join members that may link: fewer than members."""
    def solved(_: tuple, rows: list[tuple]) -> pa.RecordBatch:
        ids, n, label = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3))
        bits, tree = np.array([r[4] for r in rows], dtype=dtype), np.arange(len(rows))
        a, b = [], []
        for i in range(len(rows)):
            other = np.arange(i + 1, len(rows))
            other = prune(i, n, bits, sizes_allow(i, n, other[(label[other] != label[i]) & (tree[other] != tree[i])]))
            if len(other):
                trees, first = np.unique(tree[other], return_index=True)
                a += [ids[i]] * len(first)
                b += ids[other[first]].tolist()
                tree[np.isin(tree, trees)] = tree[i]
        return _pairs(a, b)

    yield from _blocks(batches, solved)


def flag_batches(batches: Iterable[pa.RecordBatch], prune: Callable, dtype: type) -> Iterator[pa.RecordBatch]:
    """Rows as above, sorted by block -> the members that may link with one of another component."""
    def solved(block: tuple, rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        mine, ids, n, label = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
        bits, flag = np.array([r[4] for r in rows], dtype=dtype), np.zeros(len(rows), bool)
        for i in np.flatnonzero(mine == mine[0]):
            other = _partners(mine, i)
            other = prune(i, n, bits, sizes_allow(i, n, other[label[other] != label[i]]))
            if len(other):
                flag[i] = flag[other] = True
        named = [pa.array(np.full(flag.sum(), x), pa.int64()) for x in block]
        return pa.RecordBatch.from_arrays([*named, *(pa.array(x[flag]) for x in (mine, ids, label))], names=["gid", "one", "two", "mine", "set_id", "label"])

    yield from _blocks(batches, solved)


def forest_batches(batches: Iterable[pa.RecordBatch], sketch: Callable[[list[np.ndarray]], np.ndarray], prune: Callable) -> Iterator[pa.RecordBatch]:
    """Rows (gid, one, two, mine, set_id, label, shingles) sorted by block -> verified links, each of which joins two components."""
    def solved(_: tuple, rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        mine = np.array([r[0] for r in rows])
        held = [np.frombuffer(r[3], np.uint64) for r in rows]
        n, bits = np.array([len(x) for x in held]), sketch(held)
        group = np.unique([r[2] for r in rows], return_inverse=True)[1]
        a, b = [], []
        for i in np.flatnonzero(mine == mine[0]):
            other = _partners(mine, i)
            for j in prune(i, n, bits, sizes_allow(i, n, other[group[other] != group[i]])).tolist():
                if group[i] != group[j] and linked(held[i], held[j]):
                    group[group == group[j]] = group[i]
                    a.append(rows[i][1])
                    b.append(rows[j][1])
        return _pairs(a, b)

    yield from _blocks(batches, solved)


def _verify_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, shingles of a, shingles of b) -> the pairs that link."""
    for batch in batches:
        keep = [linked(*(np.frombuffer(v.as_py(), np.uint64) for v in pair)) for pair in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_id, shingles) -> (shingle, n): added up over a batch before they leave the task."""
    for batch in batches:
        found, n = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in batch.column(1)] or [np.empty(0, np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["shingle", "n"])


def _rare_batches(batches: Iterable[pa.RecordBatch], common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(set_id, shingles) -> (gid, set_id): of the rarest shingles that a linked set must share one of, those that others may hold."""
    for batch in batches:
        out, who = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for set_id, held in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = np.frombuffer(held.as_py(), np.uint64)
            first = x[np.lexsort((x, common[_cells(x)]))[:len(x) + len(x) * NUM // -DEN + 1]]
            first = first[common[_cells(first)] > 0]
            out.append(first.view(np.int64))
            who.append(np.full(len(first), set_id))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(who))], names=["gid", "set_id"])


def _commonness(hot: DataFrame) -> np.ndarray:
    """How common shingles are among the sets: by their leading bits the logarithm of the largest number of sets that hold one; 0: one set.

    A table of 2**CELL_BITS bytes, however many shingles there are. It only
    orders them: sharing a cell makes a shingle look more common than it is.
    """
    counts = hot.select("set_id", "shingles").mapInArrow(_count_batches, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1")
    cells = counts.groupBy(F.shiftrightunsigned("shingle", 64 - CELL_BITS).alias("cell")).agg(F.floor(F.log2(F.max("n"))).cast("int").alias("rank")).toPandas()
    out = np.zeros(1 << CELL_BITS, np.uint8)
    out[cells["cell"].to_numpy(np.int64)] = cells["rank"].to_numpy(np.uint8)
    return out


def links_of_lists(members: DataFrame, involved: DataFrame, held: DataFrame, prune: Prune, sketch: Callable[[list[np.ndarray]], np.ndarray],
                   components: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) after which any two sets that share a list and link are in one component.

    ``members``: (gid, set_id), a list's sets once each; ``involved``: (set_id,
    n, sketch); ``held``: (set_id, shingles); ``sketch`` makes the sketches of
    sets that a task holds; ``components`` gives (node, label) for links.
    """
    side = lambda x: involved.select(F.col("set_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    sizes = f"n_a * {DEN} >= n_b * {NUM} and n_b * {DEN} >= n_a * {NUM}"
    among, dtype = prune.among, prune.dtype

    def compared(pairs: DataFrame) -> DataFrame:
        near = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(sizes).where(prune.near)
        one, two = (held.select(F.col("set_id").alias(x), F.col("shingles").alias(f"of_{x}")) for x in "ab")
        joined = near.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b")
        return written(joined.mapInArrow(_verify_batches, "a long, b long"), "links")

    def sized(m: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(m / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int").alias("blocks")

    def apart(lists: DataFrame) -> DataFrame:
        """Members of lists that span several components: (gid, set_id, label, n, sketch, blocks)."""
        known = lists.join(involved, "set_id").join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
        wide = known.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"))
        wide = wide.where("low <> high").select("gid", sized(F.col("m"), F.col("all")))
        return written(known.join(wide, "gid").select("gid", "set_id", "label", "n", "sketch", "blocks"), "apart")

    at = ["gid", "one", "two"]

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows in blocks (and blocks against blocks where a list has several), sorted by block."""
        mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("long")
        rows = rows.withColumn("mine", mine).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = rows.select("gid", F.least("mine", "with").alias("one"), F.greatest("mine", "with").alias("two"), "mine", "set_id", "n", "label", "sketch")
        return rows.repartition(*at).sortWithinPartitions(*at)

    def forest(rows: DataFrame) -> DataFrame:
        """Links inside blocks from rows (gid, one, two, mine, set_id, label)."""
        return (rows.join(held, "set_id").select(*at, "mine", "set_id", "label", "shingles").repartition(*at).sortWithinPartitions(*at)
                .mapInArrow(lambda it: forest_batches(it, sketch, among), "a long, b long"))

    def clusters(rows: DataFrame) -> DataFrame:
        """(gid, set_id, label, blocks): members of lists that may link, by the cluster they form over all lists."""
        edges = written(dealt(rows).mapInArrow(lambda it: edge_batches(it, among, dtype), "a long, b long").distinct(), "edges")
        cluster = components(edges).select(F.col("label").alias("gid"), F.col("node").alias("set_id"))
        cluster = cluster.join(rows.groupBy("set_id").agg(F.first("n").alias("n"), F.first("label").alias("label")), "set_id")
        size = cluster.groupBy("gid").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all")).select("gid", sized(F.col("m"), F.col("all")))
        return written(cluster.join(size, "gid"), "clusters")

    # through one centre per list
    centre = members.groupBy("gid").agg(F.min("set_id").alias("a"))
    links = compared(members.join(centre, "gid").where("set_id <> a").select("a", F.col("set_id").alias("b")))
    labels = components(links).withColumnRenamed("node", "set_id")
    # members of a list that are still apart
    rows = apart(members)
    cluster = clusters(rows.where("blocks = 1"))
    zero = F.lit(0).cast("long")
    small = cluster.where("blocks = 1").select("gid", zero.alias("one"), zero.alias("two"), zero.alias("mine"), "set_id", "label")
    links = links.union(forest(small))
    large = written(rows.where("blocks > 1").select("set_id").union(cluster.where("blocks > 1").select("set_id")).distinct(), "large")
    if large.isEmpty():
        return written(links, "links")
    hot = written(held.join(large, "set_id", "left_semi").select("set_id", "shingles"), "hot")
    common = _commonness(hot)
    rare = written(hot.mapInArrow(lambda it: _rare_batches(it, common), "gid long, set_id long"), "rare")
    flagged = dealt(apart(rare)).mapInArrow(lambda it: flag_batches(it, among, dtype), "gid long, one long, two long, mine long, set_id long, label long")
    return written(links.union(forest(written(flagged, "flagged"))), "links")
