"""Decision trees and boosted trees by distributed histogram split search.

Columns are cut into equal-width bins once. A level of a tree is one
aggregation: rows add up to counts and sums per (node, column, bin), a table
of at most nodes x columns x bins rows, combined map-side; the driver takes
the best split of every node from it. Rows find their node by a nested CASE
over the splits, so nothing but that table is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import checkpointed

#: Gains are compared to this many digits, ties go to the first column and the lowest bin.
GAIN_DIGITS, LEAST_GAIN = 10, 1e-12


@dataclass(frozen=True)
class Bins:
    """Equal-width bins of the columns: (low, high) of each."""

    columns: tuple[str, ...]
    ranges: tuple[tuple[float, float], ...]
    bins: int

    def of(self, i: int) -> Column:
        """Bin of column i; null is -1, left of all others."""
        low, high = self.ranges[i]
        x = F.col(self.columns[i]).cast("double")
        if not high > low:
            return F.when(x.isNull(), -1).otherwise(0)
        at = F.floor((x - F.lit(low)) / F.lit(high - low) * F.lit(float(self.bins))).cast("int")
        return F.when(x.isNull(), -1).otherwise(F.least(F.greatest(at, F.lit(0)), F.lit(self.bins - 1)))

    def threshold(self, i: int, at: int) -> float:
        """Values below go left when the split is after bin ``at``."""
        low, high = self.ranges[i]
        return low + (at + 1) * (high - low) / self.bins


def fit_bins(df: DataFrame, columns: Sequence[str], bins: int = 32) -> Bins:
    x = [F.col(c).cast("double") for c in columns]
    r = df.agg(*[F.min(c).alias(f"l{i}") for i, c in enumerate(x)], *[F.max(c).alias(f"h{i}") for i, c in enumerate(x)]).first()
    return Bins(tuple(columns), tuple((r[f"l{i}"] if r[f"l{i}"] is not None else 0.0, r[f"h{i}"] if r[f"h{i}"] is not None else 0.0) for i in range(len(x))), bins)


def design(df: DataFrame, y: Column, bins: Bins, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., y, b0, b1, ...) of all rows with a response, checkpointed."""
    return checkpointed(df.select(*keep, y.cast("double").alias("y"), *[bins.of(i).alias(f"b{i}") for i in range(len(bins.columns))]).where("y is not null"))


@dataclass
class Node:
    """Node ids are 1 for the root and 2 i, 2 i + 1 for the children of i."""

    id: int
    n: int
    total: float
    weight: float
    column: int | None = None
    bin: int | None = None
    gain: float | None = None

    def value(self) -> float:
        return self.total / self.weight if self.weight else 0.0


@dataclass
class Tree:
    bins: Bins
    nodes: dict[int, Node] = field(default_factory=dict)

    def leaf(self) -> Column:
        """Leaf id of a row of the design."""
        return self._walk(1, lambda node: F.lit(node.id))

    def predict(self) -> Column:
        """Value of a row's leaf."""
        return self._walk(1, lambda node: F.lit(float(node.value())))

    def _walk(self, at: int, out) -> Column:
        node = self.nodes[at]
        if node.column is None:
            return out(node)
        return F.when(F.col(f"b{node.column}") <= node.bin, self._walk(2 * at, out)).otherwise(self._walk(2 * at + 1, out))


def _best(rows: list, least: int) -> tuple[float, int, int] | None:
    """(gain, column, bin) of the best cut of one node's histogram rows (column, bin, n, total)."""
    best = None
    for column in sorted({r["column"] for r in rows}):
        cells = sorted((r["bin"], r["n"], r["total"]) for r in rows if r["column"] == column)
        n, total = sum(c[1] for c in cells), math.fsum(c[2] for c in cells)
        left_n, left = 0, 0.0
        for at, count, part in cells[:-1]:
            left_n, left = left_n + count, left + part
            if left_n < least or n - left_n < least:
                continue
            gain = (left * left / left_n + (total - left) * (total - left) / (n - left_n) - total * total / n) / n
            key = (-round(gain, GAIN_DIGITS), column, at)
            if gain > LEAST_GAIN and (best is None or key < best[0]):
                best = (key, gain, column, at)
    return None if best is None else best[1:]


def grow(rows: DataFrame, bins: Bins, depth: int = 3, least: int = 20, y: Column | None = None, weight: Column | None = None) -> Tree:
    """A tree on the design ``rows`` for the response ``y`` (default: column y).

    The gain of a cut is the fall of the response's variance, which for a 0/1
    response is half the fall of the Gini impurity. Leaves hold the mean, or
    sum(y) / sum(weight). ``least``: rows of a leaf.
    """
    y = F.col("y") if y is None else y
    tree = Tree(bins)
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"b{i}").alias("bin")) for i in range(len(bins.columns))]))
    level = [1]
    for step in range(depth + 1):
        leaf = tree.leaf() if tree.nodes else F.lit(1)
        at = rows.select(leaf.alias("node"), y.alias("r"), (F.lit(1.0) if weight is None else weight).alias("h"), *[f"b{i}" for i in range(len(bins.columns))])
        at = at.where(F.col("node").isin(level)).select("node", "r", "h", cells.alias("cell"))
        found = at.groupBy("node", "cell.column", "cell.bin").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("total"), F.sum("h").alias("h")).collect()
        for node in level:
            mine = [r for r in found if r["node"] == node and r["column"] == 0]
            tree.nodes[node] = Node(node, sum(r["n"] for r in mine), math.fsum(r["total"] for r in mine), math.fsum(r["h"] for r in mine))
        after = []
        for node in level if step < depth else ():
            cut = _best([r for r in found if r["node"] == node], least)
            if cut:
                gain, column, at_bin = cut
                tree.nodes[node].gain, tree.nodes[node].column, tree.nodes[node].bin = gain, column, at_bin
                after += [2 * node, 2 * node + 1]
                # children's sums are known with the next level's table; until then they are leaves
                for child in after[-2:]:
                    tree.nodes[child] = Node(child, 0, 0.0, 0.0)
        if not after:
            break
        level = after
    return tree


def tree_table(df: DataFrame, tree: Tree, number: int | None = None) -> DataFrame:
    """(node, depth, column_name, threshold, gain, n, value); a leaf has no column."""
    schema = StructType([StructField("node", IntegerType()), StructField("depth", IntegerType()), StructField("column_name", StringType()), StructField("threshold", DoubleType()),
                         StructField("gain", DoubleType()), StructField("n", LongType()), StructField("value", DoubleType())])
    rows = [(i, i.bit_length() - 1, None if x.column is None else tree.bins.columns[x.column], None if x.column is None else tree.bins.threshold(x.column, x.bin), x.gain, x.n, x.value())
            for i, x in sorted(tree.nodes.items())]
    out = df.sparkSession.createDataFrame(rows, schema)
    return out if number is None else out.withColumn("tree", F.lit(number))


@dataclass
class Boosted:
    """f0 + rate * sum of trees; for the logistic loss that is the log odds."""

    loss: str
    start: float
    rate: float
    trees: list[Tree]
    losses: list[tuple[int, float]]

    def margin(self, rounds: int | None = None) -> Column:
        return sum((F.lit(self.rate) * t.predict() for t in self.trees[:rounds]), F.lit(self.start))

    def predict(self) -> Column:
        return self.margin() if self.loss == "squared" else F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def boost(rows: DataFrame, bins: Bins, rounds: int = 10, depth: int = 2, rate: float = 0.3, loss: str = "squared", least: int = 20) -> Boosted:
    """Gradient boosting on the design: each tree fits the residuals of the sum so far.

    ``squared``: residual y - f, leaves hold its mean. ``logistic`` (y is 0 or
    1): residual y - p, leaves hold the Newton step sum(y - p) / sum(p (1 - p)).
    The mean loss of the rows after each round is kept. The sum so far is
    written (checkpoint) after every round, so that a round reads one column
    instead of walking all earlier trees.
    """
    mean = rows.agg(F.avg("y")).first()[0]
    if mean is None:
        raise ValueError("no rows to fit")
    if loss == "logistic" and not 0 < mean < 1:
        raise ValueError("one class only")
    model = Boosted(loss, mean if loss == "squared" else math.log(mean / (1 - mean)), rate, [], [])
    state = rows.withColumn("f", F.lit(model.start))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("f")))
    each = (F.col("y") - F.col("f")) * (F.col("y") - F.col("f")) if loss == "squared" else F.log1p(F.exp(-F.abs("f"))) + F.greatest(F.col("f"), F.lit(0.0)) - F.col("y") * F.col("f")
    for number in range(rounds + 1):
        model.losses.append((number, state.agg(F.avg(each)).first()[0]))
        if number == rounds:
            return model
        tree = grow(state, bins, depth, least, F.col("y") - (F.col("f") if loss == "squared" else p), None if loss == "squared" else p * (F.lit(1.0) - p))
        model.trees.append(tree)
        state = checkpointed(state.withColumn("f", F.col("f") + F.lit(rate) * tree.predict()))
    return model


def losses_table(df: DataFrame, model: Boosted) -> DataFrame:
    """(loss, round, value): the mean loss of the rows after each round."""
    schema = StructType([StructField("loss", StringType()), StructField("round", IntegerType()), StructField("value", DoubleType())])
    return df.sparkSession.createDataFrame([(model.loss, i, v) for i, v in model.losses], schema)
