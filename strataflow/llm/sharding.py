"""Sharding by histogram sort: shards of near-equal bytes from exact splitters.

The sort key is (hash of the text, hash of the id): equal texts lie side by
side, and a group of copies too large for one shard is cut between rows. The
splitters are found without sorting: every round counts the exact bytes that
lie below evenly spaced candidate boundaries of the still unresolved key
intervals (one aggregation over the rows of those intervals), and replaces
each interval by the candidate pair around its target, until every boundary
is within tolerance of its target. Then the rows are exchanged once.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written, without

#: Candidate boundaries per unresolved interval and round.
PROBES = 512
#: Rows whose slots are numbered by one task; a shard has as many buckets as it needs.
ROWS_PER_BUCKET = 1024
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Splitter:
    """A boundary: the first key of a shard is the first above (h1, h2)."""

    h1: int
    h2: int
    below: int


@dataclass
class _Interval:
    """Keys among which boundaries are sought: h1 in [low, high], or one h1 and h2 in [low, high]."""

    below: int
    targets: list[int]
    low: int
    high: int
    h1: int | None = None

    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // PROBES))

    def holds(self) -> Column:
        if self.h1 is None:
            return F.col("h1").between(self.low, self.high)
        return (F.col("h1") == self.h1) & F.col("h2").between(self.low, self.high)

    def probe(self) -> Column:
        """Number of the probe interval a key falls in; in decimals, as the span may exceed a long."""
        key = F.col("h1" if self.h1 is None else "h2")
        gap = key.cast("decimal(20,0)") - F.lit(self.low).cast("decimal(20,0)")
        return F.floor(gap / F.lit(self.width()).cast("decimal(20,0)")).cast("int")


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[Splitter]:
    """Boundaries of ``keys`` (h1, h2, size), refined round by round.

    Each is within ``tolerance`` shares of a mean shard of its target, or at
    the row nearest to it if single rows are larger than that. The driver
    holds at most (shards - 1) * PROBES counts in a round.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / shards
    targets = [total * i // shards for i in range(1, shards)]
    found: dict[int, Splitter] = {}
    open_ = [_Interval(0, targets, _LOW, _HIGH)]
    while open_:
        which = probe = F.lit(None).cast("int")
        for i, v in reversed(list(enumerate(open_))):
            which = F.when(v.holds(), F.lit(i)).otherwise(which)
            probe = F.when(v.holds(), v.probe()).otherwise(probe)
        counted = (keys.select("h1", "h2", "size", which.alias("which"), probe.alias("probe"))
                   .where("which is not null").groupBy("which", "probe")
                   .agg(F.sum("size").alias("size"), F.min("h1").alias("a1"), F.max("h1").alias("b1"),
                        F.min("h2").alias("a2"), F.max("h2").alias("b2")).collect())
        rows: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r["which"], r["probe"])):
            rows.setdefault(r["which"], []).append(r)
        narrower: list[_Interval] = []
        for i, v in enumerate(open_):
            below, todo = v.below, list(v.targets)
            for r in rows[i]:
                above = below + r["size"]
                inside: list[int] = []
                while todo and todo[0] <= above:
                    t = todo.pop(0)
                    # one key left: no boundary can lie inside it
                    single = r["a1"] == r["b1"] and r["a2"] == r["b2"]
                    if above - t <= slack or single and above - t <= t - below:
                        found[t] = Splitter(r["b1"], r["b2"] if v.h1 is not None or r["a1"] == r["b1"] else _HIGH, above)
                    elif t - below <= slack or single:
                        low = r["a1"], r["a2"]
                        h1, h2 = (low[0], low[1] - 1) if v.h1 is not None or r["a1"] == r["b1"] else (low[0] - 1, _HIGH)
                        found[t] = Splitter(h1, h2, below)
                    else:
                        inside.append(t)
                if inside and r["a1"] == r["b1"]:
                    narrower.append(_Interval(below, inside, r["a2"], r["b2"], r["a1"]))
                elif inside:
                    narrower.append(_Interval(below, inside, r["a1"], r["b1"]))
                below = above
        open_ = narrower
    return [found[t] for t in targets]


def _shard_of(bounds: list[Splitter]) -> Column:
    """Shards below the key: the number of boundaries under it."""
    out = F.lit(0)
    for s in bounds:
        out = out + F.when((F.col("h1") > s.h1) | (F.col("h1") == s.h1) & (F.col("h2") > s.h2), 1).otherwise(0)
    return out


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", size: Column | None = None,
          group: Column | None = None, tolerance: float = 0.002) -> DataFrame:
    """``docs`` with ``shard`` (0 .. shards - 1) and ``slot`` (gapless from 0 in each shard).

    Law ``bytes``: the summed sizes of shards differ by at most twice the
    tolerance or the largest row. ``size`` defaults to the UTF-8 bytes of the
    text (null: none) plus 16; ``group`` (default: hash of the text) is what
    keeps equal texts side by side. Input columns named shard or slot are
    replaced. Null ids and texts are keys like others. Rows that repeat both
    id and text share a key and stay in one shard. With fewer rows than
    shards some shards stay empty; an empty table gives an empty result.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 16 if size is None else size
    h1 = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if group is None else group
    keyed = without(docs, ("shard", "slot", "h1", "h2", "__bucket", "__base")).withColumns(
        {"h1": h1, "h2": F.xxhash64(F.lit("shard"), F.col(id_col))})
    keys = written(keyed.select("h1", "h2", size.alias("size")), "shard-keys")
    bounds = splitters(keys, shards, tolerance)
    number = _shard_of(bounds).cast("int")
    rows_in = {r["shard"]: r["n"] for r in keys.groupBy(number.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # looked up in a list, not branch by branch: each branch would repeat the whole shard expression in the plan
    buckets = F.element_at(F.array(*[F.lit(max(1, -(-rows_in.get(s, 0) // ROWS_PER_BUCKET))) for s in range(shards)]), F.col("shard") + 1)
    # slots follow h2, a random order: bucket by its residue, then row number in the bucket plus the rows of earlier buckets
    placed = lambda df: df.withColumn("shard", number).withColumn("__bucket", F.pmod(F.col("h2"), buckets).cast("int"))
    counts = placed(keys).groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("shard", "__bucket").orderBy("h2", "h1")
    return (placed(keyed).withColumn("slot", F.row_number().over(inside) - 1)
            .join(bases.hint("shuffle_hash"), ["shard", "__bucket"], "inner")
            .withColumn("slot", F.col("slot") + F.col("__base"))
            .drop("__bucket", "__base", "h1", "h2"))
