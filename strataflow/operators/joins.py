"""Joining a large table with a summary derived from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

MAX_BROADCAST_BYTES = 64 << 20


def join_summary(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Null-safe join of ``big`` with a per-group summary table ``small``: a null key is a group like others.

    The summary is materialised once (checkpoint in the shared folder) and
    counted: within ``max_broadcast_bytes`` (rows times the row width of its
    schema) it is broadcast, so the big side is never shuffled and a group
    holding a third of all rows cannot skew a reducer; beyond it the join is a
    plain shuffle join, where AQE splits skewed partitions.
    """
    small = checkpointed(small)
    width = sum(64 if f.dataType.simpleString() == "string" else 16 for f in small.schema.fields)
    keys = {c: f"_on_{c}" for c in on}
    small = small.withColumnsRenamed(keys)
    if small.count() * width <= max_broadcast_bytes:
        small = F.broadcast(small)
    cond = reduce(lambda a, b: a & b, [big[c].eqNullSafe(small[k]) for c, k in keys.items()])
    return big.join(small, cond, how).drop(*keys.values())
