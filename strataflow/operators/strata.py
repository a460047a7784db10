"""Stratification variables and stratum tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.trip_columns import PICKUP, day_type, pay_class, pickup_zone

STRATUM = "stratum"


def with_strata(df: DataFrame,
                airport_ids: Sequence[int] = C.AIRPORT_ZONE_IDS,
                manhattan_ids: Sequence[int] = C.MANHATTAN_ZONE_IDS,
                card_codes: Sequence[int] = C.CARD_PAYMENT_CODES,
                weekend_days: Sequence[int] = C.WEEKEND_DAYS) -> DataFrame:
    """Add day_type, pickup_zone, pay_class and the composite stratum key.

    Pure projections: Catalyst collapses them into the scan's codegen stage
    and turns the id lists into INSET lookups.
    """
    d = day_type(PICKUP, weekend_days)
    z = pickup_zone("PULocationID", airport_ids, manhattan_ids)
    p = pay_class("payment_type", card_codes)
    return df.select("*", d.alias("day_type"), z.alias("pickup_zone"), p.alias("pay_class"),
                     F.concat_ws("|", d, z, p).alias(STRATUM))


def strata_counts(df: DataFrame, key: str = STRATUM) -> DataFrame:
    """Rows and share per stratum (A2, A3). Partial aggregation before the
    shuffle, so a stratum holding a third of all rows costs one counter per
    map task, never a skewed partition."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def strata_distinct(df: DataFrame, key: str = STRATUM) -> DataFrame:
    """Number of distinct strata (A1)."""
    return df.agg(F.count_distinct(key).alias("n_strata"))
