"""Column expressions over trip rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def epoch_seconds(col: str | Column) -> Column:
    """Whole epoch seconds, floored; zone-free for ``timestamp_ntz``."""
    return F.unix_timestamp(F.col(col) if isinstance(col, str) else col)


def duration_minutes(start: str = PICKUP, end: str = DROPOFF) -> Column:
    """(floor-seconds(end) - floor-seconds(start)) / 60 (P5)."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def day_type(ts: str = PICKUP, weekend_days: Sequence[int] = C.WEEKEND_DAYS) -> Column:
    """weekend when dayofweek in weekend_days, else weekday."""
    return F.when(F.dayofweek(ts).isin(list(weekend_days)), F.lit(C.WEEKEND)).otherwise(F.lit(C.WEEKDAY))


def pickup_zone(zone_col: str = "PULocationID",
                airport_ids: Sequence[int] = C.AIRPORT_ZONE_IDS,
                manhattan_ids: Sequence[int] = C.MANHATTAN_ZONE_IDS) -> Column:
    """airport, else manhattan, else other; airport tested first."""
    z = F.col(zone_col)
    return (F.when(z.isin(list(airport_ids)), F.lit(C.AIRPORT))
             .when(z.isin(list(manhattan_ids)), F.lit(C.MANHATTAN))
             .otherwise(F.lit(C.OTHER)))


def pay_class(payment_col: str = "payment_type",
              card_codes: Sequence[int] = C.CARD_PAYMENT_CODES) -> Column:
    """card for card codes, noncard for every other code."""
    return F.when(F.col(payment_col).isin(list(card_codes)), F.lit(C.CARD)).otherwise(F.lit(C.NONCARD))


def year_range(ts: str, year: int) -> Column:
    """year(ts) == year as a half-open range, so Parquet can push it down."""
    lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(ts) >= lo) & (F.col(ts) < hi)
