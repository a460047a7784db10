"""Profiling and quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.trip_columns import DROPOFF, PICKUP, year_range


# ---------------------------------------------------------------- rules
def silver_rules(year: int = 2024) -> dict[str, Column]:
    """Silver quality rules F1-F8 as named Columns, in order.

    A null operand makes a comparison null, which rejects the row; only the
    rate-code rule keeps nulls. The year rule is a half-open timestamp range
    so it pushes into the Parquet scan.
    """
    return {
        "fare_positive": F.col("fare_amount") > 0,
        "distance_positive": F.col("trip_distance") > 0,
        "distance_below_200": F.col("trip_distance") < 200,
        "pickup_before_dropoff": F.col(PICKUP) < F.col(DROPOFF),
        "ratecode_not_99": F.col("RatecodeID").isNull() | (F.col("RatecodeID") != 99),
        "pickup_zone_present": F.col("PULocationID").isNotNull(),
        "payment_present": F.col("payment_type").isNotNull(),
        "pickup_in_year": year_range(PICKUP, year),
    }


def prepared_rules(max_minutes: float = 180.0, max_fare: float = 500.0,
                   pax_range: tuple[float, float] = (1, 6)) -> dict[str, Column]:
    """Rules F9-F11, applied after features and null fill."""
    d = F.col("trip_duration_min")
    return {
        "duration_in_range": (d > 0) & (d < max_minutes),
        "fare_below_max": F.col("fare_amount") < max_fare,
        "passengers_in_range": F.col("passenger_count").between(pax_range[0], pax_range[1]),
    }


def _all(rules: Mapping[str, Column]) -> Column:
    cond = None
    for c in rules.values():
        cond = c if cond is None else (cond & c)
    return cond if cond is not None else F.lit(True)


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.filter(_all(rules))


def silver(df: DataFrame, rules: Mapping[str, Column] | None = None, year: int = 2024) -> DataFrame:
    """Silver layer: every F1-F8 rule holds (null counts as failing)."""
    return apply_rules(df, rules if rules is not None else silver_rules(year))


# ---------------------------------------------------------------- profiling
def rule_funnel(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows in, rows kept, percent discarded, in one pass."""
    rules = rules if rules is not None else silver_rules()
    kept = F.sum(F.when(_all(rules), 1).otherwise(0))
    agg = df.agg(F.count(F.lit(1)).alias("rows_in"), F.coalesce(kept, F.lit(0)).cast("long").alias("rows_kept"))
    return agg.select(
        "rows_in", "rows_kept",
        F.when(F.col("rows_in") > 0,
               (F.lit(1.0) - F.col("rows_kept") / F.col("rows_in")) * F.lit(100.0)).alias("discarded_pct"))


def rule_rejects(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows failing each rule (false or null), all rules in one scan (Q6)."""
    rules = rules if rules is not None else silver_rules()
    names = list(rules)
    agg = df.agg(*[F.coalesce(F.sum(F.when(c, 0).otherwise(1)), F.lit(0)).cast("long").alias(f"r{i}")
                   for i, c in enumerate(rules.values())])
    pairs = [F.struct(F.lit(i + 1).alias("rule_no"), F.lit(n).alias("rule"), F.col(f"r{i}").alias("rejected"))
             for i, n in enumerate(names)]
    return agg.select(F.inline(F.array(*pairs)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, top: int | None = 8,
                 digits: int = 4) -> DataFrame:
    """Null rate of every column in one pass, long form, highest first (Q1-Q2).

    Ties are broken by column name so the top-k is deterministic.
    """
    cols = list(cols) if cols is not None else df.columns
    agg = df.agg(*[F.round(F.avg(F.col(f"`{c}`").isNull().cast("double")), digits).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    long = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_rate")) for i, c in enumerate(cols)])))
    ordered = long.orderBy(F.col("null_rate").desc(), F.col("column_name"))
    return ordered.limit(top) if top else ordered


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count / mean / sample stddev / min / max per column, one pass (Q3).

    Numeric columns fill ``min``/``max`` (double); string columns fill
    ``min_text``/``max_text`` and have null mean and stddev, like describe().
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(cols):
        col = F.col(c)
        numeric = isinstance(fields[c], NumericType)
        aggs += [F.count(col).alias(f"n{i}")]
        if numeric:
            x = col.cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
            rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                                 F.lit(None).cast("string").alias("min_text"),
                                 F.lit(None).cast("string").alias("max_text")))
        else:
            x = col.cast("string")
            aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
            rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                                 F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("stddev"),
                                 F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"),
                                 F.col(f"lo{i}").alias("min_text"), F.col(f"hi{i}").alias("max_text")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, col: str, by: Sequence[str] = (), digits: int | None = 4) -> DataFrame:
    """Count and share of each class, optionally within groups ``by``.

    The share denominator is a window over the aggregated (tiny) table.
    """
    by = list(by)
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    share = F.col("n") / F.sum("n").over(w)
    return counts.withColumn("share", F.round(share, digits) if digits is not None else share)


def class_filter(df: DataFrame, col: str, value) -> DataFrame:
    """Keep one class."""
    return df.filter(F.col(col) == F.lit(value))


# ---------------------------------------------------------------- one-pass population summary
def population_summary(df: DataFrame, rules: Mapping[str, Column], key: Column,
                       cols: Sequence[str] | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """One scan of D → a table of at most (#strata + 1) rows holding, per
    stratum of the kept rows (and one null-stratum row for rejected rows):
    the row count, every column's null count and every rule's failure count.

    The null profile (Q1-Q2), the funnel (Q5), per-rule rejections (Q6) and
    the stratum counts (A2) all derive from it, so a study reads D once for
    all four instead of once each.
    """
    cols = list(cols) if cols is not None else df.columns
    kept = F.coalesce(_all(rules), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"null_{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(F.when(c, 0).otherwise(1)).alias(f"fail_{i}") for i, c in enumerate(rules.values())]
    summary = df.groupBy(F.when(kept, key).alias("stratum")).agg(*aggs)
    return summary, cols, list(rules)


def null_profile_from_summary(summary: DataFrame, cols: Sequence[str], top: int | None = 8,
                              digits: int = 4) -> DataFrame:
    tot = summary.agg(F.sum("n").alias("n"), *[F.sum(f"null_{i}").alias(f"null_{i}") for i in range(len(cols))])
    long = tot.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.round(F.col(f"null_{i}") / F.col("n"), digits).alias("null_rate"))
        for i, c in enumerate(cols)])))
    ordered = long.orderBy(F.col("null_rate").desc(), F.col("column_name"))
    return ordered.limit(top) if top else ordered


def funnel_from_summary(summary: DataFrame) -> DataFrame:
    agg = summary.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in"),
                      F.coalesce(F.sum(F.when(F.col("stratum").isNotNull(), F.col("n"))), F.lit(0))
                      .cast("long").alias("rows_kept"))
    return agg.select("rows_in", "rows_kept",
                      F.when(F.col("rows_in") > 0, (F.lit(1.0) - F.col("rows_kept") / F.col("rows_in"))
                             * F.lit(100.0)).alias("discarded_pct"))


def rejects_from_summary(summary: DataFrame, rule_names: Sequence[str]) -> DataFrame:
    agg = summary.agg(*[F.coalesce(F.sum(f"fail_{i}"), F.lit(0)).cast("long").alias(f"r{i}")
                        for i in range(len(rule_names))])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("rule_no"), F.lit(n).alias("rule"), F.col(f"r{i}").alias("rejected"))
        for i, n in enumerate(rule_names)])))


def strata_from_summary(summary: DataFrame) -> DataFrame:
    kept = summary.filter(F.col("stratum").isNotNull()).select("stratum", "n")
    return kept.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
