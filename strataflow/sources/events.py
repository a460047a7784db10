"""Trip rows derived from the driver's ``events`` table.

The test tables hold no taxi trips, so a trip table with the canonical
schema, planted data-quality faults and a planted payment signal is derived
row by row from ``events`` (map-only; scales with the events table). The
rules are the ones written down in FIXTURES.md §2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import AIRPORT_ZONE_IDS
from ..functions.hashing import uniform_expr
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from .schema import TRIP_SCHEMA

YEAR_SECONDS = 31_536_000


# Physical schema of the driver's events table. Reading with it skips the
# footer-inference job that a schema-less read launches on every call.
EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType())])


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """event_id plus the 19 canonical trip columns.

    Written as three SQL projections (parsed once on the JVM side) rather
    than hundreds of Python Column calls; Catalyst collapses them into one
    codegen stage over the scan.
    """
    airports = ", ".join(str(i) for i in AIRPORT_ZONE_IDS)
    u_pay = uniform_expr("event_id", "pay")
    base = events.selectExpr(
        "event_id", "value AS _v",
        "CAST(try_cast(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS DOUBLE) AS _k",
        f"CASE WHEN event_id % 67 = 0 THEN timestampadd(SECOND, -{YEAR_SECONDS}, ts) ELSE ts END"
        " AS tpep_pickup_datetime")
    step1 = base.selectExpr(
        "event_id", "_v", "_k", "tpep_pickup_datetime",
        "CASE WHEN event_id % 50 = 0 THEN timestampadd(SECOND, -60, tpep_pickup_datetime)"
        " ELSE timestampadd(SECOND, floor(_v * 60.0D), tpep_pickup_datetime) END AS tpep_dropoff_datetime",
        "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS BIGINT) ELSE (event_id * 7) % 265 + 1 END AS PULocationID",
        "CASE WHEN event_id % 59 = 0 THEN CAST(NULL AS BIGINT)"
        f" WHEN {u_pay} < (CASE WHEN _v > 60 THEN 0.95D WHEN hour(tpep_pickup_datetime) < 8 THEN 0.35D ELSE 0.8D END)"
        " THEN CAST(1 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS payment_type",
        "CASE WHEN event_id % 53 = 0 THEN -5.0D ELSE 3.0D + 0.5D * _v + 0.25D * _k END AS fare_amount",
        "CASE WHEN event_id % 31 = 0 THEN CAST(NULL AS DOUBLE)"
        " WHEN hour(tpep_pickup_datetime) BETWEEN 16 AND 19 THEN 2.5D"
        " WHEN hour(tpep_pickup_datetime) >= 20 OR hour(tpep_pickup_datetime) < 6 THEN 1.0D ELSE 0.0D END AS extra")
    step2 = step1.selectExpr(
        "*",
        "CASE WHEN event_id % 37 = 0 THEN CAST(NULL AS DOUBLE) ELSE 0.5D END AS mta_tax",
        f"CASE WHEN event_id % 41 = 0 THEN CAST(NULL AS DOUBLE) WHEN PULocationID IN ({airports}) THEN 6.94D"
        " ELSE 0.0D END AS tolls_amount",
        "CASE WHEN event_id % 43 = 0 THEN CAST(NULL AS DOUBLE) ELSE 1.0D END AS improvement_surcharge",
        "CASE WHEN event_id % 29 = 0 THEN CAST(NULL AS DOUBLE) WHEN PULocationID % 2 = 0 THEN 2.5D"
        " ELSE 0.0D END AS congestion_surcharge",
        "CASE WHEN payment_type = 1 THEN 0.2D * fare_amount ELSE 0.0D END AS tip_amount")
    total = " + ".join(f"coalesce({c}, 0.0D)" for c in (
        "fare_amount", "tip_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge",
        "congestion_surcharge"))
    out = step2.selectExpr(
        "*", f"{total} AS total_amount",
        "event_id % 2 + 1 AS VendorID",
        "CASE WHEN event_id % 8 = 7 THEN CAST(NULL AS DOUBLE) ELSE CAST(event_id % 8 AS DOUBLE) END AS passenger_count",
        "CASE WHEN event_id % 97 = 0 THEN 250.0D ELSE _k / 2.0D END AS trip_distance",
        "CASE WHEN event_id % 40 = 0 THEN 99.0D WHEN event_id % 40 = 1 THEN CAST(NULL AS DOUBLE)"
        " ELSE 1.0D END AS RatecodeID",
        "'N' AS store_and_fwd_flag",
        "(event_id * 11) % 265 + 1 AS DOLocationID",
        "CAST(NULL AS DOUBLE) AS airport_fee")
    typed = out.selectExpr("event_id", *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                                         for f in TRIP_SCHEMA.fields])
    # Emit each derived row through a one-row generator. Catalyst pushes
    # filters through projections by inlining the projected expressions, so
    # the Silver rules would re-evaluate the derivation (measured: the pickup
    # expression 21 times, the md5 twice per row; ~40% of a prepared pass at
    # 10M rows, and a much larger generated method to compile). Filters on
    # generated columns stay above the generator, so each derived column is
    # computed once. Trip files read with `read_trips` need none of this:
    # there the same filters reach the Parquet scan.
    return typed.select(F.inline(F.array(F.struct(*[F.col(c) for c in typed.columns]))))


def load_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of one scale-factor folder, keyed by ``event_id``."""
    return trips_from_events(read_table(spark, sf_dir, "events", EVENTS_SCHEMA))
