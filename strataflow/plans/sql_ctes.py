"""DuckDB SQL oracles.

Each oracle sees only the driver's views (``events`` ...), so the trip
derivation, Silver rules, strata and features are inlined as CTEs. The SQL
is an independent statement of each operator's semantics: the Spark side is
DataFrame code, this side is plain SQL.
"""

from __future__ import annotations


def uniform_sql(key_sql: str, salt: str) -> str:
    """u(salt, key): the first 52 bits of md5(salt|key), in [0, 1)."""
    return (f"(cast(('0x' || substr(md5('{salt}' || '|' || cast({key_sql} as varchar)), 1, 13))"
            f"::bigint as double) / 4503599627370496.0)")


# Fixed values, spelled out again so that a wrong id in the library fails its oracle.
_AIRPORTS = "1, 132, 138"
_MANHATTAN = ("4, 12, 13, 24, 41, 42, 43, 45, 48, 50, 68, 74, 75, 79, 87, 88, 90, 100, 103, 104, 105, 107, 113, 114, 116, "
              "120, 125, 127, 128, 137, 140, 141, 142, 143, 144, 148, 151, 152, 153, 158, 161, 162, 163, 164, 166, 170, "
              "186, 194, 202, 209, 211, 224, 229, 230, 231, 232, 233, 234, 236, 237, 238, 239, 243, 244, 246, 249, 261, 262, 263")


TRIP_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
             "RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, "
             "mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, "
             "airport_fee")

# trips(event_id + 19 columns) derived from events
TRIPS = f"""
ev AS (
  SELECT event_id AS id, value AS v,
         CAST(try_cast(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS DOUBLE) AS k,
         CASE WHEN event_id % 67 = 0 THEN ts - to_seconds(31536000) ELSE ts END AS pickup
  FROM events),
ev2 AS (
  SELECT *, hour(pickup) AS h,
         CASE WHEN id % 101 = 0 THEN NULL ELSE (id * 7) % 265 + 1 END AS pu,
         CASE WHEN id % 59 = 0 THEN NULL
              WHEN {uniform_sql('id', 'pay')} <
                   (CASE WHEN v > 60 THEN 0.95::DOUBLE WHEN hour(pickup) < 8 THEN 0.35::DOUBLE ELSE 0.8::DOUBLE END)
              THEN 1 ELSE 2 END AS pay,
         CASE WHEN id % 53 = 0 THEN -5.0::DOUBLE ELSE 3.0::DOUBLE + 0.5::DOUBLE * v + 0.25::DOUBLE * k END AS fare
  FROM ev),
ev3 AS (
  SELECT *,
    CASE WHEN id % 31 = 0 THEN NULL WHEN h BETWEEN 16 AND 19 THEN 2.5::DOUBLE
         WHEN h >= 20 OR h < 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS extra_,
    CASE WHEN id % 37 = 0 THEN NULL ELSE 0.5::DOUBLE END AS mta_,
    CASE WHEN id % 41 = 0 THEN NULL WHEN pu IN ({_AIRPORTS}) THEN 6.94::DOUBLE ELSE 0.0::DOUBLE END AS tolls_,
    CASE WHEN id % 43 = 0 THEN NULL ELSE 1.0::DOUBLE END AS impr_,
    CASE WHEN id % 29 = 0 THEN NULL WHEN pu % 2 = 0 THEN 2.5::DOUBLE ELSE 0.0::DOUBLE END AS cong_,
    CASE WHEN pay = 1 THEN 0.2::DOUBLE * fare ELSE 0.0::DOUBLE END AS tip_
  FROM ev2),
trips AS (
  SELECT id AS event_id,
    CAST(id % 2 + 1 AS BIGINT) AS VendorID,
    pickup AS tpep_pickup_datetime,
    CASE WHEN id % 50 = 0 THEN pickup - to_seconds(60)
         ELSE pickup + to_seconds(CAST(floor(v * 60.0) AS BIGINT)) END AS tpep_dropoff_datetime,
    CASE WHEN id % 8 = 7 THEN NULL ELSE CAST(id % 8 AS DOUBLE) END AS passenger_count,
    CASE WHEN id % 97 = 0 THEN 250.0::DOUBLE ELSE k / 2.0::DOUBLE END AS trip_distance,
    CASE WHEN id % 40 = 0 THEN 99.0::DOUBLE WHEN id % 40 = 1 THEN NULL ELSE 1.0::DOUBLE END AS RatecodeID,
    'N' AS store_and_fwd_flag,
    CAST(pu AS BIGINT) AS PULocationID,
    CAST((id * 11) % 265 + 1 AS BIGINT) AS DOLocationID,
    CAST(pay AS BIGINT) AS payment_type,
    fare AS fare_amount, extra_ AS extra, mta_ AS mta_tax, tip_ AS tip_amount, tolls_ AS tolls_amount,
    impr_ AS improvement_surcharge,
    coalesce(fare, 0.0::DOUBLE) + coalesce(tip_, 0.0::DOUBLE) + coalesce(extra_, 0.0::DOUBLE)
      + coalesce(mta_, 0.0::DOUBLE) + coalesce(tolls_, 0.0::DOUBLE) + coalesce(impr_, 0.0::DOUBLE)
      + coalesce(cong_, 0.0::DOUBLE) AS total_amount,
    cong_ AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS airport_fee
  FROM ev3)"""

SILVER_PRED = """fare_amount > 0 AND trip_distance > 0 AND trip_distance < 200
    AND tpep_pickup_datetime < tpep_dropoff_datetime
    AND (RatecodeID IS NULL OR RatecodeID <> 99)
    AND PULocationID IS NOT NULL AND payment_type IS NOT NULL
    AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01 00:00:00'
    AND tpep_pickup_datetime < TIMESTAMP '2025-01-01 00:00:00'"""

# silver + strata
STRATA = TRIPS + f""",
silver AS (SELECT * FROM trips WHERE {SILVER_PRED}),
strata AS (
  SELECT *, day_type || '|' || pickup_zone || '|' || pay_class AS stratum FROM (
    SELECT *,
      CASE WHEN dayofweek(tpep_pickup_datetime) + 1 IN (1, 7) THEN 'weekend' ELSE 'weekday' END AS day_type,
      CASE WHEN PULocationID IN ({_AIRPORTS}) THEN 'airport'
           WHEN PULocationID IN ({_MANHATTAN}) THEN 'manhattan'
           ELSE 'other' END AS pickup_zone,
      CASE WHEN payment_type IN (1) THEN 'card' ELSE 'noncard' END AS pay_class
    FROM silver))"""

# features + null fill on silver, then the prepared filter
PREPARED = STRATA + """,
featured AS (
  SELECT * REPLACE (
      coalesce(passenger_count, 1.0::DOUBLE) AS passenger_count,
      coalesce(congestion_surcharge, 0.0::DOUBLE) AS congestion_surcharge,
      coalesce(extra, 0.0::DOUBLE) AS extra,
      coalesce(mta_tax, 0.0::DOUBLE) AS mta_tax,
      coalesce(tolls_amount, 0.0::DOUBLE) AS tolls_amount,
      coalesce(improvement_surcharge, 0.0::DOUBLE) AS improvement_surcharge),
    date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE AS trip_duration_min,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dow
  FROM strata),
prepared AS (
  SELECT * FROM featured
  WHERE trip_duration_min > 0 AND trip_duration_min < 180 AND fare_amount < 500
    AND passenger_count BETWEEN 1 AND 6)"""


def with_ctes(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body
