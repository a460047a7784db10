"""Fixed values that define the trip domain.

These values must equal the analysed study's for the same strata and rules;
they are stated here once, in natural order.
"""

from __future__ import annotations

# --- fixed values: taxi zone ids -------------------------------------------
# Airport pickup zones (Newark, JFK, LaGuardia).
AIRPORT_ZONE_IDS = (1, 132, 138)
# Manhattan pickup zones (69 ids).
MANHATTAN_ZONE_IDS = (
    4, 12, 13, 24, 41, 42, 43, 45, 48, 50, 68, 74, 75, 79, 87, 88, 90, 100, 103, 104, 105, 107, 113, 114, 116,
    120, 125, 127, 128, 137, 140, 141, 142, 143, 144, 148, 151, 152, 153, 158, 161, 162, 163, 164, 166, 170,
    186, 194, 202, 209, 211, 224, 229, 230, 231, 232, 233, 234, 236, 237, 238, 239, 243, 244, 246, 249, 261, 262, 263,
)
# Payment code of a card payment.
CARD_PAYMENT_CODES = (1,)
# dayofweek() values counted as weekend (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = (1, 7)

# Category labels (English names for the three stratification variables).
WEEKEND, WEEKDAY = "weekend", "weekday"
AIRPORT, MANHATTAN, OTHER = "airport", "manhattan", "other"
CARD, NONCARD = "card", "noncard"

# Null fill for the model inputs.
IMPUTE_DEFAULTS = {
    "passenger_count": 1.0,
    "congestion_surcharge": 0.0,
    "extra": 0.0,
    "mta_tax": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.0,
}

# Columns that leak the label and must never be features (P10).
LEAKAGE_COLUMNS = ("payment_type", "tip_amount", "total_amount")

# Model inputs.
NUMERIC_FEATURES = (
    "trip_distance", "fare_amount", "extra", "mta_tax", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "passenger_count",
    "trip_duration_min", "pickup_hour", "pickup_dow",
)
CATEGORICAL_FEATURES = ("pickup_zone", "day_type")
CLUSTER_FEATURES = ("trip_distance", "fare_amount", "trip_duration_min", "pickup_hour", "passenger_count")
EDA_COLUMNS = ("trip_distance", "fare_amount", "trip_duration_min", "pickup_hour",
               "passenger_count", "tolls_amount", "congestion_surcharge")
HISTOGRAM_COLUMNS = ("trip_distance", "fare_amount", "trip_duration_min", "pickup_hour")
# --- end of fixed values ----------------------------------------------------
