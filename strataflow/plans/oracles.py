"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

import math

from .sql_ctes import PREPARED, STRATA, TRIP_COLS, TRIPS, uniform_sql, with_ctes

ORACLES: dict[str, str] = {}


def oracle(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = with_ctes(ctes, body)


# ---------------------------------------------------------------- sources
oracle("scan_trips", TRIPS, f"SELECT event_id, {TRIP_COLS} FROM trips")
# every third week's file has no airport fee
_MONTHLY = (f"SELECT event_id, {TRIP_COLS.replace('airport_fee', '')} "
            "CASE WHEN week(tpep_pickup_datetime) % 3 <> 2 THEN airport_fee END AS airport_fee FROM trips")
oracle("scan_reconciled", TRIPS, _MONTHLY)
oracle("union_months", TRIPS, _MONTHLY)

# ---------------------------------------------------------------- quality
_null_cols = [c.strip() for c in TRIP_COLS.split(",")]
oracle("null_profile_top8", TRIPS, "SELECT column_name, null_rate FROM (\n" + "\nUNION ALL\n".join(
    f"  SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS null_rate FROM trips"
    for c in _null_cols) + "\n) ORDER BY null_rate DESC, column_name LIMIT 8")

_SILVER_COLS = f"event_id, {TRIP_COLS}"
oracle("silver_trips", STRATA, f"SELECT {_SILVER_COLS} FROM silver")

oracle("silver_funnel", TRIPS, """SELECT count(*) AS rows_in,
  CAST(coalesce(sum(CASE WHEN fare_amount > 0 AND trip_distance > 0 AND trip_distance < 200
    AND tpep_pickup_datetime < tpep_dropoff_datetime AND (RatecodeID IS NULL OR RatecodeID <> 99)
    AND PULocationID IS NOT NULL AND payment_type IS NOT NULL
    AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2025-01-01'
    THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_kept,
  CASE WHEN count(*) > 0 THEN (1.0::DOUBLE - rows_kept / count(*)) * 100.0::DOUBLE END AS discarded_pct
FROM trips""")

_RULES = [
    ("fare_positive", "fare_amount > 0"),
    ("distance_positive", "trip_distance > 0"),
    ("distance_below_200", "trip_distance < 200"),
    ("pickup_before_dropoff", "tpep_pickup_datetime < tpep_dropoff_datetime"),
    ("ratecode_not_99", "RatecodeID IS NULL OR RatecodeID <> 99"),
    ("pickup_zone_present", "PULocationID IS NOT NULL"),
    ("payment_present", "payment_type IS NOT NULL"),
    ("pickup_in_year", "tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2025-01-01'"),
]
oracle("silver_rejects", TRIPS, "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS rule_no, '{n}' AS rule, CAST(coalesce(sum(CASE WHEN ({p}) THEN 0 ELSE 1 END), 0) AS BIGINT) AS rejected FROM trips"
    for i, (n, p) in enumerate(_RULES)))

_PREP_COLS = (f"event_id, {TRIP_COLS}, day_type, pickup_zone, pay_class, stratum, "
              "trip_duration_min, pickup_hour, pickup_dow")
oracle("prepared_trips", PREPARED, f"SELECT {_PREP_COLS} FROM prepared")
oracle("trip_features", PREPARED, "SELECT event_id, trip_duration_min, pickup_hour, pickup_dow FROM featured")
oracle("imputed_trips", PREPARED, f"""SELECT event_id, {TRIP_COLS} FROM (
  SELECT * REPLACE (
      coalesce(passenger_count, 1.0::DOUBLE) AS passenger_count,
      coalesce(congestion_surcharge, 0.0::DOUBLE) AS congestion_surcharge,
      coalesce(extra, 0.0::DOUBLE) AS extra, coalesce(mta_tax, 0.0::DOUBLE) AS mta_tax,
      coalesce(tolls_amount, 0.0::DOUBLE) AS tolls_amount,
      coalesce(improvement_surcharge, 0.0::DOUBLE) AS improvement_surcharge)
  FROM silver)""")

_num = ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour", "passenger_count"]
_txt = ["pickup_zone", "day_type", "pay_class"]
oracle("describe_trips", PREPARED, "\nUNION ALL\n".join(
    [f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean,
  round(stddev_samp({c}::DOUBLE), 4) AS stddev, round(min({c}::DOUBLE), 4) AS min, round(max({c}::DOUBLE), 4) AS max,
  CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM prepared""" for c in _num]
    + [f"""SELECT '{c}' AS column_name, count({c}) AS count, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev,
  CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, min({c}) AS min_text, max({c}) AS max_text FROM prepared"""
       for c in _txt]))

oracle("class_balance", PREPARED, """SELECT pay_class, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (), 4) AS share FROM prepared GROUP BY pay_class""")

# ---------------------------------------------------------------- strata
oracle("strata_counts", STRATA, "SELECT stratum, count(*) AS n FROM strata GROUP BY stratum")
oracle("strata_shares", STRATA,
       "SELECT stratum, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM strata GROUP BY stratum")
oracle("strata_distinct", STRATA, "SELECT count(DISTINCT stratum) AS n_strata FROM strata")

# ---------------------------------------------------------------- sampling

_U_STRATA = uniform_sql("event_id", "strata:42")
_U_EXACT = uniform_sql("event_id", "exact:42")
_U_PLOT = uniform_sql("event_id", "plot:42")
_U_SPLIT = uniform_sql("event_id", "split:42")

SAMPLE = STRATA + f""",
smp AS (SELECT * FROM strata WHERE {_U_STRATA} < 0.1::DOUBLE),
validation AS (
  SELECT p.stratum, p.n_pop, coalesce(s.n_sample, 0) AS n_sample, p.share_pop,
         coalesce(s.share_sample, 0.0::DOUBLE) AS share_sample,
         abs(p.share_pop - coalesce(s.share_sample, 0.0::DOUBLE)) AS abs_err
  FROM (SELECT stratum, count(*) AS n_pop, count(*) / sum(count(*)) OVER () AS share_pop
        FROM strata GROUP BY stratum) p
  LEFT JOIN (SELECT stratum, count(*) AS n_sample, count(*) / sum(count(*)) OVER () AS share_sample
             FROM smp GROUP BY stratum) s USING (stratum))"""

oracle("stratified_sample", SAMPLE, "SELECT event_id, stratum FROM smp")
oracle("sample_validation", SAMPLE, "SELECT * FROM validation")
oracle("sample_validation_long", SAMPLE, """SELECT stratum, 'population' AS source, share_pop AS share FROM validation
UNION ALL SELECT stratum, 'sample' AS source, share_sample AS share FROM validation""")
oracle("max_deviation", SAMPLE, "SELECT max(abs_err) AS max_abs_err FROM validation")

oracle("stratified_exact", STRATA + f""",
cnt AS (SELECT stratum, count(*) AS c, sum(count(*)) OVER () AS total FROM strata GROUP BY stratum),
alloc0 AS (SELECT stratum, (1000 * c) // total AS base, (1000 * c) % total AS rem,
                  least(1000, total) - sum((1000 * c) // total) OVER () AS lft FROM cnt),
alloc AS (SELECT stratum, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum) <= lft THEN 1 ELSE 0 END AS n_i
          FROM alloc0),
ranked AS (SELECT event_id, stratum,
                  row_number() OVER (PARTITION BY stratum ORDER BY {_U_EXACT}, event_id) AS rk FROM strata)""",
       "SELECT r.event_id, r.stratum FROM ranked r JOIN alloc a USING (stratum) WHERE r.rk <= a.n_i")

oracle("plot_sample", PREPARED + """,
tot AS (SELECT count(*) AS n FROM prepared)""",
       f"SELECT event_id FROM prepared, tot WHERE {_U_PLOT} < least(1.0::DOUBLE, greatest(0.0::DOUBLE, 2500 / tot.n))")

SPLIT = PREPARED + f""",
labelled AS (SELECT *, CASE WHEN {_U_SPLIT} < 0.7::DOUBLE / 1.0::DOUBLE THEN 'train' ELSE 'test' END AS split FROM prepared)"""
oracle("train_test_split", SPLIT, "SELECT event_id, split FROM labelled")
oracle("split_balance", SPLIT, """SELECT split, count(*) AS n,
  avg(CASE WHEN pay_class = 'card' THEN 1.0 ELSE 0.0 END)::DOUBLE AS positive_share FROM labelled GROUP BY split""")

# ---------------------------------------------------------------- exploration
_HIST = ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour"]
_EDA = ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour", "passenger_count",
        "tolls_amount", "congestion_surcharge"]
_CLUS = ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour", "passenger_count"]
_BOX = ["trip_distance", "fare_amount", "trip_duration_min"]


def _long(cols, src="prepared", keep=""):
    return "\nUNION ALL\n".join(
        f"SELECT {keep}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {src}" for c in cols)


oracle("quantiles", PREPARED + f""",
long AS ({_long(_HIST)})""", """SELECT column_name, q, round(CASE q WHEN 0.25 THEN q25 WHEN 0.5 THEN q50
  WHEN 0.75 THEN q75 ELSE q99 END, 6) AS value
FROM (SELECT column_name, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
             quantile_cont(value, 0.75) AS q75, quantile_cont(value, 0.99) AS q99 FROM long GROUP BY column_name),
     (SELECT unnest([0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS q)""")

CLIPPED = PREPARED + """,
cut AS (SELECT quantile_cont(trip_distance, 0.99) AS qd, quantile_cont(fare_amount, 0.99) AS qf FROM prepared),
clipped AS (SELECT prepared.* FROM prepared, cut WHERE trip_distance < qd AND fare_amount < qf)"""
oracle("quantile_clip", CLIPPED, "SELECT event_id FROM clipped")

oracle("histogram", PREPARED + f""",
long AS ({_long(_HIST)}),
mm AS (SELECT column_name, min(value) AS lo, max(value) AS hi FROM long GROUP BY column_name),
binned AS (SELECT l.column_name, m.lo, (m.hi - m.lo) / 40.0::DOUBLE AS w,
    CAST(CASE WHEN m.hi = m.lo THEN 0 ELSE least(floor((l.value - m.lo) / (m.hi - m.lo) * 40.0::DOUBLE), 39) END AS INTEGER) AS bin
  FROM long l JOIN mm m USING (column_name) WHERE l.value IS NOT NULL)""",
       """SELECT column_name, bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi, count(*) AS n
FROM binned GROUP BY column_name, bin, lo, w""")

oracle("density_grid", CLIPPED + """,
mm AS (SELECT min(trip_distance) AS xl, max(trip_distance) AS xh, min(fare_amount) AS yl, max(fare_amount) AS yh FROM clipped)""",
       """SELECT pay_class,
  CAST(CASE WHEN xh = xl THEN 0 ELSE least(floor((trip_distance - xl) / (xh - xl) * 50.0::DOUBLE), 49) END AS INTEGER) AS x_bin,
  CAST(CASE WHEN yh = yl THEN 0 ELSE least(floor((fare_amount - yl) / (yh - yl) * 50.0::DOUBLE), 49) END AS INTEGER) AS y_bin,
  count(*) AS n
FROM clipped, mm GROUP BY ALL""")

oracle("density_by_cluster", CLIPPED + """,
mm AS (SELECT min(trip_distance) AS xl, max(trip_distance) AS xh, min(fare_amount) AS yl, max(fare_amount) AS yh FROM clipped)""",
       """SELECT CAST(hour(tpep_pickup_datetime) >= 12 AS INTEGER) AS prediction,
  CAST(CASE WHEN xh = xl THEN 0 ELSE least(floor((trip_distance - xl) / (xh - xl) * 50.0::DOUBLE), 49) END AS INTEGER) AS x_bin,
  CAST(CASE WHEN yh = yl THEN 0 ELSE least(floor((fare_amount - yl) / (yh - yl) * 50.0::DOUBLE), 49) END AS INTEGER) AS y_bin,
  count(*) AS n
FROM clipped, mm GROUP BY ALL""")

_pairs = []
for _a in _EDA:
    for _b in _EDA:
        if _a == _b:
            _pairs.append(f"SELECT '{_a}' AS col_a, '{_b}' AS col_b, CASE WHEN stddev_samp({_a}::DOUBLE) > 0 THEN 1.0::DOUBLE END AS r FROM prepared")
        else:
            _pairs.append(f"SELECT '{_a}' AS col_a, '{_b}' AS col_b, round(CASE WHEN stddev_samp({_a}::DOUBLE) > 0 AND stddev_samp({_b}::DOUBLE) > 0 "
                          f"THEN covar_samp({_a}::DOUBLE, {_b}::DOUBLE) / (stddev_samp({_a}::DOUBLE) * stddev_samp({_b}::DOUBLE)) END, 4) AS r FROM prepared")
oracle("correlation_matrix", PREPARED, "\nUNION ALL\n".join(_pairs))

oracle("zone_pay_share", PREPARED, """SELECT pickup_zone, pay_class, count(*) AS n,
  count(*) / sum(count(*)) OVER (PARTITION BY pickup_zone) AS share FROM prepared GROUP BY pickup_zone, pay_class""")

ASSIGNED = PREPARED + """,
assigned AS (SELECT *, CAST(hour(tpep_pickup_datetime) >= 12 AS INTEGER) AS prediction FROM prepared)"""
oracle("cluster_profile", ASSIGNED, """SELECT prediction, count(*) AS n,
  round(avg(trip_distance), 2) AS avg_distance, round(avg(fare_amount), 2) AS avg_fare,
  round(avg(trip_duration_min), 1) AS avg_duration_min, round(avg(pickup_hour), 1) AS avg_hour,
  round(avg(passenger_count), 2) AS avg_passengers FROM assigned GROUP BY prediction ORDER BY prediction""")

oracle("cluster_zscores", ASSIGNED + f""",
means AS (SELECT prediction, {", ".join(f"avg({c}::DOUBLE) AS {c}" for c in _CLUS)} FROM assigned GROUP BY prediction),
long AS ({_long(_CLUS, "means", "prediction, ")})""",
       """SELECT prediction, column_name, round(value, 4) AS mean,
  round(CASE WHEN stddev_pop(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_pop(value) OVER w END, 4) AS z
FROM long WINDOW w AS (PARTITION BY column_name)""")

oracle("box_stats", ASSIGNED + f""",
cut AS (SELECT {", ".join(f"quantile_cont({c}, 0.99) AS q_{c}" for c in _BOX)} FROM assigned),
long AS ({chr(10).join(("UNION ALL " if i else "") + f"SELECT prediction, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM assigned, cut WHERE {c} < q_{c}" for i, c in enumerate(_BOX))}),
qs AS (SELECT prediction, column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
              quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM qs)""",
       """SELECT prediction, column_name, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  count(*) AS n,
  round(least(min(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END), q1), 4) AS whisker_lo,
  round(greatest(max(CASE WHEN value >= lo_fence AND value <= hi_fence THEN value END), q3), 4) AS whisker_hi,
  CAST(sum(CASE WHEN value >= lo_fence AND value <= hi_fence THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM long JOIN f USING (prediction, column_name) GROUP BY prediction, column_name, q1, median, q3""")

# ---------------------------------------------------------------- features
INDEXED = PREPARED + """,
li AS (SELECT pay_class, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, pay_class) - 1 AS DOUBLE) AS label
       FROM prepared GROUP BY pay_class),
indexed AS (SELECT p.*, li.label FROM prepared p JOIN li USING (pay_class))"""
oracle("label_index", INDEXED, "SELECT pay_class, n, label FROM li")

_ZONES = ["other", "manhattan", "airport"]
_DAYS = ["weekday", "weekend"]
_OHE = ", ".join([f"CASE WHEN pickup_zone = '{z}' THEN 1.0 ELSE 0.0 END::DOUBLE AS pickup_zone_ohe_{z}" for z in _ZONES]
                 + [f"CASE WHEN day_type = '{d}' THEN 1.0 ELSE 0.0 END::DOUBLE AS day_type_ohe_{d}" for d in _DAYS])
oracle("one_hot", PREPARED, f"SELECT event_id, {_OHE} FROM prepared")
_NUMF = ["trip_distance", "fare_amount", "extra", "mta_tax", "tolls_amount", "improvement_surcharge",
         "congestion_surcharge", "passenger_count", "trip_duration_min", "pickup_hour", "pickup_dow"]
oracle("feature_matrix", PREPARED,
       f"SELECT event_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _NUMF)}, {_OHE} FROM prepared")
oracle("feature_names", PREPARED, "\nUNION ALL\n".join(
    [f"SELECT {i} AS idx, '{c}' AS name" for i, c in enumerate(_NUMF)]
    + ["SELECT CAST(10 + row_number() OVER (ORDER BY count(*) DESC, pickup_zone) AS INTEGER) AS idx, "
       "'pickup_zone_ohe_' || pickup_zone AS name FROM prepared GROUP BY pickup_zone",
       "SELECT CAST(13 + row_number() OVER (ORDER BY count(*) DESC, day_type) AS INTEGER) AS idx, "
       "'day_type_ohe_' || day_type AS name FROM prepared GROUP BY day_type"]))

SCALED = PREPARED + f""",
mom AS (SELECT {", ".join(f"avg({c}::DOUBLE) AS m_{c}, stddev_samp({c}::DOUBLE) AS s_{c}" for c in _CLUS)} FROM prepared),
scaled AS (SELECT event_id, CAST(hour(tpep_pickup_datetime) >= 12 AS INTEGER) AS prediction,
  {", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS {c}_scaled" for c in _CLUS)}
  FROM prepared, mom)"""
oracle("standard_scale", SCALED,
       f"SELECT event_id, {', '.join(f'round({c}_scaled, 6) AS {c}_scaled' for c in _CLUS)} FROM scaled")

# ---------------------------------------------------------------- metrics on a fixed score / assignment
_U_SCORE = uniform_sql("event_id", "score:42")
SCORED = INDEXED + f""",
pos AS (SELECT label AS pos FROM li WHERE pay_class = 'card'),
scored AS (SELECT i.*, round({_U_SCORE}, 2) AS score,
  CASE WHEN round({_U_SCORE}, 2) >= 0.5 THEN pos.pos ELSE 1.0 - pos.pos END AS prediction FROM indexed i, pos)"""
oracle("confusion_matrix", SCORED, """SELECT label,
  CAST(count(*) FILTER (WHERE prediction = 0.0) AS BIGINT) AS pred_0,
  CAST(count(*) FILTER (WHERE prediction = 1.0) AS BIGINT) AS pred_1
FROM scored GROUP BY label ORDER BY label""")
CLS = SCORED + """,
cells AS (SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL),
pl AS (SELECT label AS c, sum(n) AS n_true, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cells GROUP BY label),
pp AS (SELECT prediction AS c, sum(n) AS n_pred FROM cells GROUP BY prediction),
pr AS (SELECT n_true, tp, CASE WHEN coalesce(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS p,
              CASE WHEN n_true > 0 THEN tp / n_true ELSE 0.0 END AS r FROM pl LEFT JOIN pp USING (c))"""
oracle("accuracy", CLS, "SELECT round(sum(tp) / sum(n_true), 10) AS accuracy FROM pr")
oracle("weighted_f1", CLS, """SELECT round(sum(n_true * CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END) / sum(n_true), 6)
  AS weighted_f1 FROM pr""")
ROC = SCORED + """,
ps AS (SELECT score, CAST(sum(CASE WHEN label = (SELECT pos FROM pos) THEN 1 ELSE 0 END) AS BIGINT) AS pos,
              CAST(sum(CASE WHEN label = (SELECT pos FROM pos) THEN 0 ELSE 1 END) AS BIGINT) AS neg
       FROM scored GROUP BY score),
roc AS (SELECT score, pos, neg,
  CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
  CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM ps)"""
oracle("roc_curve", ROC, "SELECT score, pos, neg, tp, fp, tp / P AS tpr, fp / N AS fpr FROM roc")
oracle("auc", ROC, "SELECT round(sum(neg * (2.0 * tp - pos)) / (2.0 * sum(pos) * sum(neg)), 10) AS auc FROM roc")

_FINE = INDEXED + f""",
pos AS (SELECT label AS pos FROM li WHERE pay_class = 'card'),
fine AS (SELECT {_U_SCORE} AS s, CASE WHEN label = pos THEN 1 ELSE 0 END AS hit FROM indexed, pos)"""
oracle("auc_fine", _FINE + """,
per AS (SELECT s, CAST(sum(hit) AS BIGINT) AS p, CAST(sum(1 - hit) AS BIGINT) AS n FROM fine GROUP BY s),
cum AS (SELECT p, n, CAST(sum(p) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp FROM per)""",
       "SELECT round(sum(n * (2.0 * tp - p)) / (2.0 * sum(p) * sum(n)), 10) AS auc FROM cum")
oracle("roc_points", _FINE + """,
lim AS (SELECT min(s) AS lo, max(s) AS hi FROM fine),
per AS (SELECT least(CAST(floor((s - lo) / (hi - lo) * 25.0) AS INTEGER), 24) AS bin, sum(hit) AS p, sum(1 - hit) AS n FROM fine, lim GROUP BY ALL)""",
       """SELECT round(lo + bin * ((hi - lo) / 25), 9) AS threshold, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp,
  round(sum(p) OVER w / sum(p) OVER (), 9) AS tpr, round(sum(n) OVER w / sum(n) OVER (), 9) AS fpr
FROM per, lim WINDOW w AS (ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)""")

CSTATS = SCALED + f""",
cs AS (SELECT prediction AS cid, count(*) AS n,
  sum({" + ".join(f"{c}_scaled * {c}_scaled" for c in _CLUS)}) AS q,
  {", ".join(f"sum({c}_scaled) AS s_{c}" for c in _CLUS)} FROM scaled GROUP BY prediction),
d AS (SELECT x.event_id, x.prediction, cs.cid, cs.n,
  ({" + ".join(f"x.{c}_scaled * x.{c}_scaled" for c in _CLUS)})
   - 2.0 * ({" + ".join(f"x.{c}_scaled * cs.s_{c}" for c in _CLUS)}) / cs.n + cs.q / cs.n AS dist
  FROM scaled x, cs),
pt AS (SELECT event_id,
  max(CASE WHEN cid = prediction THEN dist * n / (n - 1.0) END) AS a,
  max(CASE WHEN cid = prediction THEN n END) AS n_own,
  min(CASE WHEN cid <> prediction THEN dist END) AS b FROM d GROUP BY event_id)"""
oracle("silhouette", CSTATS, """SELECT round(avg(CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1.0 - a / b
  WHEN a > b THEN b / a - 1.0 ELSE 0.0 END), 6) AS silhouette FROM pt""")
oracle("wssse", CSTATS, f"""SELECT round(sum({" + ".join(f"({c}_scaled - s_{c} / n) * ({c}_scaled - s_{c} / n)" for c in _CLUS)}), 4) AS wssse
FROM scaled JOIN cs ON scaled.prediction = cs.cid""")

# the direct sum over all values
oracle("kde", PREPARED + f""",
long AS ({chr(10).join(("UNION ALL " if i else "") + f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM prepared WHERE {c} IS NOT NULL" for i, c in enumerate(_HIST))}),
st AS (SELECT column_name, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, (max(v) - min(v)) / 99.0 AS step
       FROM long GROUP BY column_name),
vals AS (SELECT column_name, v, count(*) AS c FROM long GROUP BY ALL),
terms AS (SELECT column_name, i, lo + i * step AS x, n, h, c * exp(-0.5 * ((lo + i * step - v) / h) * ((lo + i * step - v) / h)) AS t
          FROM vals JOIN st USING (column_name), (SELECT unnest(range(0, 100)) AS i) g)""",
       f"""SELECT column_name, round(x, 6) AS x, round(sum(t) / (n * h * {math.sqrt(2.0 * math.pi)!r}), 4) AS density
FROM terms GROUP BY column_name, i, x, n, h""")

# models: what must hold for every row, whatever the fit
oracle("rf_predictions", SPLIT + """,
li AS (SELECT pay_class, CAST(row_number() OVER (ORDER BY count(*) DESC, pay_class) - 1 AS DOUBLE) AS label FROM prepared GROUP BY pay_class)""",
       "SELECT event_id, label, true AS sums_to_one, true AS is_argmax, true AS is_probability FROM labelled JOIN li USING (pay_class) WHERE split = 'test'")
oracle("kmeans_assign", PREPARED, "SELECT event_id, true AS is_nearest, true AS is_cluster FROM prepared")
oracle("kmeans_sweep", PREPARED, """SELECT CAST(k AS INTEGER) AS k, true AS cost_is_positive, true AS silhouette_in_range, true AS choice_is_sound
FROM (SELECT unnest(range(2, 8)) AS k) WHERE EXISTS (SELECT 1 FROM prepared)""")
oracle("feature_importance", PREPARED, "SELECT name, true AS in_range, true AS sums_to_one, true AS auc_over_70 FROM (" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS name" for c in _NUMF]
    + ["SELECT DISTINCT 'pickup_zone_ohe_' || pickup_zone FROM prepared", "SELECT DISTINCT 'day_type_ohe_' || day_type FROM prepared"]) + ")")

oracle("class_filter", PREPARED, "SELECT event_id, pay_class FROM prepared WHERE pay_class = 'card'")
oracle("cluster_means", ASSIGNED, f"""SELECT prediction, count(*) AS n,
  {", ".join(f"round(avg({c}::DOUBLE), 6) AS {c}" for c in _CLUS)} FROM assigned GROUP BY prediction""")


from . import model_oracles  # noqa: E402,F401  adds its keys
