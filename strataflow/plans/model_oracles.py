"""DuckDB SQL of the model keys: the fits themselves, unrolled.

Each algorithm is stated again in SQL (Newton steps with Gauss-Jordan
elimination, histogram splits, Lloyd and expectation-maximisation rounds), so
a key's coefficients, splits and likelihoods are compared with an independent
computation from the same rows.
"""

from __future__ import annotations

import math

from .oracles import oracle
from .sql_ctes import PREPARED

CARD = "CASE WHEN pay_class = 'card' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def dummy(column: str, level: str) -> str:
    return f"CASE WHEN {column} = '{level}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def table(name: str, y: str, x: list[str], keep: str = "") -> str:
    """CTE with y, x0 = 1, x1, ... of the prepared rows."""
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS x{i}" for i, e in enumerate(["1.0", *x]))
    return f"{name} AS MATERIALIZED (SELECT {keep}CAST({y} AS DOUBLE) AS y, {columns} FROM prepared)"


# ---------------------------------------------------------------- regression
#: family -> (link of the mean, mu, w, r, deviance of a row)
FAMILIES = {
    "gaussian": ("mean", "eta", "1.0", "y - mu", "(y - mu) * (y - mu)"),
    "binomial": ("ln(mean / (1.0 - mean))", "1.0 / (1.0 + exp(-eta))", "mu * (1.0 - mu)", "y - mu", "-2.0 * CASE WHEN y > 0.5 THEN ln(mu) ELSE ln(1.0 - mu) END"),
    "poisson": ("ln(mean)", "exp(eta)", "mu", "y - mu", "2.0 * (CASE WHEN y > 0 THEN y * ln(y / mu) ELSE 0.0 END - (y - mu))"),
    "gamma": ("ln(mean)", "exp(eta)", "1.0", "(y - mu) / mu", "2.0 * ((y - mu) / mu - ln(y / mu))"),
}


def newton(name: str, d: int, family: str, rounds: int, ridge: float = 0.0) -> str:
    """CTEs ``{name}_b{r}`` (coefficients b0, b1, ...) and ``{name}_m{r}`` (sums at them: dev, g0, g1, ...) for r = 0..rounds over the table ``name``."""
    link, mu, w, r, dev = FAMILIES[family]
    out = [f"{name}_v AS MATERIALIZED (SELECT count(*) AS n, avg(y) AS mean, 0.0 AS v0, {', '.join(f'var_pop(x{i}) AS v{i}' for i in range(1, d))} FROM {name})",
           f"{name}_b0 AS MATERIALIZED (SELECT {link} AS b0, {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(1, d))} FROM {name}_v)"]
    for step in range(rounds + 1):
        eta = " + ".join(f"b{i} * x{i}" for i in range(d))
        sums = [f"sum(w * x{i} * x{j}) AS a{i}_{j}" for i in range(d) for j in range(d)] + [f"sum((r + w * eta) * x{i}) AS a{i}_{d}" for i in range(d)]
        sums += [f"sum(r * x{i}) AS g{i}" for i in range(d)] + [f"sum({dev}) AS dev"]
        out.append(f"""{name}_m{step} AS MATERIALIZED (SELECT {', '.join(sums)} FROM (SELECT *, {w} AS w, {r} AS r FROM (SELECT *, {mu} AS mu FROM
  (SELECT x.*, {eta} AS eta FROM {name} x, {name}_b{step}))))""")
        if step == rounds:
            break
        at = f"{name}_s{step}_0"
        out.append(f"{at} AS MATERIALIZED (SELECT {', '.join(f'a{i}_{j}' + (f' + n * {ridge!r} * v{i}' if i == j else '') + f' AS a{i}_{j}' for i in range(d) for j in range(d + 1))} FROM {name}_m{step}, {name}_v)")
        for k in range(d):
            cells = [(f"a{k}_{j} / a{k}_{k}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k}") + f" AS a{i}_{j}" for i in range(d) for j in range(k + 1, d + 1)]
            out.append(f"{name}_s{step}_{k + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM {at})")
            at = f"{name}_s{step}_{k + 1}"
        out.append(f"{name}_b{step + 1} AS MATERIALIZED (SELECT {', '.join(f'a{i}_{d} AS b{i}' for i in range(d))} FROM {at})")
    return ",\n".join(out)


def coefficients(name: str, terms: list[str], rounds: int, ridge: float, digits: int, more: str = "") -> str:
    """One row per term with its coefficient and the penalised gradient per row, in the end."""
    rows = [f"SELECT {more}{i} AS idx, '{t}' AS term, round(b{i}, {digits}) AS coefficient, round((g{i} - n * {ridge!r} * v{i} * b{i}) / n, 6) + 0.0 AS gradient "
            f"FROM {name}_b{rounds}, {name}_m{rounds}, {name}_v" for i, t in enumerate(["intercept", *terms])]
    return "\nUNION ALL\n".join(rows)


ZONES = [dummy("pickup_zone", "manhattan"), dummy("pickup_zone", "airport")]
LOGIT = ["trip_distance", "trip_duration_min", "pickup_hour", "passenger_count", *ZONES, dummy("day_type", "weekend")]
LOGIT_TERMS = ["trip_distance", "trip_duration_min", "pickup_hour", "passenger_count", "pickup_zone=manhattan", "pickup_zone=airport", "day_type=weekend"]
RIDGE = 0.001
LOGREG = PREPARED + ",\n" + table("lr", CARD, LOGIT) + ",\n" + newton("lr", 8, "binomial", 8, RIDGE)
oracle("logreg_fit", LOGREG, coefficients("lr", LOGIT_TERMS, 8, RIDGE, 4))
_P = "1.0 / (1.0 + exp(-(" + " + ".join(f"b{i} * x{i}" for i in range(8)) + ")))"
oracle("logreg_report", LOGREG, f"""SELECT count(*) AS n, round(avg(-CASE WHEN y > 0.5 THEN ln(p) ELSE ln(1.0 - p) END), 8) AS log_loss,
  count(*) FILTER (p >= 0.5 AND y > 0.5) AS tp, count(*) FILTER (p >= 0.5 AND y < 0.5) AS fp,
  count(*) FILTER (p < 0.5 AND y < 0.5) AS tn, count(*) FILTER (p < 0.5 AND y > 0.5) AS fn FROM (SELECT y, {_P} AS p FROM lr, lr_b8)""")

FARE_TERMS = ["trip_distance", "trip_duration_min", "pickup_zone=manhattan", "pickup_zone=airport"]
LINREG = PREPARED + ",\n" + table("li", "fare_amount", ["trip_distance", "trip_duration_min", *ZONES]) + ",\n" + newton("li", 5, "gaussian", 1)
oracle("linreg_fit", LINREG, coefficients("li", FARE_TERMS, 1, 0.0, 5))
_M = " + ".join(f"b{i} * x{i}" for i in range(5))
oracle("linreg_report", LINREG, f"""SELECT count(*) AS n, round(1.0 - sum((y - m) * (y - m)) / (var_pop(y) * count(*)), 6) AS r2,
  round(sqrt(avg((y - m) * (y - m))), 6) AS rmse, round(avg(abs(y - m)), 6) AS mae FROM (SELECT y, {_M} AS m FROM li, li_b1)""")

GLM_ROUNDS = 6
GLM = (PREPARED + ",\n" + table("ga", "fare_amount", ["trip_distance", "trip_duration_min", "pickup_hour"]) + ",\n" + newton("ga", 4, "gamma", GLM_ROUNDS) + ",\n"
       + table("po", "passenger_count", ["trip_distance", "trip_duration_min", "pickup_hour"]) + ",\n" + newton("po", 4, "poisson", GLM_ROUNDS))
GLM_TERMS = ["trip_distance", "trip_duration_min", "pickup_hour"]
oracle("glm_fit", GLM, coefficients("ga", GLM_TERMS, GLM_ROUNDS, 0.0, 4, "'gamma' AS family, ") + "\nUNION ALL\n" + coefficients("po", GLM_TERMS, GLM_ROUNDS, 0.0, 4, "'poisson' AS family, "))
oracle("glm_rounds", GLM, "\nUNION ALL\n".join(f"SELECT '{f}' AS family, {r} AS round, round(dev, 4) AS deviance FROM {n}_m{r}" for f, n in (("gamma", "ga"), ("poisson", "po")) for r in range(GLM_ROUNDS + 1)))

# ---------------------------------------------------------------- naive Bayes
_CATS, _NUMS = ["pickup_zone", "day_type", "pickup_hour"], ["trip_distance", "trip_duration_min"]
BAYES = PREPARED + f""",
size AS MATERIALIZED (SELECT pay_class AS label, count(*) AS n FROM prepared GROUP BY pay_class),
cells AS MATERIALIZED ({" UNION ALL ".join(f"SELECT pay_class AS label, '{c}' AS column_name, CAST({c} AS VARCHAR) AS category, count(*) AS n FROM prepared GROUP BY ALL" for c in _CATS)}),
levels AS MATERIALIZED (SELECT column_name, category, count(*) OVER (PARTITION BY column_name) AS v FROM (SELECT DISTINCT column_name, category FROM cells)),
cats AS MATERIALIZED (SELECT s.label, l.column_name, l.category, ln((coalesce(c.n, 0) + 1.0) / (s.n + 1.0 * l.v)) AS value
  FROM size s CROSS JOIN levels l LEFT JOIN cells c ON c.label = s.label AND c.column_name = l.column_name AND c.category = l.category),
nums AS MATERIALIZED ({" UNION ALL ".join(f"SELECT pay_class AS label, '{c}' AS column_name, avg({c}::DOUBLE) AS mean, var_pop({c}::DOUBLE) AS variance FROM prepared GROUP BY ALL" for c in _NUMS)}),
prior AS MATERIALIZED (SELECT label, ln((n + 1.0) / (sum(n) OVER () + 1.0 * count(*) OVER ())) AS value FROM size)"""
oracle("naive_bayes_fit", BAYES, """SELECT label, '' AS column_name, '' AS category, round(value, 6) AS value FROM prior
UNION ALL SELECT label, column_name, category, round(value, 6) FROM cats
UNION ALL SELECT label, column_name, 'mean', round(mean, 6) FROM nums
UNION ALL SELECT label, column_name, 'variance', round(variance, 6) FROM nums""")
_JOINTS = "prior.value" + "".join(f" + k_{c}.value" for c in _CATS) + "".join(
    f" - 0.5 * ln({2 * math.pi!r} * m_{c}.variance) - (p.{c} - m_{c}.mean) * (p.{c} - m_{c}.mean) / (2.0 * m_{c}.variance)" for c in _NUMS)
oracle("naive_bayes_predictions", BAYES + f""",
joints AS (SELECT event_id, p.pay_class, prior.label, {_JOINTS} AS j FROM prepared p CROSS JOIN prior
  {" ".join(f"JOIN cats k_{c} ON k_{c}.label = prior.label AND k_{c}.column_name = '{c}' AND k_{c}.category = CAST(p.{c} AS VARCHAR)" for c in _CATS)}
  {" ".join(f"JOIN nums m_{c} ON m_{c}.label = prior.label AND m_{c}.column_name = '{c}'" for c in _NUMS)}),
odds AS (SELECT event_id, pay_class, max(j) FILTER (label = 'card') - max(j) FILTER (label <> 'card') AS log_odds FROM joints GROUP BY ALL)""",
       "SELECT event_id, pay_class AS label, CASE WHEN log_odds >= 0 THEN 'card' ELSE 'noncard' END AS prediction, round(log_odds, 5) + 0.0 AS log_odds FROM odds")

# ---------------------------------------------------------------- trees
TREE_COLUMNS = ["trip_distance", "trip_duration_min", "pickup_hour", "pickup_dow", "passenger_count", "tolls_amount"]
FARE_COLUMNS = ["trip_distance", "pickup_hour", "pickup_dow", "passenger_count", "tolls_amount", "congestion_surcharge"]
BINS, LEAST = 32, 20


def binned(name: str, y: str, columns: list[str]) -> str:
    """CTEs ``{name}_lim`` and ``name`` (event_id, y, b: list of bins)."""
    lim = ", ".join(f"min({c}::DOUBLE) AS l{i}, max({c}::DOUBLE) AS h{i}" for i, c in enumerate(columns))
    cells = ", ".join(f"CASE WHEN h{i} > l{i} THEN least(greatest(CAST(floor(({c}::DOUBLE - l{i}) / (h{i} - l{i}) * {float(BINS)}) AS INTEGER), 0), {BINS - 1}) ELSE 0 END" for i, c in enumerate(columns))
    return f"""{name}_lim AS MATERIALIZED (SELECT {lim} FROM prepared),
{name} AS MATERIALIZED (SELECT event_id, CAST({y} AS DOUBLE) AS y, [{cells}] AS b FROM prepared, {name}_lim)"""


def tree(name: str, source: str, k: int, depth: int, target: str = "y", weight: str = "1.0") -> str:
    """CTEs ``{name}_s{level}`` (splits: node, f, cut_at, gain), ``{name}_r`` (source rows with their leaf), ``{name}_v`` (leaf, n, value), ``{name}_n`` (all nodes)."""
    out = [f"{name}_r0 AS MATERIALIZED (SELECT *, {target} AS r, {weight} AS h, 1 AS node FROM {source})"]
    for level in range(depth):
        out.append(f"""{name}_s{level} AS MATERIALIZED (SELECT node, f, cut_at, gain FROM (
  SELECT *, (sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) - ss * ss / nn) / nn AS gain FROM (
    SELECT node, f, cut_at, CAST(sum(n) OVER w AS DOUBLE) AS nl, sum(s) OVER w AS sl, CAST(sum(n) OVER p AS DOUBLE) AS nn, sum(s) OVER p AS ss FROM (
      SELECT node, f, cut_at, count(*) AS n, sum(r) AS s FROM (
        SELECT node, r, unnest(range(0, {k})) AS f, unnest(b) AS cut_at FROM {name}_r{level} WHERE node >= {1 << level}) GROUP BY ALL)
    WINDOW w AS (PARTITION BY node, f ORDER BY cut_at), p AS (PARTITION BY node, f))
  WHERE nl >= {LEAST} AND nn - nl >= {LEAST})
  WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 10) DESC, f, cut_at) = 1),
{name}_r{level + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN r.node WHEN r.b[s.f + 1] <= s.cut_at THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
  FROM {name}_r{level} r LEFT JOIN {name}_s{level} s ON s.node = r.node)""")
    out.append(f"{name}_v AS MATERIALIZED (SELECT node, count(*) AS n, sum(r) / sum(h) AS value FROM {name}_r{depth} GROUP BY node)")
    every = "\n  UNION ALL ".join(f"SELECT * FROM (SELECT node, sum(n) AS n, sum(s) / sum(h) AS value FROM (SELECT node, count(*) AS n, sum(r) AS s, sum(h) AS h FROM {name}_r{level} GROUP BY node) WHERE node >= {1 << level} GROUP BY node)"
                                  for level in range(depth + 1))
    splits = " UNION ALL ".join(f"SELECT * FROM {name}_s{level}" for level in range(depth))
    out.append(f"""{name}_n AS MATERIALIZED (SELECT a.node, CAST(a.n AS BIGINT) AS n, a.value, s.f, s.cut_at, s.gain FROM ({every}) a LEFT JOIN ({splits}) s ON s.node = a.node)""")
    return ",\n".join(out)


def nodes(name: str, source: str, task: str, columns: list[str]) -> str:
    named = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(columns)) + " END"
    cut = "CASE f " + " ".join(f"WHEN {i} THEN l{i} + (cut_at + 1) * (h{i} - l{i}) / {BINS}" for i in range(len(columns))) + " END"
    return f"""SELECT '{task}' AS task, node, CAST(floor(log2(node)) AS INTEGER) AS depth, {named} AS column_name, round({cut}, 6) AS threshold, round(gain, 8) AS gain, n, round(value, 6) AS value
FROM {name}_n, {source}_lim"""


TREES = PREPARED + ",\n" + binned("tc", CARD, TREE_COLUMNS) + ",\n" + tree("c", "tc", 6, 3) + ",\n" + binned("tf", "fare_amount", FARE_COLUMNS) + ",\n" + tree("f", "tf", 6, 3)
oracle("tree_fit", TREES, nodes("c", "tc", "classifier", TREE_COLUMNS) + "\nUNION ALL\n" + nodes("f", "tf", "regressor", FARE_COLUMNS))
oracle("tree_leaves", TREES, """SELECT 'classifier' AS task, event_id, node AS leaf, round(value, 6) AS value FROM c_r3 JOIN c_v USING (node)
UNION ALL SELECT 'regressor', event_id, node, round(value, 6) FROM f_r3 JOIN f_v USING (node)""")

GBT_ROUNDS, GBT_RATE = 3, 0.5


def boosted(name: str, source: str, k: int, loss: str) -> str:
    """CTEs ``{name}_f{t}``: source rows with the sum f after t rounds."""
    start = "avg(y)" if loss == "squared" else "ln(avg(y) / (1.0 - avg(y)))"
    target = "y - f" if loss == "squared" else "y - 1.0 / (1.0 + exp(-f))"
    weight = "1.0" if loss == "squared" else "(1.0 / (1.0 + exp(-f))) * (1.0 - 1.0 / (1.0 + exp(-f)))"
    out = [f"{name}_f0 AS MATERIALIZED (SELECT *, (SELECT {start} FROM {source}) AS f FROM {source})"]
    for t in range(GBT_ROUNDS):
        out.append(tree(f"{name}{t}", f"{name}_f{t}", k, 2, target, weight))
        out.append(f"{name}_f{t + 1} AS MATERIALIZED (SELECT r.event_id, r.y, r.b, r.f + {GBT_RATE} * v.value AS f FROM {name}{t}_r2 r JOIN {name}{t}_v v ON v.node = r.node)")
    return ",\n".join(out)


GBT = (PREPARED + ",\n" + binned("tc", CARD, TREE_COLUMNS) + ",\n" + boosted("gc", "tc", 6, "logistic") + ",\n"
       + binned("tf", "fare_amount", FARE_COLUMNS) + ",\n" + boosted("gf", "tf", 6, "squared"))
_LOSS = {"logistic": "ln(1.0 + exp(-abs(f))) + greatest(f, 0.0) - y * f", "squared": "(y - f) * (y - f)"}
oracle("gbt_rounds", GBT, "\nUNION ALL\n".join(f"SELECT '{loss}' AS loss, {t} AS round, round(avg({_LOSS[loss]}), 6) AS value FROM {n}_f{t}"
                                               for loss, n in (("logistic", "gc"), ("squared", "gf")) for t in range(GBT_ROUNDS + 1)))
oracle("gbt_scores", GBT, f"""SELECT 'classifier' AS task, event_id, round(1.0 / (1.0 + exp(-f)), 6) AS score FROM gc_f{GBT_ROUNDS}
UNION ALL SELECT 'regressor', event_id, round(f, 6) FROM gf_f{GBT_ROUNDS}""")

# ---------------------------------------------------------------- clusters
CLUSTER = ["trip_distance", "fare_amount", "trip_duration_min", "pickup_hour", "passenger_count"]


def scaled(name: str, columns: list[str]) -> str:
    moments = ", ".join(f"avg({c}::DOUBLE) AS m{i}, stddev_samp({c}::DOUBLE) AS s{i}" for i, c in enumerate(columns))
    z = ", ".join(f"CASE WHEN s{i} > 0 THEN ({c} - m{i}) / s{i} ELSE 0.0 END AS z{i}" for i, c in enumerate(columns))
    return f"{name} AS MATERIALIZED (SELECT event_id, {z} FROM prepared, (SELECT {moments} FROM prepared))"


BISECT_ROUNDS, BISECT_DEPTH = 4, 2
_D = len(CLUSTER)


def bisection() -> str:
    out = [scaled("z", CLUSTER), "at0 AS MATERIALIZED (SELECT *, 1 AS node FROM z)"]
    far = lambda side: " + ".join(f"(z{i} - c.{side}{i}) * (z{i} - c.{side}{i})" for i in range(_D))
    for level in range(BISECT_DEPTH):
        means, variances = (", ".join(f"{f}(z{i}) AS {p}{i}" for i in range(_D)) for f, p in (("avg", "m"), ("var_pop", "v")))
        widest = "greatest(" + ", ".join(f"round(v{i}, 9)" for i in range(_D)) + ")"
        first = "CASE " + " ".join(f"WHEN round(v{i}, 9) = {widest} THEN {i}" for i in range(_D)) + " END"
        out.append(f"c{level}_0 AS MATERIALIZED (SELECT node, {', '.join(f'm{i} - CASE WHEN j = {i} THEN sqrt(v{i}) ELSE 0.0 END AS a{i}, m{i} + CASE WHEN j = {i} THEN sqrt(v{i}) ELSE 0.0 END AS b{i}' for i in range(_D))}"
                   f" FROM (SELECT *, {first} AS j FROM (SELECT node, {means}, {variances} FROM at{level} WHERE node >= {1 << level} GROUP BY node)))")
        for r in range(BISECT_ROUNDS):
            out.append(f"""c{level}_{r + 1} AS MATERIALIZED (SELECT node, {', '.join(f'avg(z{i}) FILTER (side = 0) AS a{i}, avg(z{i}) FILTER (side = 1) AS b{i}' for i in range(_D))}
  FROM (SELECT x.*, CASE WHEN {far('a')} <= {far('b')} THEN 0 ELSE 1 END AS side FROM at{level} x JOIN c{level}_{r} c ON c.node = x.node) GROUP BY node)""")
        out.append(f"""at{level + 1} AS MATERIALIZED (SELECT x.* EXCLUDE (node), CASE WHEN c.node IS NULL THEN x.node WHEN {far('a')} <= {far('b')} THEN 2 * x.node ELSE 2 * x.node + 1 END AS node
  FROM at{level} x LEFT JOIN c{level}_{BISECT_ROUNDS} c ON c.node = x.node)""")
    centres = " UNION ALL ".join(f"SELECT {2} * node + {s} AS node, {', '.join(f'{p}{i} AS z{i}' for i in range(_D))} FROM c{level}_{BISECT_ROUNDS}" for level in range(BISECT_DEPTH) for s, p in ((0, "a"), (1, "b")))
    out.append(f"centres AS MATERIALIZED (SELECT 1 AS node, {', '.join(f'avg(z{i}) AS z{i}' for i in range(_D))} FROM z UNION ALL {centres})")
    rows = " UNION ALL ".join(f"SELECT * FROM at{level} WHERE node >= {1 << level}" for level in range(BISECT_DEPTH + 1))
    gap = " + ".join(f"(r.z{i} - c.z{i}) * (r.z{i} - c.z{i})" for i in range(_D))
    out.append(f"tree AS (SELECT node, count(*) AS n, sum({gap}) AS cost FROM ({rows}) r JOIN centres c USING (node) GROUP BY node)")
    return ",\n".join(out)


BISECT = PREPARED + ",\n" + bisection()
oracle("bisecting_nodes", BISECT, f"""SELECT node, CASE WHEN node > 1 THEN node // 2 END AS parent, CAST(floor(log2(node)) AS INTEGER) AS level, n, round(cost, 4) AS cost,
  {', '.join(f'round(z{i}, 6) + 0.0 AS z{i}' for i in range(_D))} FROM tree JOIN centres USING (node)""")
oracle("bisecting_path", BISECT, f"SELECT event_id, a.node AS level_1, b.node AS level_2 FROM at1 a JOIN at2 b USING (event_id)")

GMM_ROUNDS, GMM_K = 6, 3


def mixture() -> str:
    k = range(GMM_K)
    out = [scaled("z", ["trip_distance", "fare_amount"]),
           "g AS MATERIALIZED (SELECT avg(z0) AS m0, avg(z1) AS m1, avg(z0 * z0) - avg(z0) * avg(z0) + 1e-6 AS c00, avg(z0 * z1) - avg(z0) * avg(z1) AS c01, avg(z1 * z1) - avg(z1) * avg(z1) + 1e-6 AS c11 FROM z)",
           "e0 AS MATERIALIZED (SELECT " + ", ".join(f"{1 / GMM_K!r}::DOUBLE AS w_{a}, m0 + {(2 * a + 1 - GMM_K) / GMM_K!r} * sqrt(c00) AS m0_{a}, m1 + {(2 * a + 1 - GMM_K) / GMM_K!r} * sqrt(c11) AS m1_{a}, "
                                                  f"c00 AS c00_{a}, c01 AS c01_{a}, c11 AS c11_{a}" for a in k) + " FROM g)"]
    for t in range(GMM_ROUNDS + 1):
        dens = ", ".join(f"""ln(w_{a}) - {math.log(2 * math.pi)!r} - 0.5 * ln(c00_{a} * c11_{a} - c01_{a} * c01_{a}) - 0.5 * (c11_{a} * (z0 - m0_{a}) * (z0 - m0_{a})
    - 2.0 * c01_{a} * (z0 - m0_{a}) * (z1 - m1_{a}) + c00_{a} * (z1 - m1_{a}) * (z1 - m1_{a})) / (c00_{a} * c11_{a} - c01_{a} * c01_{a}) AS l{a}""" for a in k)
        high = "greatest(" + ", ".join(f"l{a}" for a in k) + ")"
        out.append(f"""q{t} AS MATERIALIZED (SELECT event_id, z0, z1, lp, {', '.join(f'exp(l{a} - lp) AS r{a}' for a in k)} FROM (SELECT *, {high} + ln({' + '.join(f'exp(l{a} - {high})' for a in k)}) AS lp
  FROM (SELECT event_id, z0, z1, {dens} FROM z, e{t})))""")
        if t < GMM_ROUNDS:
            m = ", ".join(f"sum(r{a}) / count(*) AS w_{a}, sum(r{a} * z0) / sum(r{a}) AS m0_{a}, sum(r{a} * z1) / sum(r{a}) AS m1_{a}, sum(r{a} * z0 * z0) / sum(r{a}) - (sum(r{a} * z0) / sum(r{a})) ** 2 + 1e-6 AS c00_{a}, "
                          f"sum(r{a} * z0 * z1) / sum(r{a}) - (sum(r{a} * z0) / sum(r{a})) * (sum(r{a} * z1) / sum(r{a})) AS c01_{a}, sum(r{a} * z1 * z1) / sum(r{a}) - (sum(r{a} * z1) / sum(r{a})) ** 2 + 1e-6 AS c11_{a}" for a in k)
            out.append(f"e{t + 1} AS MATERIALIZED (SELECT {m} FROM q{t})")
    return ",\n".join(out)


GMM = PREPARED + ",\n" + mixture()
_NAMES = {"weight": "w", "m_0": "m0", "m_1": "m1", "c_0_0": "c00", "c_0_1": "c01", "c_1_1": "c11"}
oracle("gmm_fit", GMM, "\nUNION ALL\n".join(f"SELECT {a} AS component, '{n}' AS name, round({c}_{a}, 5) + 0.0 AS value FROM e{GMM_ROUNDS}" for a in range(GMM_K) for n, c in _NAMES.items()))
oracle("gmm_rounds", GMM, "\nUNION ALL\n".join(f"SELECT {t} AS round, round(avg(lp), 6) AS log_likelihood FROM q{t}" for t in range(GMM_ROUNDS + 1)))
oracle("gmm_assign", GMM, f"SELECT event_id, {', '.join(f'round(r{a}, 5) AS r{a}' for a in range(GMM_K))}, round(r0 + r1 + r2, 9) AS total FROM q{GMM_ROUNDS}")

# ---------------------------------------------------------------- support vectors, perceptron
FAMILIES["hinge"] = ("0.0::DOUBLE", "eta", "CASE WHEN (2.0 * y - 1.0) * eta < 1.0 THEN 1.0 ELSE 0.0 END",
                     "CASE WHEN (2.0 * y - 1.0) * eta < 1.0 THEN 2.0 * y - 1.0 - eta ELSE 0.0 END", "greatest(0.0, 1.0 - (2.0 * y - 1.0) * eta) ** 2")
SVC = PREPARED + ",\n" + table("sv", CARD, LOGIT) + ",\n" + newton("sv", 8, "hinge", 10, RIDGE)
oracle("svc_fit", SVC, f"SELECT idx, term, coefficient, gradient, round(dev / n, 6) AS loss FROM ({coefficients('sv', LOGIT_TERMS, 10, RIDGE, 4)}) c, sv_m10, sv_v")

MLP_COLUMNS, MLP_ROUNDS, MLP_HIDDEN, MLP_RATE, MLP_MOMENTUM = ["trip_distance", "trip_duration_min", "pickup_hour"], 8, 3, 1.0, 0.5


def perceptron() -> str:
    d, hidden = len(MLP_COLUMNS), range(MLP_HIDDEN)
    weights = [f"i{j}_{i}" for j in hidden for i in range(d + 1)] + [f"o{j}" for j in range(MLP_HIDDEN + 1)]
    start = [math.cos(1.0 + j * (d + 1) + i) for j in hidden for i in range(d + 1)] + [0.0, *(math.cos(2.0 + j) for j in hidden)]
    out = [scaled("z", MLP_COLUMNS), f"x AS MATERIALIZED (SELECT z.*, {CARD} AS y FROM z JOIN prepared USING (event_id))",
           "w0 AS MATERIALIZED (SELECT " + ", ".join(f"{v!r}::DOUBLE AS {n}, 0.0::DOUBLE AS v_{n}" for n, v in zip(weights, start, strict=True)) + ")"]
    for t in range(MLP_ROUNDS + 1):
        h = ", ".join(f"1.0 / (1.0 + exp(-(i{j}_0 + {' + '.join(f'i{j}_{i + 1} * z{i}' for i in range(d))}))) AS h{j}" for j in hidden)
        p = "1.0 / (1.0 + exp(-(o0 + " + " + ".join(f"o{j + 1} * h{j}" for j in hidden) + ")))"
        out.append(f"s{t} AS MATERIALIZED (SELECT *, {p} AS p FROM (SELECT *, {h} FROM x, w{t}))")
        back = lambda j: f"(p - y) * o{j + 1} * h{j} * (1.0 - h{j})"
        grads = [f"avg({back(j)}{'' if i == 0 else f' * z{i - 1}'}) AS g_i{j}_{i}" for j in hidden for i in range(d + 1)] + ["avg(p - y) AS g_o0"] + [f"avg((p - y) * h{j}) AS g_o{j + 1}" for j in hidden]
        out.append(f"g{t} AS MATERIALIZED (SELECT avg(-CASE WHEN y > 0.5 THEN ln(p) ELSE ln(1.0 - p) END) AS loss, {', '.join(grads)} FROM s{t})")
        if t < MLP_ROUNDS:
            move = lambda n: f"({MLP_MOMENTUM} * v_{n} - {MLP_RATE} * g_{n})"
            out.append(f"w{t + 1} AS MATERIALIZED (SELECT {', '.join(f'{n} + {move(n)} AS {n}, {move(n)} AS v_{n}' for n in weights)} FROM w{t}, g{t})")
    return ",\n".join(out)


MLP = PREPARED + ",\n" + perceptron()
oracle("mlp_rounds", MLP, "\nUNION ALL\n".join(f"SELECT {t} AS round, round(loss, 8) AS loss FROM g{t}" for t in range(MLP_ROUNDS + 1)))
oracle("mlp_scores", MLP, f"SELECT event_id, round(p, 6) AS score FROM s{MLP_ROUNDS}")

# ---------------------------------------------------------------- graphs, topics
PIC_ROUNDS = 6
PIC = PREPARED + """,
cells AS MATERIALIZED (SELECT PULocationID AS zone, pickup_hour AS hour, count(*) AS n FROM prepared GROUP BY ALL),
once AS MATERIALIZED (SELECT a.zone || '-' || a.hour AS src, b.zone || '-' || b.hour AS dst, CAST(a.n + b.n AS DOUBLE) AS w FROM cells a JOIN cells b ON b.zone = a.zone AND b.hour = a.hour + 1),
edges AS MATERIALIZED (SELECT src, dst, w FROM once UNION ALL SELECT dst, src, w FROM once),
degree AS MATERIALIZED (SELECT src AS node, sum(w) AS degree FROM edges GROUP BY src),
p0 AS MATERIALIZED (SELECT node, degree / sum(degree) OVER () AS value FROM degree)""" + "".join(f""",
p{t + 1} AS MATERIALIZED (SELECT node, v / sum(v) OVER () AS value FROM (SELECT e.src AS node, sum(w / degree * value) AS v FROM edges e JOIN degree d ON d.node = e.src JOIN p{t} p ON p.node = e.dst GROUP BY e.src))""" for t in range(PIC_ROUNDS))
oracle("pic_values", PIC, f"SELECT node, round(value, 10) AS value, degree FROM p{PIC_ROUNDS} JOIN degree USING (node)")

TOPIC_ROUNDS, TOPICS, ALPHA, BETA = 4, 2, 1.1, 1.1


def lda() -> str:
    t = [f"t{i}" for i in range(TOPICS)]
    draw = lambda i: f"(1.0 + CAST(('0x' || substr(md5(doc || '|' || word || '|{i}'), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0)"
    out = ["counts AS MATERIALIZED (SELECT PULocationID AS doc, pickup_hour AS word, CAST(count(*) AS DOUBLE) AS n FROM prepared GROUP BY ALL)",
           "voc AS MATERIALIZED (SELECT count(DISTINCT word) AS v FROM counts)",
           f"q0 AS MATERIALIZED (SELECT doc, word, n, {', '.join(f'{c} / ({" + ".join(t)}) AS {c}' for c in t)} FROM (SELECT *, {', '.join(f'{draw(i)} AS {c}' for i, c in enumerate(t))} FROM counts))"]
    for r in range(TOPIC_ROUNDS + 1):
        each = lambda key: ", ".join(f"sum(n * {c}) AS {c}" for c in t)
        out.append(f"d{r} AS MATERIALIZED (SELECT doc, {', '.join(f'({c} + {ALPHA - 1!r}) / ({" + ".join(t)} + {TOPICS * (ALPHA - 1)!r}) AS {c}' for c in t)} FROM (SELECT doc, {each('doc')} FROM q{r} GROUP BY doc))")
        out.append(f"w{r} AS MATERIALIZED (SELECT word, {', '.join(f'({c} + {BETA - 1!r}) / (sum({c}) OVER () + v * {BETA - 1!r}) AS {c}' for c in t)} FROM (SELECT word, {each('word')} FROM q{r} GROUP BY word), voc)")
        out.append(f"x{r} AS MATERIALIZED (SELECT doc, word, n, {', '.join(f'd.{c} * w.{c} AS {c}' for c in t)} FROM counts JOIN d{r} d USING (doc) JOIN w{r} w USING (word))")
        if r < TOPIC_ROUNDS:
            out.append(f"q{r + 1} AS MATERIALIZED (SELECT doc, word, n, {', '.join(f'{c} / ({" + ".join(t)}) AS {c}' for c in t)} FROM x{r})")
    return ",\n".join(out)


LDA = PREPARED + ",\n" + lda()
_T = ", ".join(f"round(t{i}, 6) AS t{i}" for i in range(TOPICS))
oracle("lda_mixtures", LDA, f"SELECT doc, {_T} FROM d{TOPIC_ROUNDS}")
oracle("lda_topics", LDA, f"SELECT word, {_T} FROM w{TOPIC_ROUNDS}")
oracle("lda_rounds", LDA, "\nUNION ALL\n".join(f"SELECT {r} AS round, round(sum(n * ln({' + '.join(f't{i}' for i in range(TOPICS))})) / sum(n), 6) AS log_likelihood FROM x{r}" for r in range(TOPIC_ROUNDS + 1)))
