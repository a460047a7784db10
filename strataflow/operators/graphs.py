"""Power iteration clustering and topic mixtures over a sparse table of weights.

Both work on edges only: a round joins the edges with one number (or k
numbers) per node and adds up per node, combined map-side; every round's
table is checkpointed. Nothing is built for pairs that share no edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_summary
from ..session import checkpointed


# ---------------------------------------------------------------- power iteration
def power_iteration(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(node, value, degree) after ``rounds`` products with the row-normalised weights.

    ``edges``: (src, dst, weight) with positive weights, each undirected edge
    once or more (they add up); loops count once. The start is the share of a
    node in all degrees; values add up to 1 in every round. Nodes of one
    component draw together, so that values part the components (of equal
    values of different components only the start differs). Nodes without
    edges have no row.
    """
    both = edges.select("src", "dst", "weight").where("weight > 0").union(edges.where("weight > 0 and src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    degree = checkpointed(both.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("degree")))
    total = degree.agg(F.sum("degree")).first()[0]
    both = checkpointed(join_summary(both, degree.withColumnsRenamed({"node": "src", "degree": "d"}), ["src"]).select("src", "dst", (F.col("weight") / F.col("d")).alias("share")))
    values = degree.select("node", (F.col("degree") / F.lit(total)).alias("value")) if total else degree.select("node", F.lit(0.0).alias("value"))
    for _ in range(rounds if total else 0):
        near = join_summary(both, values.withColumnsRenamed({"node": "dst"}), ["dst"])
        after = checkpointed(near.groupBy(F.col("src").alias("node")).agg(F.sum(F.col("share") * F.col("value")).alias("value")))
        size = after.agg(F.sum("value")).first()[0]
        values = after.select("node", (F.col("value") / F.lit(size)).alias("value"))
    return values.join(degree, "node")


def value_clusters(values: DataFrame, k: int = 2, rounds: int = 20) -> DataFrame:
    """``values`` with ``cluster`` 0 to k - 1 by value, ascending: Lloyd rounds on the line, from evenly spaced centres; ties go to the lower centre."""
    low, high = values.agg(F.min("value"), F.max("value")).first()
    if low is None:
        return values.withColumn("cluster", F.lit(0))
    centres = [low + (high - low) * (i + 0.5) / k for i in range(k)]

    def nearest():
        at = F.lit(0)
        for i in range(1, k):
            at = F.when(F.col("value") > F.lit((centres[i - 1] + centres[i]) / 2), i).otherwise(at)
        return at

    for _ in range(rounds):
        found = {r["c"]: r["m"] for r in values.groupBy(nearest().alias("c")).agg(F.avg("value").alias("m")).collect()}    # k rows
        after = [found.get(i, c) for i, c in enumerate(centres)]
        if after == centres:
            break
        centres = after
    return values.withColumn("cluster", nearest())


# ---------------------------------------------------------------- topics
def start_weight(doc, word, topic: int):
    """Deterministic start in [1, 2): the first 32 bits of md5(doc|word|topic)."""
    return F.lit(1.0) + F.conv(F.substring(F.md5(F.concat_ws("|", doc.cast("string"), word.cast("string"), F.lit(str(topic)))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def fit_topics(counts: DataFrame, k: int = 3, rounds: int = 20, alpha: float = 1.1, beta: float = 1.1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Latent Dirichlet allocation by expectation maximisation (maximum a posteriori) over (doc, word, n).

    An edge's share of topic t is in proportion to (N[doc, t] + alpha - 1)
    (N[word, t] + beta - 1) / (N[t] + V (beta - 1)), N the shares' sums by
    counts. Returns (doc, t0, t1, ...) mixtures that add up to 1, (word, t0,
    ...) topics that add up to 1 over the words, and (round, log_likelihood),
    the mean a count that each round began with.
    """
    edges = checkpointed(counts.groupBy("doc", "word").agg(F.sum("n").cast("double").alias("n")).where("n > 0 and doc is not null and word is not null"))
    t = [f"t{i}" for i in range(k)]
    vocabulary = edges.select("word").distinct().count()
    if not vocabulary:
        raise ValueError("no counts to fit")
    raw = edges.select("doc", "word", "n", *[start_weight(F.col("doc"), F.col("word"), i).alias(c) for i, c in enumerate(t)])
    whole = sum((F.col(c) for c in t), F.lit(0.0))
    shares = raw.select("doc", "word", "n", *[(F.col(c) / whole).alias(c) for c in t])
    rounds_seen = []
    for number in range(rounds + 1):
        weight = lambda c: (F.col("n") * F.col(c)).alias(c)
        held = checkpointed(shares.select("doc", "word", "n", *[weight(c) for c in t]))
        docs, words = (held.groupBy(key).agg(*[F.sum(c).alias(c) for c in t]) for key in ("doc", "word"))
        topic = held.agg(*[F.sum(c).alias(c) for c in t]).first()
        mixture = docs.select("doc", *[((F.col(c) + (alpha - 1)) / (sum((F.col(x) for x in t), F.lit(0.0)) + k * (alpha - 1))).alias(c) for c in t])
        of_word = words.select("word", *[((F.col(c) + (beta - 1)) / F.lit(topic[c] + vocabulary * (beta - 1))).alias(c) for c in t])
        near = join_summary(join_summary(edges, mixture.withColumnsRenamed({c: f"d_{c}" for c in t}), ["doc"]), of_word.withColumnsRenamed({c: f"w_{c}" for c in t}), ["word"])
        products = near.select("doc", "word", "n", *[(F.col(f"d_{c}") * F.col(f"w_{c}")).alias(c) for c in t])
        likelihood = products.agg(F.sum(F.col("n") * F.log(whole)) / F.sum("n")).first()[0]
        rounds_seen.append((number, float(likelihood)))
        if number == rounds:
            return mixture, of_word, counts.sparkSession.createDataFrame(rounds_seen, "round int, log_likelihood double")
        shares = products.select("doc", "word", "n", *[(F.col(c) / whole).alias(c) for c in t])
