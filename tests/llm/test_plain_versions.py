"""Brute-force versions of what SQL cannot express: splitters (op1), compressed sizes (op8), features and scores (op3)."""

import math
import re

import frames
import numpy as np
import zstandard
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from strataflow.llm import quality as Q
from strataflow.llm import sharding as S
from strataflow.llm import toxicity as T
from strataflow.llm.tables import read_table


def test_splitters_stand_where_the_sorted_bytes_say(spark, sf001):
    docs = read_table(spark, sf001, "documents")
    keys = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h1"), F.xxhash64(F.lit("shard"), "doc_id").alias("h2"),
                       (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"))
    rows = sorted((r["h1"], r["h2"], r["size"]) for r in keys.collect())
    total, ends = sum(r[2] for r in rows), np.cumsum([r[2] for r in rows]).tolist()
    for shards, tolerance in ((8, 0.002), (8, 0.5), (40, 0.002)):
        slack = tolerance * total / shards
        found = S.splitters(keys, shards, tolerance)
        assert len(found) == shards - 1 and found == sorted(found, key=lambda s: (s.h1, s.h2))
        for i, s in enumerate(found, 1):
            target = total * i // shards
            below = sum(r[2] for r in rows if r[:2] <= (s.h1, s.h2))
            assert below == s.below
            nearest = min(abs(e - target) for e in [0, *ends])
            assert abs(below - target) <= max(slack, nearest)


def test_scores_are_those_of_the_compressed_sizes(spark, sf001):
    docs, labels = read_table(spark, sf001, "documents"), read_table(spark, sf001, "labels")
    model = Q.fit(docs, labels)

    def size(data, dictionary):
        press = zstandard.ZstdCompressor(level=Q.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=Q.LEVEL)
        return sum(len(press.compress(data[i:i + Q.BLOCK])) for i in range(0, len(data), Q.BLOCK))

    rows = Q.score(docs.unionByName(spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", None, 0)], frames.SCHEMA)), model).collect()
    for r in rows:
        data = (r["text"] or "").encode()
        if not data:
            assert r["score"] == model.prior
            continue
        gap = (size(data, model.bad) - size(data, model.good)) / len(data)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-(model.slope * gap + model.intercept))), rel_tol=1e-9)
        assert r["predicted"] == (r["score"] >= 0.3)


def plain_features(text, learnt, broad):
    words = [w for w in re.split(r"[\W\d_]+", text.lower()) if w]
    stems = lambda w: {w[:k] + "*" for k in (3, 4, 5)}
    insult = [w in T.INSULTS for w in words]
    known = [w in learnt or bool(stems(w) & learnt) for w in words]
    loose = [bool(stems(w) & broad) for w in words]
    hit = [i for i in range(len(words)) if insult[i] or known[i]]
    near = [i for i in hit if set(words[max(0, i - T.NEAR):i + T.NEAR + 1]) & set(T.SECOND_PERSON)]
    dense = max((sum(i <= j < i + T.WINDOW for j in hit) for i in hit), default=0)
    data, rate = text.encode(), 100 / max(1, len(words))
    share = lambda ok: sum(ok(chr(b)) for b in data if b < 128) / len(data)
    return {"insult_density": sum(insult) * rate, "insult_count": math.log1p(sum(insult)), "learnt_density": sum(known) * rate, "near_you_density": len(near) * rate,
            "dense_window": float(dense), "capitals": share(str.isupper), "digits": share(str.isdigit), "exclamations": share(lambda c: c in "!?"),
            "punctuation": share(lambda c: 33 <= ord(c) < 127 and not c.isalnum()), "broad_density": sum(loose) * rate, "length": math.log1p(len(words))}


def test_toxicity_scores_follow_from_features_trees_and_steps(spark, sf01):
    docs, labels = read_table(spark, sf01, "documents"), read_table(spark, sf01, "labels")
    model = T.fit(docs, labels)
    assert model.trees is not None and model.isotonic is not None
    learnt, broad = frozenset(model.learnt), frozenset(model.broad)
    steps, values = model.isotonic.boundaries.toArray(), model.isotonic.predictions.toArray()
    assert (np.diff(steps) >= 0).all() and (np.diff(values) >= 0).all()
    trees = list(zip(model.trees.treeWeights, model.trees.trees, strict=True))
    for r in T.score(docs.orderBy(F.xxhash64("doc_id")).limit(60), model).collect():
        found = dict(zip(T.FEATURES, T.features(r["text"], learnt, broad), strict=True))
        if r["text"]:
            for name, value in plain_features(r["text"], learnt, broad).items():
                assert math.isclose(found[name], value, rel_tol=1e-9, abs_tol=1e-12), (name, r["doc_id"])
        margin = sum(w * t.predict(Vectors.dense(list(found.values()))) for w, t in trees)
        own = 1 / (1 + math.exp(-2 * margin))
        score = min(1.0, max(0.0, 0.999 * float(np.interp(margin, steps, values)) + 0.001 * own))
        assert math.isclose(r["score"], score, rel_tol=1e-6, abs_tol=1e-9)
