"""Small frames with every awkward case: nulls, empty and long texts, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("kept", "shard", "slot", "score", "predicted", "spans", "ids", "h1", "features", "label", "part", "bucket", "key", "n", "sketch", "digest", "pivot")


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 7))) + str(r.randrange(vocabulary)) for _ in range(n))


def rows() -> list[tuple]:
    base = words(80, 1)
    texts = [base, base, base.upper(), base + " tail", None, "", " \t\n", "one two", "One TWO", "x" * 60_000, words(30_000, 2), words(200, 3),
             base[:300] + " " + words(60, 4), "token = abcdefgh123 AKIA" + "Z9" * 9 + " " + "0123456789abcdef" * 2, "ÄÖ 日本 😀 ▁ mark", None, ""]
    out = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return out + [out[0], out[3], (None, base, None, None, None), (None, None, None, None, None), (None, "lonely " + words(30, 9), "en", "s", 5)]


def plain(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def unique_ids(spark):
    return spark.createDataFrame([r for i, r in enumerate(rows()) if r[0] is not None and r[0] not in [x[0] for x in rows()[:i]]], SCHEMA)


def clashing(spark):
    df = plain(spark)
    for c in CLASHING:
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("own"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
