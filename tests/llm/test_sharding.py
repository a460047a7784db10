import frames
import pytest
from pyspark.sql import functions as F
from strataflow.llm import sharding as S


def check(rows, shards, slack):
    per = {}
    for r in rows:
        per.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    for s, own in per.items():
        assert 0 <= s < shards and sorted(x[0] for x in own) == list(range(len(own)))
    sizes = [sum(x[1] for x in per.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= slack
    return sizes


def test_awkward_rows(spark):
    df = frames.clashing(spark)
    out = S.shard(df, 3).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 16).collect()
    assert len(out) == df.count()
    check(out, 3, 2 * max(r["size"] for r in out))


def test_sizes_are_near_equal_with_a_hot_group(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot" * 20)).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    out = S.shard(df, 40).withColumn("size", F.octet_length("text") + 16).collect()
    sizes = check(out, 40, 400)
    assert min(sizes) > 0


def test_more_buckets_than_one(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(S, "PROBES", 4)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    check(S.shard(df, 5).withColumn("size", F.octet_length("text") + 16).collect(), 5, 400)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_rows_than_shards(spark, n):
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    assert S.shard(df, 8).count() == n
