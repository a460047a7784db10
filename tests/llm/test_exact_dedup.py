import hashlib

import frames
from pyspark.sql import functions as F
from strataflow.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_report_matches_brute_force(spark):
    got = sorted((tuple(r) for r in X.dedup_report(frames.plain(spark)).collect()), key=str)
    assert got == brute(frames.rows())


def test_weak_digest_is_resolved_by_full_text(spark):
    weak = lambda text: F.concat(F.lit("d"), (F.length(text) % 3).cast("string"))
    got = sorted((tuple(r) for r in X.dedup_report(frames.plain(spark), digest=weak).collect()), key=str)
    assert got == brute(frames.rows())


def test_one_row_of_each_text_stays(spark):
    kept = X.exact_dedup(frames.clashing(spark))
    assert kept.columns == frames.clashing(spark).columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in frames.rows()})


def test_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = X.dedup_report(df)
    assert got.where("kept").count() == 2001
    assert got.where("group_size = 1000 and keep_id = 2997").count() == 1000


def test_empty(spark):
    assert X.dedup_report(frames.empty(spark)).count() == 0 and X.exact_dedup(frames.empty(spark)).count() == 0
