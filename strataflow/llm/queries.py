"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchor_codes, collocations, exact_dedup, minhash_dedup, ngram_join, packing, piece_transducer, quality, secret_scan, sharding, suffix_dedup, topk_search, toxicity
from .tables import read_table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    out = sharding.shard(rows, 40, size=F.col("size"), group=F.col("text_hash"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def fold(divisor: int, held_out: int) -> Column:
    """True for the rows that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(divisor)) == held_out, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~fold(4, 2)))
    return toxicity.score(docs, model, ["doc_id"]).select("doc_id", fold(4, 2).alias("held_out"), "score", "predicted")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(read_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secret_scan.BASE + secret_scan.MORE
    found = secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"), rules).drop("text")
    of_kind = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))
    return found.select("doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
                        F.sha2(F.encode(secret_scan.span_list(base, rules), "UTF-8"), 256).alias("base_sha256"),
                        secret_scan.span_list(F.col("spans"), rules).alias("spans"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op7_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_transducer.encode(read_table(spark, sf_dir, "documents"), with_ids=False)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~fold(5, 0)))
    return quality.score(docs, model, ["doc_id"]).select("doc_id", fold(5, 0).alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(read_table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_groups(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_topk_search": op2_topk_search,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_join": op4_ngram_join,
    "op5_secret_scan": op5_secret_scan,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_piece_transducer": op7_piece_transducer,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_collocations": op13_collocations,
}
