"""Exact dedup by skew-safe combining.

Rows with equal texts form a group; the row with the largest ``doc_id``
stays. Three combining steps, each comparing the full text (the grouping key
holds the text itself, the digest only deals the rows out):

1. rows are combined where they are read (partial aggregation),
2. what is left is merged under (digest, salt, text),
3. the salt winners are combined under (digest, text).

A group that holds a third of all rows therefore reaches step 3 as at most
``salts`` rows. Each row then learns its group's winner by the digest; digests
that stand for more than one text are resolved by the text as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

#: A digest whose group holds more than 1/HOT_SHARE of the rows is joined by broadcast: there are at most HOT_SHARE of them.
HOT_SHARE = 1024


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), digest(text).alias("digest"))


def _combined(keyed: DataFrame, salts: int) -> DataFrame:
    """(digest, text, keep_id, group_size): one row per distinct text."""
    salted = (keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy("digest", "salt", "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return (salted.repartition("digest").groupBy("digest", "text")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
            digest: Callable[[Column], Column] = sha256_hex) -> tuple[DataFrame, DataFrame | None]:
    """Winners by digest, and by (digest, text) for digests of several texts (None: there are none).

    The first table is (digest, keep_id, group_size), one row per digest that
    stands for one text.
    """
    combined = _combined(_keyed(docs, id_col, text_col, digest), salts)
    by_digest = written(combined.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size")), "dedup-winners")
    if by_digest.filter("texts > 1").isEmpty():
        return by_digest.drop("texts"), None
    shared = by_digest.filter("texts > 1").select("digest")
    several = written(combined.join(shared, "digest", "left_semi"), "dedup-collisions")
    return by_digest.filter("texts = 1").drop("texts"), several


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                 digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty; the empty text is a text like any other. Ties
    cannot occur between different ids; rows that repeat an id and its text
    are the same document and carry the same ``kept``. A null id never stays
    unless every id of its group is null. An empty table gives an empty
    report. Other input columns are not read, so their names cannot clash.
    """
    single, several = winners(docs, id_col, text_col, salts, digest)
    keyed = _keyed(docs, id_col, text_col, digest).withColumn("text_sha256", sha256_hex(F.col("text")))
    rows = keyed if several is not None else keyed.drop("text")
    n = single.agg(F.sum("group_size")).first()[0] or 0
    hot = F.broadcast(single.filter(F.col("group_size") * HOT_SHARE > n)
                      .select("digest", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size")))
    # rows of hot groups have their answer; they are spread by row so that no task gets a whole group
    rows = (rows.join(hot, "digest", "left")
            .withColumn("at", F.when(F.col("hot_size").isNull(), F.col("digest"))
                        .otherwise(F.concat(F.lit("hot"), F.xxhash64("doc_id").cast("string")))))
    cold = single.filter(F.col("group_size") * HOT_SHARE <= n).withColumnRenamed("digest", "at")
    out = rows.join(cold, "at", "left").select(
        *[c for c in rows.columns if c not in ("at", "hot_id", "hot_size")],
        F.when(F.col("hot_size").isNotNull(), F.col("hot_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("hot_size", "group_size").alias("group_size"))
    if several is not None:
        by_text = several.select("digest", "text", F.col("keep_id").alias("text_keep"), F.col("group_size").alias("text_size"))
        out = out.join(by_text, ["digest", "text"], "left").withColumns({
            "keep_id": F.when(F.col("text_size").isNotNull(), F.col("text_keep")).otherwise(F.col("keep_id")),
            "group_size": F.coalesce("text_size", "group_size")})
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat the surviving id and text one stays, an arbitrary one
    where they differ in other columns. A group whose ids are all null keeps one row.
    """
    single, several = winners(docs, id_col, text_col, salts)
    won = single if several is None else single.unionByName(several.drop("text"))
    won = won.select(F.col("keep_id").alias("__id"), F.col("digest").alias("__digest"))
    rows = docs.withColumn("__key", sha256_hex(F.coalesce(F.col(text_col), F.lit(""))))
    kept = rows.join(won, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__digest")), "left_semi")
    if not docs.groupBy(id_col).count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, "__key"])
    return kept.drop("__key")
