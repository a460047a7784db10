"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again before the next one. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from strataflow.llm.queries import fold
from strataflow.llm.tables import read_table, scratch, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; learnt from the labelled ones outside the held-out fold.

    Null and empty texts have a score as others do; repeated rows stay or go together; an empty table stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~fold(5, 0)))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id. Null and empty texts are equal; an empty table stays empty."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-equal shingle sets the one with the smallest id. Texts without words all stay; an empty table stays empty."""
    return ngram_join.near_dedup(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted anew where that changed a text; null texts stay null."""
    found = secret_scan.scan(docs, secret_scan.REDACTED).withColumn("__hit", F.size("spans") > 0)
    out = secret_scan.redact(found)
    return out.withColumn("n_chars", F.when(F.col("__hit"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens. A null or empty text is the end id alone; no rows make no pieces."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: The classifier and the tokenizer are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written on its way, and the copy that it read, go when its result is written."""
    docs = read_table(spark, sf_dir, "documents")
    out: list[DataFrame] = []
    with scratch(spark, lambda: out[-1:]):
        for name, stage in STAGES:
            with scratch(spark, lambda: out[-1:]):
                out.append(written(stage(spark, docs, sf_dir), f"stage-{name}"))
                docs = out[-1]
    return docs
