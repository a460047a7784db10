"""Reading tables, and tables written to the shared folder to cut lineage."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Documents in a batch that Python gets, unless the session says otherwise.
ARROW_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of the tables that operators have written in this process, oldest first.
_WRITTEN: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back.

    A lost executor then re-reads the table instead of recomputing its
    lineage, and a value that is not reproducible (a partition number) stays
    what it was. The table stays until the ``scratch`` block around it ends;
    without one it stays, as a result may read it at any time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, keep: Callable[[], Iterable[DataFrame]] = tuple) -> Iterator[None]:
    """Deletes the tables written inside the block when it ends, but for those that the frames of ``keep`` read."""
    mine = len(_WRITTEN)
    try:
        yield
    finally:
        read = {f.rsplit("/", 2)[-2] for df in keep() for f in df.inputFiles()}
        left = [p for p in _WRITTEN[mine:] if p.rsplit("/", 1)[-1] in read]
        for path in _WRITTEN[mine:]:
            if path not in left:
                deleted(spark, path)
        _WRITTEN[mine:] = left


def deleted(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add (clashing names)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def utf8(col: Column) -> Column:
    """Text as UTF-8 bytes; null counts as empty."""
    return F.encode(F.coalesce(col, F.lit("")), "UTF-8")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Keys with more than 1/HOT_SHARE of the rows are joined by broadcast: there are at most HOT_SHARE of them.
HOT_SHARE = 1024


def join_small_or_hot(rows: DataFrame, answers: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of ``rows`` with one answer per key, whatever share of the rows a key has.

    ``answers`` holds in ``count`` how many rows have the key. Keys with a
    large share are few and are broadcast; their rows take no part in the
    shuffled join (they are spread by a key of their own).
    """
    answers = written(answers, "answers")
    n = answers.agg(F.sum(count)).first()[0] or 0
    hot = answers.where(F.col(count) * HOT_SHARE > n)
    columns = [c for c in answers.columns if c != key]
    first = rows.join(F.broadcast(hot.select(key, *[F.col(c).alias(f"hot_{c}") for c in columns])), key, "left")
    spread = F.concat(F.lit("hot"), F.xxhash64(*rows.columns).cast("string"))
    first = first.withColumn("__at", F.when(F.col(f"hot_{count}").isNull(), F.col(key).cast("string")).otherwise(spread))
    cold = answers.where(F.col(count) * HOT_SHARE <= n).withColumn("__at", F.col(key).cast("string")).drop(key)
    both = first.join(cold, "__at", "left")
    return both.select(*rows.columns, *[F.when(F.col(f"hot_{count}").isNotNull(), F.col(f"hot_{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Operators with Python tasks call it first, so they also run where only
    the driver has the package on its path. It also makes Arrow batches
    smaller where the session has Spark's default, which is meant for short rows. The archive lies in the shared
    folder; Spark hands it to the executors.
    """
    if spark.conf.get(_ARROW_ROWS) == "10000":  # Spark's default; rows here are whole documents
        spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/code-{uuid.uuid4().hex}/strataflow.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(sc.applicationId)
