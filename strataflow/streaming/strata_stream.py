"""Running stratum counts over Parquet trip files arriving in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.quality import silver
from ..operators.strata import with_strata
from ..session import ensure_checkpoint_dir
from ..sources.schema import TRIP_SCHEMA


def strata_count_stream(spark: SparkSession, folder: str, schema: StructType = TRIP_SCHEMA,
                        year: int = 2024, max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming DataFrame of (stratum, n): the batch Silver rules and
    strata applied to each new file, counts kept in the state store."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(folder))
    return with_strata(silver(src, year=year)).groupBy("stratum").count().withColumnRenamed("count", "n")


def start_counts(df: DataFrame, name: str, sink: str = "memory",
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the count stream with its state checkpoint in the shared
    checkpoint folder (so a restarted driver resumes, not recounts)."""
    spark = df.sparkSession
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = df.writeStream.outputMode("complete").format(sink).option("checkpointLocation", checkpoint)
    if sink == "memory":
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
