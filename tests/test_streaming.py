import tempfile

from strataflow.operators.quality import silver
from strataflow.operators.strata import with_strata
from strataflow.sources.events import load_trips
from strataflow.sources.schema import TRIP_COLUMNS
from strataflow.streaming.strata_stream import start_counts, strata_count_stream


def test_stream_counts_equal_batch(spark, sf001):
    trips = load_trips(spark, sf001).select(*TRIP_COLUMNS)
    folder = tempfile.mkdtemp(prefix="strataflow-stream-")
    a, b = trips.randomSplit([0.5, 0.5], 7)
    a.write.mode("append").parquet(folder)
    b.write.mode("append").parquet(folder)
    q = start_counts(strata_count_stream(spark, folder), "strata_stream_test",
                     checkpoint=tempfile.mkdtemp(prefix="strataflow-stream-ckpt-"))
    q.awaitTermination(120)
    got = {r["stratum"]: r["n"] for r in spark.sql("SELECT * FROM strata_stream_test").collect()}
    want = {r[0]: r[1] for r in with_strata(silver(trips)).groupBy("stratum").count().collect()}
    assert got == want
