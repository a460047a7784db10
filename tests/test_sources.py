import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strataflow.sources.schema import TRIP_COLUMNS, TRIP_SCHEMA
from strataflow.sources.trips import month_paths, read_reconciled, read_trips, union_by_name


def _write(path, pax, pax_type):
    t = pa.table({
        "VendorID": pa.array([1] * len(pax), pa.int64()),
        "passenger_count": pa.array(pax, pax_type),
        "trip_distance": pa.array([1.5] * len(pax), pa.float64()),
        "RatecodeID": pa.array([1] * len(pax), pa.int64() if pax_type == pa.int64() else pa.float64()),
        "fare_amount": pa.array([10.0] * len(pax), pa.float64()),
    })
    pq.write_table(t, path)


@pytest.fixture(scope="module")
def mixed_dir():
    d = tempfile.mkdtemp(prefix="strataflow-mixed-")
    _write(f"{d}/yellow_tripdata_2024-01.parquet", [1, 2, None], pa.int64())
    _write(f"{d}/yellow_tripdata_2024-02.parquet", [3.0, None], pa.float64())
    _write(f"{d}/yellow_tripdata_2024-03.parquet", [4, 5], pa.int64())
    return d


def test_reconciled_mixed_int64_double(spark, mixed_dir):
    df = read_reconciled(spark, month_paths(mixed_dir, 2024, [1, 2, 3]))
    assert df.columns == TRIP_COLUMNS
    assert dict(df.dtypes)["passenger_count"] == "double"
    assert sorted(r[0] for r in df.select("passenger_count").collect() if r[0] is not None) == [1, 2, 3, 4, 5]
    assert df.count() == 7
    # absent columns arrive as typed nulls
    assert df.filter(F.col("payment_type").isNotNull()).count() == 0


def test_reconciled_one_scan_per_schema(spark, mixed_dir):
    df = read_reconciled(spark, [mixed_dir])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # two distinct footers, three files


def test_fixed_schema_fails_on_mismatch(spark, mixed_dir):
    df = read_trips(spark, f"{mixed_dir}/*.parquet", TRIP_SCHEMA)
    with pytest.raises(Exception):
        df.collect()


def test_union_keeps_duplicates(spark):
    a = spark.range(3).withColumnRenamed("id", "x")
    b = spark.range(3).withColumnRenamed("id", "x").withColumn("y", F.lit(1))
    u = union_by_name([a, b])
    assert u.count() == 6 and u.columns == ["x", "y"]


def test_month_paths():
    p = month_paths("gs://bucket/yellow", 2024, [1, 12])
    assert p == ["gs://bucket/yellow/yellow_tripdata_2024-01.parquet",
                 "gs://bucket/yellow/yellow_tripdata_2024-12.parquet"]


def test_filters_reach_the_scan(spark, tmp_path):
    from strataflow.operators.quality import silver
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([], TRIP_SCHEMA).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = silver(read_trips(spark, path)).select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThan(fare_amount,0.0)" in plan
    assert "tpep_pickup_datetime" in plan.split("PushedFilters")[1]


def test_file_row_key_unique_and_stable(spark, mixed_dir):
    a = read_reconciled(spark, [mixed_dir], key_col="k")
    keys = [r[0] for r in a.select("k").collect()]
    assert len(keys) == len(set(keys)) == 7
    b = read_reconciled(spark, [mixed_dir], key_col="k").repartition(3)
    assert sorted(keys) == sorted(r[0] for r in b.select("k").collect())
    assert all(k.startswith("yellow_tripdata_2024-0") for k in keys)


def test_file_row_key_unique_across_partition_folders(spark, tmp_path):
    from strataflow.sources.trips import read_trips
    for m in ("01", "02"):   # same file name in two partition folders
        spark.range(3).selectExpr("CAST(id AS DOUBLE) AS fare_amount").coalesce(1) \
            .write.parquet(str(tmp_path / f"month={m}"))
    df = read_trips(spark, str(tmp_path), key_col="k")
    keys = [r[0] for r in df.select("k").collect()]
    assert len(keys) == len(set(keys)) == 6


def test_read_months_equals_reconciled(spark, mixed_dir):
    from strataflow.sources.trips import read_months
    paths = month_paths(mixed_dir, 2024, [1, 2, 3])
    a = read_months(spark, paths, key_col="k")
    b = read_reconciled(spark, paths, key_col="k")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3   # one scan per month path
