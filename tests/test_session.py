import pytest

from strataflow.session import checkpointed, ensure_checkpoint_dir, persisted_cols, to_local


def test_checkpoint_dir_from_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def test_checkpointed_cuts_lineage(spark):
    df = checkpointed(spark.range(100).filter("id % 2 = 0"))
    assert df.count() == 50
    assert "Filter" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_persisted_cols_releases(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS x", "id * 3 AS y")
    with persisted_cols(df, ["x"]) as f:
        assert f.columns == ["x"] and f.is_cached
    assert not f.is_cached


def test_to_local_is_bounded(spark):
    assert len(to_local(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        to_local(spark.range(6), 5)
