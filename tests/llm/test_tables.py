import pytest
from strataflow.llm import tables as T


def test_tables_of_a_block_go_when_it_ends(spark):
    before = T.written(spark.range(3), "before")
    out = []
    with T.scratch(spark, lambda: out[-1:]):
        gone = T.written(spark.range(5), "gone")
        out.append(T.written(gone.where("id > 1"), "kept"))
    assert before.count() == 3 and out[0].count() == 3
    with pytest.raises(Exception):  # noqa: B017  Spark's own error for a missing file
        spark.read.parquet(gone.inputFiles()[0].rsplit("/", 1)[0]).count()
    with pytest.raises(ValueError), T.scratch(spark):
        lost = T.written(spark.range(2), "lost")
        raise ValueError
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(lost.inputFiles()[0].rsplit("/", 1)[0]).count()
