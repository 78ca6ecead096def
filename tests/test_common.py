import pytest

from catalogprep.operators import _common as C


def test_spread_only_when_thin(spark):
    cores = spark.sparkContext.defaultParallelism
    thin = spark.range(0, 1000, numPartitions=1)
    assert C.spread(thin).rdd.getNumPartitions() == cores
    keyed = C.spread(thin.withColumnRenamed("id", "k"), "k")
    assert "hashpartitioning(k" in keyed._jdf.queryExecution().executedPlan().toString()
    wide = spark.range(0, 1000, numPartitions=cores)
    assert C.spread(wide) is wide  # already split: no shuffle added


def test_bounded_domain(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "v string")
    assert C.bounded_domain(df, "v", 2) == ["a", "b"]
    assert C.bounded_domain(df, "v") == ["a", "b"]
    with pytest.raises(ValueError):
        C.bounded_domain(df, "v", 1)
