"""Aligning two runs ranks each of them once."""
import pytest
from pyspark.sql import functions as F

from quire.operators import compare


def _run(spark, values, seen):
    def told(x):
        seen.add(1)
        return x
    count = F.udf(told, "double").asNondeterministic()   # is not evaluated twice or left out by the optimizer
    return spark.createDataFrame(values, "query_id long, v double").select("query_id", count("v").alias("value"))


@pytest.mark.parametrize("test, row", [(compare.paired_t, 2), (compare.wilcoxon, 2)])
def test_runs_are_computed_once(spark, test, row):
    seen = spark.sparkContext.accumulator(0)
    a, b = _run(spark, [(1, 0.5), (2, 0.25)], seen), _run(spark, [(2, 0.5), (1, 0.0)], seen)
    assert test(compare.align(a, b)).first()["n"] == row
    assert seen.value == 4


def test_rows_and_mismatch_as_before(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25), (None, 0.1)], "query_id long, value double")
    with pytest.raises(compare.RunMismatch):
        compare.align(a, a.where("query_id = 1"))
    with pytest.raises(compare.RunMismatch):
        compare.align(a, a)   # a null id meets no other
    rows = compare.align(a, a, check=False).collect()
    assert sorted(rows) == [(1, 0.5, 0.5), (2, 0.25, 0.25)]
