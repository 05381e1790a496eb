"""Results must not depend on partitioning or input order."""

import pytest
from pyspark.sql import functions as F

from panora.operators.aggregate import winsorize
from panora.operators.joins import align, merge_mm
from panora.operators.profile import average_ranks
from panora.operators.window import locf, xtile


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_partition_invariance(spark, parts):
    base = spark.range(0, 400).select(
        (F.col("id") % 13).cast("int").alias("e"), (F.col("id") / 13).cast("int").alias("t"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 7 % 31).cast("double")).alias("x"))
    shuffled = base.repartition(parts, F.rand(3))
    for op in (lambda d: winsorize(d, ["x"], by=["e"]),
               lambda d: xtile(d, "x", 5, "q"),
               lambda d: locf(d, "e", "t", ["x"], chunk=4),
               lambda d: average_ranks(d, ["x"], method="distributed"),
               lambda d: average_ranks(d, ["x"], method="map"),
               lambda d: align(d.select("e", "t", "x"),
                               d.select("e", "t", (F.col("x") * 2).alias("x2")), keys=["e", "t"])):
        assert _rows(op(base)) == _rows(op(shuffled))


def test_merge_mm_positions(spark):
    l = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 20)], "k int, a int")
    r = spark.createDataFrame([(1, 100), (2, 200), (2, 201), (3, 300)], "k int, b int")
    got = sorted(tuple(x) for x in merge_mm(l, r, "k", ["a"], ["b"]).collect())
    assert got == [(1, 10, 100), (1, 11, 100), (1, 12, 100), (2, 20, 200), (2, 20, 201), (3, None, 300)]
