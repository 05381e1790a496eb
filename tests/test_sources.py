"""Readers, writers and labels: round trips through files Spark writes."""

import pytest
from pyspark.sql import functions as F

from panora.functions.labels import describe_columns, label_columns
from panora.session import scratch_path
from panora.sources.readers import (parse_fixed_width, parse_json_column, read_dir, read_table,
                                    signal_window, stack_parts)
from panora.sources.writers import cut_lineage, write_table


def test_csv_na_and_dirty_fields(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([("1", "2.5"), ("NA", "x"), ("3", "NA")], "a string, b string") \
        .coalesce(1).write.option("header", True).csv(path)
    got = [tuple(r) for r in read_table(spark, path, "a int, b double").orderBy("a").collect()]
    assert got == [(None, None), (1, 2.5), (3, None)]
    assert read_dir(spark, path, "a int, b double", cols=["b"]).columns == ["b"]


def test_fixed_width(spark):
    df = spark.createDataFrame([("  12 3.50X",), ("abc      Y",), ("   7     Z",)], "value string")
    out = parse_fixed_width(df, [("n", 1, 4, "int"), ("v", 5, 5, "double"), ("f", 10, 1, "string")])
    assert [tuple(r) for r in out.collect()] == [(12, 3.5, "X"), (None, None, "Y"), (7, None, "Z")]


def test_json_column_and_stack(spark):
    df = spark.createDataFrame([(1, '{"k": 3, "s": "a"}'), (2, "not json")], "id int, p string")
    got = [tuple(r) for r in parse_json_column(df, "p", "k long, s string").orderBy("id").collect()]
    assert got == [(1, 3, "a"), (2, None, None)]
    st = stack_parts([df, df], ["id"], part_col="part")
    assert sorted(tuple(r) for r in st.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_signal_window_is_pushed_filter(spark):
    feed = spark.createDataFrame([("a", "2020-03-01"), ("b", "2020-05-01")], "signal string, d string") \
        .select("signal", F.col("d").cast("date").alias("time_value"))
    assert [r.signal for r in signal_window(feed, "2020-02-01", "2020-04-01", ["a", "b"]).collect()] == ["a"]


def test_labels_survive_parquet(spark):
    df = label_columns(spark.range(3), {"id": "Row id"}, notes={"id": ["zero based"]})
    path = write_table(df, scratch_path(spark, "t-lab"))
    back = spark.read.parquet(path)
    assert back.schema["id"].metadata["comment"] == "Row id"
    rows = describe_columns(spark, back).collect()
    assert rows[0].label == "Row id" and rows[0].type == "bigint"


def test_cut_lineage_keeps_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    for how in ("parquet", "checkpoint"):
        assert sorted(r.x for r in cut_lineage(df, how).collect()) == list(range(0, 20, 2))


def test_grid_models_with_own_samples(spark):
    from panora.operators.estimate import areg, grid
    rows = [(e, t, float(t + e), (None if (e + t) % 5 == 0 else float(t * e % 7)), float((e * t) % 3))
            for e in range(8) for t in range(6)]
    df = spark.createDataFrame(rows, "e int, t int, y double, y2 double, x double")
    fits = grid(df, ["y", "y2"], ["x"], lambda o, m: [m], absorb="e")
    for f in fits:
        ref = areg(df, f.depvar, f.terms, absorb="e")
        assert f.n == ref.n
        assert abs(f.coef[0] - ref.coef[0]) < 1e-9
    assert fits[0].n != fits[1].n  # y2 has its own (smaller) sample
