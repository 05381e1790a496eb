"""Scratch space: shared storage off local mode, nothing left after a fit."""

import os
from types import SimpleNamespace

import pytest

from panora import session
from panora.operators import estimate


def test_no_machine_local_scratch_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(SimpleNamespace(sparkContext=sc))


def test_a_fit_leaves_no_sample_copy(spark):
    root = session.checkpoint_root(spark).removeprefix("file:")
    before = {f for f in os.listdir(root) if f.startswith("panora-cut")}
    df = spark.createDataFrame([(i % 4, float(i), float(i * i % 7)) for i in range(40)], "e int, x double, y double")
    assert estimate.areg(df, "y", ["x"], "e").n == 40
    assert {f for f in os.listdir(root) if f.startswith("panora-cut")} == before
