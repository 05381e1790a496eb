"""Session helpers.

Library code never creates a session; callers pass one in.  ``get_session``
is for tests, the bench and scripts.  Scratch output (lineage cuts, landed
intermediate files) always goes under the cluster's ``spark.checkpoint.dir``
so that it is on shared storage and survives executor loss; a private
temporary folder is chosen only when the setting is absent and the master is
local (tests), anywhere else its absence is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "panora", cpus: int | str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PANORA_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; set one only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="panora-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/panora-{tag}-{uuid.uuid4().hex[:12]}"
