"""Shared helpers of the training-data operators: table access, scratch
tables in the cluster's shared folder, Arrow map helpers.

Every operator selects the columns it needs under private names first, so
extra columns of the input (also ones that clash with working names) never
reach its joins.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from panora.session import scratch_path
from panora.sources.writers import drop_scratch as drop_landed  # noqa: F401  of tables by landed()

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run without ASCII white space
SUB_ROWS = 512               # rows handled at once inside a Python task
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Prepare a session for jobs with Python tasks: send this package to the
    workers once per application, so that jobs do not rely on a copy installed on
    every machine, and lower the session's Arrow batches to BATCH_BYTES unless the
    session has set them (each task holds a batch in the JVM and in Python at once)."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_SETTING, "1b") == "1b":    # unset
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if not getattr(sc, "_panora_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        at = os.path.join(tempfile.mkdtemp(prefix="panora-"), "panora-package")
        stage = tempfile.mkdtemp(prefix="panora-")
        shutil.copytree(package, os.path.join(stage, "panora"), ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(at, "zip", stage))
        sc._panora_shipped = True


def landed(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared scratch folder and
    continue from there (survives lost executors, cuts the lineage)."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over small slices: ``fn(batch) -> RecordBatch`` sees at
    most SUB_ROWS rows at once, whatever the session's batch size."""
    ship(df.sparkSession)

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for i in range(0, b.num_rows, SUB_ROWS):
                yield fn(b.slice(i, SUB_ROWS))
    return df.mapInArrow(run, schema)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
