"""Writers (inventory S9) and lineage cuts.

Outputs are written with Spark's committers, so a lost executor only
re-runs its tasks.  ``cut_lineage`` materialises an intermediate result in the
shared checkpoint folder (reliable checkpoint, never a local one).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame

from panora.session import scratch_path


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite",
                header: bool = True, max_records_per_file: int | None = None) -> str:
    """Write a panel or summary table (Parquet by default, CSV with header)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)
    return path


def drop_scratch(df: DataFrame) -> None:
    """Remove the scratch table that ``df`` reads, once nothing needs it."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/panora-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def cut_lineage(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Materialise ``df`` on shared storage and continue from there.

    ``checkpoint``: ``DataFrame.checkpoint`` into ``spark.checkpoint.dir``;
    ``parquet``: write a table under the same folder and read it back.
    """
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
