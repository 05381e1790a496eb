"""Vectors as blocks: bounded groups of rows, stored as one matrix per row.

A vector takes part if it, its id and all its components are given and
finite.  Shorter vectors count as if filled up with zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.llm.common import landed, ship

BLOCK = "block long, n int, dim int, ids binary, data binary"


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id`` and ``v`` of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad)


def to_blocks(rows: DataFrame, size: int, prepare, tag: str, where: Column | None = None) -> DataFrame:
    """Landed blocks of up to ``size`` rows of (id, v).  ``prepare(matrix)`` makes
    the stored matrix (any dtype; kept as float64 or int64 bytes)."""
    ship(rows.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for i in range(0, b.num_rows, size):
                part = b.slice(i, size)
                lists = part.column(1)
                dims = lists.value_lengths().to_numpy(zero_copy_only=False)
                dim = int(dims.max(initial=0))
                m = np.zeros((len(dims), dim))
                m[np.arange(dim) < dims[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                m = prepare(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([len(dims)], pa.int32()), pa.array([dim], pa.int32()),
                     pa.array([part.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()]),
                     pa.array([np.ascontiguousarray(m).tobytes()])],
                    names=["block", "n", "dim", "ids", "data"])
                number += 1
    if where is not None:
        rows = rows.filter(where)
    return landed(rows.mapInArrow(run, BLOCK), tag)


def matrix(data: bytes, n: int, dtype: str):
    import numpy as np

    return np.frombuffer(data, dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


def same_width(a, b):
    """Two matrices filled up with zeros to one number of columns."""
    import numpy as np

    w = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, w - x.shape[1]))) if x.shape[1] < w else x for x in (a, b))
