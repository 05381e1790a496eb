"""Row numbers and carried values along any order, without gathering a key.

Rows are range-partitioned by (key, order columns, row id), so that a key with any
share of the rows, and rows that tie on every order column, are spread over as many parts as they
need; the parts are landed, because their borders must not move.  A part then is in order after all
smaller parts, and whatever crosses a border (a count, a last value) is one row per key and part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panora.operators.nullsafe import attach
from panora.sources.writers import cut_lineage

PART_ROWS = 250_000   # rows of a part, about


def _expression(o) -> bool:
    """Is it a column that already says how it sorts (``.desc()`` and the like)?"""
    return not isinstance(o, (str, tuple)) and " NULLS " in str(o)


def in_parts(df: DataFrame, by: Sequence[str], order: Sequence, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, list[Column]]:
    """(landed rows with ``__rid``, landed parts, the parts' order).

    ``order`` holds names, columns, (column, descending) pairs or sort expressions; missing values stand last unless an
    expression says otherwise.  The parts hold ``by``, ``keep``, what orders them, ``__rid`` and ``__part``."""
    own = cut_lineage(df.withColumn("__rid", F.monotonically_increasing_id()), how="parquet")
    if any(_expression(o) for o in order):
        narrow = own                   # its columns are not known by name
        along = [o if _expression(o) else _sorted(o) for o in order]
    else:
        pairs = [o if isinstance(o, tuple) else (o, False) for o in order]
        narrow = own.select(*by, *keep, "__rid", *[(F.col(c) if isinstance(c, str) else c).alias(f"__o{i}")
                                                   for i, (c, _) in enumerate(pairs)])
        along = [_sorted((f"__o{i}", d)) for i, (_, d) in enumerate(pairs)]
    along = [*along, F.col("__rid").asc()]
    parts = max(1, -(-own.count() // PART_ROWS))
    ranged = narrow.repartitionByRange(parts, *[F.col(b).asc_nulls_first() for b in by], *along)
    return own, cut_lineage(ranged.withColumn("__part", F.spark_partition_id()), how="parquet"), along


def _sorted(o) -> Column:
    c, down = o if isinstance(o, tuple) else (o, False)
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last() if down else c.asc_nulls_last()


def number_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (), out: str = "position") -> DataFrame:
    """Every row with its 1-based position among the rows of its key, in ``order`` (names, columns, or
    (column, descending) pairs of any sortable type; missing values last; ties in row order).

    Per part one window over the key's rows there; before it the rows of all earlier parts."""
    by = list(by)
    own, parts, along = in_parts(df, by, order)
    counts = parts.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by or [F.lit(0)]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*by, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*by, "__part").orderBy(*along)
    placed = attach(parts, before, [*by, "__part"]).select(
        "__rid", (F.col("__before") + F.row_number().over(inside)).cast("long").alias(out))
    return own.join(placed, "__rid").drop("__rid").select(*df.columns, out)


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """Missing values of ``cols`` filled with the last one before them in their key.

    Inside a part by a window; into a part comes the last value of the key's earlier parts."""
    by, cols = list(by), list(cols)
    own, parts, along = in_parts(df, by, order, keep=cols)
    inside = Window.partitionBy(*by, "__part").orderBy(*along).rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead("__rid").over(Window.partitionBy(*by, "__part").orderBy(*along))
    filled = parts.withColumns({**{c: F.last(c, ignorenulls=True).over(inside) for c in cols}, "__end": following.isNull()})
    # the last row of a key in a part holds its last values there
    last = filled.filter("__end").select(*by, "__part", *cols)
    earlier = Window.partitionBy(*by or [F.lit(0)]).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*by, "__part", *[F.last(c, ignorenulls=True).over(earlier).alias(f"__c_{c}") for c in cols])
    out = attach(filled, carried, [*by, "__part"]).select(
        "__rid", *[F.coalesce(F.col(c), F.col(f"__c_{c}")).alias(c) for c in cols])
    return own.drop(*cols).join(out, "__rid").select(*df.columns)
