"""Null-safe join-back: statistics computed by a grouping return to the rows
(or counts) they came from, with NULL keys equal to each other as in the
grouping itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "left",
           plain: Sequence[str] = ()) -> DataFrame:
    """``df`` joined with ``stats`` on ``by``, NULL keys matching each other;
    one copy of the keys, named as on the left.  Keys in ``plain`` match by
    ordinary equality (a NULL there matches nothing)."""
    by = list(by)
    names = {k: f"__at{i}_{k}" for i, k in enumerate(by)}
    right = stats.withColumnsRenamed(names)
    cond = reduce(lambda a, b: a & b,
                  [df[k] == right[names[k]] if k in plain else df[k].eqNullSafe(right[names[k]]) for k in by])
    out = df.join(right, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())
