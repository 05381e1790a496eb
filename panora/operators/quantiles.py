"""Exact order statistics that never gather a group into one task.

Spark's exact ``percentile`` / ``median`` keep a value -> count map per group
and merge it into one buffer per group: fine while a group has few distinct
values, unbounded when one group holds a third of a continuous column.  The
route here works on the distinct-value table instead:

1. value counts per (group, value) -- a partial aggregation, so even a value
   repeated on a third of all rows is one row;
2. that table is range-partitioned by (group, value) into buckets of bounded
   size, as many as the number of values asks for, and landed;
3. bucket totals -> offsets (one row per bucket and group);
4. running counts inside (group, bucket) -- a window over the distinct values
   of one bucket of one group.

Every distinct value then knows its exact rank range [lo, hi] within its
group, and any order statistic is a filter on that table.  ``method="auto"``
keeps the cheaper map aggregate when an approximate distinct count shows the
largest group is small.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panora.operators.nullsafe import attach
from panora.sources.writers import cut_lineage

MAP_MAX_DISTINCT = 1_000_000  # largest group the value -> count map may hold
BUCKET_ROWS = 250_000         # distinct values of a bucket, about


def use_map(df: DataFrame, cols: str | Sequence[str], by: Sequence[str] = (),
            method: str = "auto") -> bool:
    """Decide between the map aggregate and the distributed rank route: one
    HyperLogLog aggregation gives the largest per-group distinct count."""
    if method in ("map", "distributed"):
        return method == "map"
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = list(by)
    nds = [F.approx_count_distinct(c, 0.05).alias(f"__d{i}") for i, c in enumerate(cols)]
    if by:
        per = df.groupBy(*by).agg(*nds)
        worst = per.agg(F.greatest(*[F.max(f"__d{i}") for i in range(len(cols))], F.lit(0))).first()[0]
    else:
        worst = df.agg(F.greatest(*[F.approx_count_distinct(c, 0.05) for c in cols], F.lit(0))).first()[0]
    return (worst or 0) <= MAP_MAX_DISTINCT


def rank_ranges(df: DataFrame, col: str, by: Sequence[str] = (), method: str = "distributed") -> DataFrame:
    """(by..., value, __c, __lo, __hi): count and 1-based rank range of every
    distinct non-missing value within its group (ties share the range).

    ``method="auto"``: when the largest group has at most
    ``MAP_MAX_DISTINCT`` distinct values the running count is one window
    over the distinct-value table of each group (bounded by that check);
    otherwise, or with "distributed", the bucketed prefix sum is used.
    """
    by = list(by)
    d = df.select(*by, col).where(F.col(col).isNotNull())
    vc = d.groupBy(*by, col).agg(F.count(F.lit(1)).alias("__c"))
    return ranges_of_counts(vc, by, col, method != "distributed" and use_map(df, col, by, method))


def ranges_of_counts(vc: DataFrame, by: Sequence[str], col: str, small: bool) -> DataFrame:
    """:func:`rank_ranges` of a table of value counts ``__c``; ``small`` if every group's
    values fit into one window."""
    by = list(by)
    if small:
        w = Window.partitionBy(*by).orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
        r = vc.withColumn("__hi", F.sum("__c").over(w))
        return r.select(*by, col, "__c", (F.col("__hi") - F.col("__c") + 1).alias("__lo"), "__hi")
    vc = bucketed(vc, by, col)
    tot = vc.groupBy(*by, "__b").agg(F.sum("__c").alias("__t"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*by, "__b", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*by, "__b").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    r = attach(vc, off, by + ["__b"]).withColumn("__hi", F.col("__off") + F.sum("__c").over(inside))
    return r.select(*by, col, "__c", (F.col("__hi") - F.col("__c") + 1).alias("__lo"), "__hi")


def bucketed(values: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """The distinct values range-partitioned by (by, value), the partition's
    number as bucket ``__b``.  The number of partitions follows the number of
    values, so that a bucket holds about ``BUCKET_ROWS`` of them however many
    there are; the table is landed, because the numbers must not change."""
    size = values.agg(F.approx_count_distinct(F.struct(*by, col), 0.05)).first()[0]
    parts = max(1, -(-size // BUCKET_ROWS))
    return cut_lineage(values.repartitionByRange(parts, *by, col).withColumn("__b", F.spark_partition_id()),
                       how="parquet")


def order_values(df: DataFrame, col: str, ranks: Mapping[str, Callable[[Column], Column]],
                 by: Sequence[str] = ()) -> DataFrame:
    """Values at ranks given as functions of the group size n, one row per group.

    ``ranks={"lo": lambda n: F.floor((n + 1) / 2), ...}``; each output column
    is the value whose rank range contains that rank.
    """
    by = list(by)
    rr = rank_ranges(df, col, by)
    n = df.where(F.col(col).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    rr = attach(rr, n, by) if by else rr.withColumn("__n", n.select("__n").scalar())
    aggs = []
    for name, fn in ranks.items():
        r = fn(F.col("__n"))
        aggs.append(F.max(F.when((F.col("__lo") <= r) & (r <= F.col("__hi")), F.col(col))).alias(name))
    aggs.append(F.first("__n").alias("__n"))
    return rr.groupBy(*by).agg(*aggs)


def median_table(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "median",
                 method: str = "auto") -> DataFrame:
    """Exact median (mean of the middle pair for even n) per group."""
    by = list(by)
    if use_map(df, col, by, method):
        g = df.groupBy(*by) if by else df.groupBy()
        return g.agg(F.median(col).alias(out))
    v = order_values(df, col, {"__a": lambda n: F.floor((n + 1) / 2),
                               "__b2": lambda n: F.floor(n / 2) + 1}, by)
    v = v.select(*by, ((F.col("__a") + F.col("__b2")) / 2.0).alias(out))
    # groups without any value have a row as well, as on the map route
    return attach(df.select(*by).distinct(), v, by) if by else v


def stata_cut_ranks(j: int, k: int) -> dict[str, Callable[[Column], Column]]:
    """Ranks of the j/k Stata percentile: P = n j / k; integer -> mean of x[P],
    x[P+1], else x[ceil(P)]."""
    def r1(n):
        return F.when((n * j) % k == 0, (n * j / k).cast("long")).otherwise(F.ceil(n * j / k))

    def r2(n):
        return F.when((n * j) % k == 0, (n * j / k).cast("long") + 1).otherwise(F.ceil(n * j / k))

    return {f"__c{j}a": r1, f"__c{j}b": r2}


def stata_cuts_lazy(df: DataFrame, col: str, fracs: Sequence[tuple[int, int]],
                    by: Sequence[str] = ()) -> DataFrame:
    """Stata-rule percentiles j/k for several (j, k) pairs, one row per group,
    columns ``c{j}_{k}`` (distributed route)."""
    ranks = {}
    for j, k in fracs:
        for name, fn in stata_cut_ranks(j, k).items():
            ranks[f"{name}_{k}"] = fn
    v = order_values(df, col, ranks, by)
    return v.select(*by, *[((F.col(f"__c{j}a_{k}") + F.col(f"__c{j}b_{k}")) / 2.0).alias(f"c{j}_{k}")
                           for j, k in fracs])


def type7_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Linear-interpolation quantiles (R type 7 / Spark ``percentile``) per group
    by the distributed route: h = (n - 1) p + 1, value = x[floor h] +
    (h - floor h) (x[floor h + 1] - x[floor h])."""
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    ranks = {}
    for i, p in enumerate(probs):
        ranks[f"__l{i}"] = (lambda p_: lambda n: F.floor((n - 1) * p_ + 1))(p)
        ranks[f"__u{i}"] = (lambda p_: lambda n: F.least(F.floor((n - 1) * p_ + 1) + 1, n))(p)
    v = order_values(df, col, ranks, by)
    out = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(p) + 1
        frac = h - F.floor(h)
        out.append((F.col(f"__l{i}") + frac * (F.col(f"__u{i}") - F.col(f"__l{i}"))).alias(names[i]))
    return v.select(*by, *out)
