"""Window-type operators (inventory W1-W7).

Group statistics are computed with an aggregation and joined back rather
than with a window partitioned by the group: the aggregation is reduced
map-side, so a hot group never has to fit into one task.  Whole-table
statistics are scalar subqueries (no un-partitioned window).  The time lag is
an equi-join on (entity, period), which spreads even a huge entity over many
partitions.  Carry-forward is the one operator that needs order inside an
entity; it is computed in time chunks so a long series is split across tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panora.operators.aggregate import FUNCS, percentile_disc
from panora.operators.nullsafe import attach


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


# --------------------------------------------------------------------------- W1
def group_stat(df: DataFrame, by, stats: Mapping[str, tuple[str, str]],
               method: str = "auto") -> DataFrame:
    """Attach group statistics to every row: ``{"out": ("max", "x")}``.

    Medians go through :func:`panora.operators.quantiles.median_table`
    (distributed route when groups are large); the rest is one aggregation.
    """
    from panora.operators.quantiles import median_table
    by = _by(by)
    plain = {o: fc for o, fc in stats.items() if fc[0] != "median"}
    out = df
    if plain:
        agg = df.groupBy(*by).agg(*[FUNCS[f](F.col(c)).alias(o) for o, (f, c) in plain.items()])
        out = attach(out, agg, by)
    for o, (f, c) in stats.items():
        if f == "median":
            out = attach(out, median_table(df, c, by, o, method), by)
    return out


# --------------------------------------------------------------------------- W2
def table_stat(df: DataFrame, stats: Mapping[str, tuple[str, str]], method: str = "auto") -> DataFrame:
    """Attach whole-table statistics (``egen m = mean(x)``) as scalar subqueries."""
    from panora.operators.quantiles import median_table
    cols = {}
    for out, (f, c) in stats.items():
        if f == "median":
            cols[out] = median_table(df, c, (), "__m", method).select("__m").scalar()
        else:
            cols[out] = df.select(FUNCS[f](F.col(c))).scalar()
    return df.withColumns(cols)


# --------------------------------------------------------------------------- W3
def locf(df: DataFrame, entity, time: str, cols: Sequence[str],
         chunk: int | None = None) -> DataFrame:
    """Carry the last non-missing value forward within each entity.

    Rows without a period stand last, so nothing is carried from them into a period.
    The rows are swept in range parts of (entity, period)
    (:func:`panora.operators.ordering.carry_forward`): periods of any sortable type, and an entity
    with a large share of the rows is spread over many tasks.  ``chunk=0`` uses one window
    over the entity, for entities known to be short; both give the same values.
    """
    from panora.operators.ordering import carry_forward
    ents = _by(entity)
    cols = list(cols)
    if chunk == 0:
        w = Window.partitionBy(*ents).orderBy(F.col(time).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    return carry_forward(df, ents, [time], cols)


# --------------------------------------------------------------------------- W4
def time_lag(df: DataFrame, entity, time: str, cols: Sequence[str], k: int = 1,
             template: str = "L{k}_{col}", check: bool = True) -> DataFrame:
    """``L.x``: value of the period ``t - k``; missing when that period is absent.

    An equi-join of the panel with itself shifted by ``k`` periods on the
    (entity, time) key, which must be unique (duplicates raise, as they would
    multiply rows).  Requires an integer period; a NULL period has no lag.
    """
    ents = _by(entity)
    if check and df.filter(F.col(time).isNotNull()).groupBy(*ents, time).count() \
            .filter(F.col("count") > 1).limit(1).count():
        raise ValueError(f"time_lag: repeated values of {ents + [time]}")
    shifted = df.select(*ents, (F.col(time) + F.lit(k)).alias(time),
                        *[F.col(c).alias(template.format(k=k, col=c)) for c in cols])
    return attach(df, shifted, ents + [time], plain=[time])


def time_lead(df: DataFrame, entity, time: str, cols: Sequence[str], k: int = 1,
              template: str = "F{k}_{col}", check: bool = True) -> DataFrame:
    return time_lag(df, entity, time, cols, -k, template.replace("{k}", str(k)), check)


# --------------------------------------------------------------------------- W5
def xtile_cuts(df: DataFrame, col: str, nq: int, method: str = "auto") -> list[float]:
    """Cut-points of Stata ``xtile, nq()`` (M4), computed on the executors.

    For p = j/nq and P = n*p: if P is an integer the cut is the mean of the
    P-th and (P+1)-th order statistics, else the ceil(P)-th.  Order statistic
    r is ``percentile_disc((r - 0.5)/n)`` evaluated in one aggregation; only
    n and the nq-1 cut values reach the driver.
    """
    from panora.operators.quantiles import stata_cuts_lazy, use_map
    if not use_map(df, col, (), method):
        row = stata_cuts_lazy(df, col, [(j, nq) for j in range(1, nq)]).first()
        if row is None:
            return [None] * (nq - 1)
        return [row[f"c{j}_{nq}"] for j in range(1, nq)]
    n = df.select(F.count(F.col(col))).first()[0]
    if n == 0:
        return [None] * (nq - 1)
    need: dict[int, None] = {}
    plan = []
    for j in range(1, nq):
        if (n * j) % nq == 0:
            r = n * j // nq
            plan.append((r, min(r + 1, n)))
            need[r] = need[min(r + 1, n)] = None
        else:
            r = -(-n * j // nq)
            plan.append((r,))
            need[r] = None
    ranks = sorted(need)
    exprs = [percentile_disc(col, (r - 0.5) / n).alias(f"r{r}") for r in ranks]
    row = df.agg(*exprs).first()
    val = {r: row[f"r{r}"] for r in ranks}
    return [(val[p[0]] + val[p[1]]) / 2.0 if len(p) == 2 else float(val[p[0]]) for p in plan]


def bin_by_cuts(col, cuts: Sequence[float]) -> Column:
    """Bin number 1..len(cuts)+1 with ``x <= cut`` going to the lower bin."""
    x = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, c in enumerate(cuts, start=1):
        cond = x <= F.lit(c)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    top = F.lit(len(cuts) + 1)
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(
        (expr.otherwise(top) if expr is not None else top)).cast("int")


def xtile(df: DataFrame, col: str, nq: int, out: str | None = None,
          method: str = "auto") -> DataFrame:
    """Quantile group 1..nq of ``col`` with Stata's tie rule (not ``ntile``)."""
    cuts = xtile_cuts(df, col, nq, method)
    return df.withColumn(out or f"{col}_q{nq}", bin_by_cuts(col, cuts))


# --------------------------------------------------------------------------- W6
def flag(col, op: str, value, missing: str = "null") -> Column:
    """0/1 indicator of ``col <op> value``.

    ``missing="null"``: NULL input gives NULL.  ``missing="stata"``: missing
    sorts above every number (M2), so ``>``/``>=``/``!=`` are 1 and
    ``<``/``<=``/``==`` are 0.
    """
    x = F.col(col) if isinstance(col, str) else col
    v = value if isinstance(value, Column) else F.lit(value)
    ops = {">": x > v, ">=": x >= v, "<": x < v, "<=": x <= v, "==": x == v, "!=": x != v}
    ind = F.when(ops[op], 1).otherwise(0)
    if missing == "stata":
        return F.when(x.isNull(), F.lit(1 if op in (">", ">=", "!=") else 0)).otherwise(ind)
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(ind)


def high_low(df: DataFrame, col: str, by: str = "median", out: str | None = None,
             missing: str = "null", method: str = "auto") -> DataFrame:
    """Indicator of ``col`` above its whole-table mean or median (scalar subquery)."""
    from panora.operators.quantiles import median_table
    if by == "median":
        thr = median_table(df, col, (), "__m", method).select("__m").scalar()
    else:
        thr = df.select(F.avg(F.col(col))).scalar()
    return df.withColumn(out or f"{col}_high", flag(col, ">", thr, missing))


# --------------------------------------------------------------------------- W7
def latest(df: DataFrame, time: str, entity=None) -> DataFrame:
    """Rows of the latest period, of the whole table or per entity."""
    if entity is None:
        return df.filter(F.col(time) == df.select(F.max(time)).scalar())
    ents = _by(entity)
    last = df.groupBy(*ents).agg(F.max(time).alias(time))
    return attach(df, last, ents + [time], "left_semi")
