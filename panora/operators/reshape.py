"""Sort, top-k, categorical order, append (O1-O3, U1) and reshape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.operators.nullsafe import attach

REST = "rest"        # name of the cells of values outside the listed levels, NULL among them


class LevelError(ValueError):
    """Rows hold values that no listed level takes in, or there are more levels than the caller allows."""


def found_levels(df: DataFrame, col: str, max_levels: int) -> list:
    """The sorted levels of a column, at most as many as the caller allows."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise LevelError(f"{col} has more than {max_levels} levels")
    return [r[0] for r in rows]


def cells(df: DataFrame, listed: Column, name: Column, what: str, rest: str) -> Column:
    """The pivot column: ``name`` where ``listed`` holds, else the rest cell.  ``rest``: "raise"
    (one check over the rows), "cell" (they get a cell of their own) or "drop"."""
    if rest == "raise" and df.filter(~F.coalesce(listed, F.lit(False))).limit(1).count():
        raise LevelError(f"{what}: rows outside the listed levels; list them, or take rest='cell'")
    return F.when(F.coalesce(listed, F.lit(False)), name).otherwise(F.lit(REST))


# --------------------------------------------------------------------------- O1/O2
def sort(df: DataFrame, *keys: str | Column, desc: Sequence[bool] | bool = False) -> DataFrame:
    """Global sort (range-partitioned by Spark)."""
    flags = [desc] * len(keys) if isinstance(desc, bool) else list(desc)
    cols = [(F.col(k) if isinstance(k, str) else k) for k in keys]
    return df.orderBy(*[c.desc() if d else c.asc() for c, d in zip(cols, flags)])


def top_k(df: DataFrame, k: int, by: str, desc: bool = True,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` rows by a measure; ties broken by ``tiebreak`` (TakeOrdered)."""
    o = F.col(by).desc() if desc else F.col(by).asc()
    return df.orderBy(o, *[F.col(t).asc() for t in tiebreak]).limit(k)


def sort_position(df: DataFrame, by: str, desc: bool = False, tiebreak: Sequence = (),
                  out: str = "position", method: str = "auto") -> DataFrame:
    """Every row with its 1-based position in the order (by [desc], tiebreak...).

    The position is computed without moving the table, or rows that tie, into one
    task.  A numeric sort column with one numeric (unique) tiebreak takes the exact rank range of each distinct
    value (:func:`panora.operators.quantiles.rank_ranges`) and ranks ties by the same
    route inside the value; any other order is numbered over range parts
    (:func:`panora.operators.ordering.number_rows`).  Rows without a sort value stand last.
    """
    from panora.operators.ordering import number_rows
    from panora.operators.quantiles import rank_ranges
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float")
    kinds = dict(df.dtypes)
    if not (kinds.get(by) in numeric and len(tiebreak) == 1 and isinstance(tiebreak[0], str)
            and kinds.get(tiebreak[0]) in numeric):
        return number_rows(df, [(by, desc), *tiebreak], (), out)
    key = F.col(by)
    tmp = df.withColumn("__key", -key if desc else key)
    rr = rank_ranges(tmp, "__key", (), method=method).select("__key", "__lo")
    # rows without a sort value stand last
    last = df.select(F.count(by)).scalar() + 1
    tr = rank_ranges(tmp, tiebreak[0], ["__key"], method=method).select(
        "__key", tiebreak[0], F.col("__lo").alias("__tlo"))
    end = tmp.groupBy("__key").agg((F.count(tiebreak[0]) + 1).alias("__end"))
    return (attach(attach(attach(tmp, rr, ["__key"]), tr, ["__key", tiebreak[0]]), end, ["__key"])
            .withColumn(out, (F.coalesce("__lo", last) + F.coalesce("__tlo", "__end") - 1).cast("long"))
            .drop("__key", "__lo", "__tlo", "__end"))


# --------------------------------------------------------------------------- O3
def category_rank(col, levels: Sequence, unknown: int | None = None) -> Column:
    """Rank of a value in a custom categorical order (1-based; literal map)."""
    m = F.create_map(*[x for i, lv in enumerate(levels, 1) for x in (F.lit(lv), F.lit(i))])
    r = F.try_element_at(m, F.col(col) if isinstance(col, str) else col)
    return r if unknown is None else F.coalesce(r, F.lit(unknown))


# --------------------------------------------------------------------------- U1
def append(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


# --------------------------------------------------------------------------- R1
def wide_cast(df: DataFrame, ids: Sequence[str], keys: Sequence[str],
              levels: Sequence[Sequence], measures: Sequence[str],
              template: str = "{measure}{key_values}", agg: str = "sum",
              fill: float | None = 0, rest: str = "raise") -> DataFrame:
    """Multi-measure, multi-key wide cast (``dcast``) with composed names.

    The key combination is one pivot column with an explicit value list (no
    extra distinct job); cells without rows become ``fill`` (0 like the
    reference's sum of nothing).  ``template`` gets ``measure`` and
    ``key_values`` (e.g. ``sex1educationE2``).  Rows whose keys are not listed (or NULL) raise, or with
    ``rest="cell"`` make up one more cell per measure, so that no row is lost.
    """
    combos = list(product(*levels))
    names = ["".join(f"{k}{v}" for k, v in zip(keys, combo)) for combo in combos]
    keycol = F.concat(*[F.concat(F.lit(k), F.col(k).cast("string")) for k in keys])
    listed = reduce(lambda a, b: a & b, [F.col(k).isin(list(lv)) for k, lv in zip(keys, levels)])
    fn = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}[agg]
    shown = names + ([REST] if rest == "cell" else [])
    p = df.withColumn("__cell", cells(df, listed, keycol, f"wide_cast by {list(keys)}", rest)).groupBy(*ids).pivot(
        "__cell", shown).agg(*[fn(m).alias(m) for m in measures])
    ren = {}
    for nm in shown:
        for m in measures:
            src = f"{nm}_{m}" if len(measures) > 1 else nm
            ren[src] = template.format(measure=m, key_values=nm)
    p = p.withColumnsRenamed(ren)
    if fill is not None:
        p = p.fillna(fill, subset=list(ren.values()))
    return p


# --------------------------------------------------------------------------- R2
def long_to_wide(df: DataFrame, ids: Sequence[str], key: str, values: Sequence[str],
                 levels: Sequence | None = None, template: str = "{value}_{level}", agg: str = "first",
                 rest: str = "raise", max_levels: int | None = None) -> DataFrame:
    """``pivot_wider``/``reshape wide`` with explicit levels, or with those found in the data (as many as
    ``max_levels`` allows).  Other values of the key raise or get the rest cell, as in :func:`wide_cast`."""
    if levels is None:
        levels = found_levels(df, key, max_levels or 0)
    fn = {"first": lambda c: F.first(c, ignorenulls=True), "sum": F.sum, "mean": F.avg,
          "max": F.max}[agg]
    cell = cells(df, F.col(key).isin(list(levels)), F.col(key).cast("string"), f"long_to_wide by {key}", rest)
    names = [str(lv) for lv in levels]
    if not all(isinstance(lv, (str, int)) and not isinstance(lv, bool) for lv in levels):     # as Spark writes them
        kind = df.schema[key].dataType
        names = list(df.sparkSession.range(1).select(*[F.lit(lv).cast(kind).cast("string") for lv in levels]).first())
    shown = [*zip(names, levels), *([(REST, REST)] if rest == "cell" else [])]
    p = df.withColumn("__cell", cell).groupBy(*ids).pivot("__cell", [n for n, _ in shown]).agg(
        *[fn(v).alias(v) for v in values])
    ren = {}
    for nm, lv in shown:
        for v in values:
            src = f"{nm}_{v}" if len(values) > 1 else nm
            ren[src] = template.format(value=v, level=lv)
    return p.withColumnsRenamed(ren)


# --------------------------------------------------------------------------- R3
def wide_to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                 var: str = "variable", value: str = "value") -> DataFrame:
    """``melt`` / ``gather``; NULL cells are kept (INCLUDE NULLS)."""
    return df.unpivot(list(ids), list(cols), var, value)


# --------------------------------------------------------------------------- R4
def one_hot(df: DataFrame, col: str, stub: str, levels: Sequence | None = None,
            max_levels: int | None = None) -> DataFrame:
    """``tabulate, generate(stub)``: one 0/1 column per level, numbered in sort order.

    Levels are the sorted distinct values; ``max_levels`` lets the caller bound the number of columns.
    NULL input gives NULL indicators.
    """
    if levels is None:
        levels = found_levels(df, col, max_levels if max_levels is not None else 2 ** 31 - 2)
    x = F.col(col)
    new = {f"{stub}{i}": F.when(x.isNull(), F.lit(None).cast("int"))
           .otherwise(F.when(x == F.lit(lv), 1).otherwise(0))
           for i, lv in enumerate(levels, start=1)}
    return df.withColumns(new)


# --------------------------------------------------------------------------- R5
def status_matrix(df: DataFrame, unit: str, time: str, value: str, times: Sequence | None = None,
                  template: str = "t{t}", agg: str = "max", rest: str = "raise",
                  max_times: int | None = None) -> DataFrame:
    """Unit x time matrix of a status or outcome (missing cells stay NULL).  The periods are listed or, up to
    ``max_times``, those of the data; rows outside raise or get the rest cell."""
    return long_to_wide(df, [unit], time, [value], times, template.replace("{t}", "{level}"), agg, rest, max_times)
