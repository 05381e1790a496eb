"""Aggregation operators (inventory A1-A15).

Everything is a ``groupBy().agg()`` (partial aggregation before the shuffle,
so a key that holds a third of the rows is reduced map-side) or a rewrite of
one.  Missing values are skipped; the sum of an all-missing group is 0
(M1), mean / max / median stay NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.functions.dates import PERIODS
from panora.operators.nullsafe import attach

AggFn = Callable[[Column], Column]

# Named aggregate functions usable in templates.  ``sum`` follows M1.
FUNCS: dict[str, AggFn] = {
    "mean": F.avg,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "median": F.median,
    "max": F.max,
    "min": F.min,
    "count": F.count,
    "sd": F.stddev_samp,
    "var": F.var_samp,
    "n_distinct": F.count_distinct,
}


def percentile_disc(col: str, p: float) -> Column:
    """Exact discrete percentile: the smallest value whose cumulative share is
    >= p (``percentile_disc(p) WITHIN GROUP (ORDER BY col)``)."""
    return F.expr(f"percentile_disc({float(p)!r}D) WITHIN GROUP (ORDER BY `{col}`)")


def _fn(f) -> AggFn:
    return FUNCS[f] if isinstance(f, str) else f


def _by(by) -> list:
    if by is None:
        return []
    return [by] if isinstance(by, (str, Column)) else list(by)


def aggregate(df: DataFrame, by, specs: Sequence[tuple[str, object, str]],
              method: str = "auto") -> DataFrame:
    """Grouped statistics ``[(output, function, column)]`` in one aggregation.

    Medians are the exception: with ``method="auto"`` they use the exact
    ``median`` aggregate while the largest group has few distinct values and
    otherwise the distributed rank route
    (:func:`panora.operators.quantiles.median_table`), joined on the keys.
    """
    from panora.operators.quantiles import median_table, use_map
    by = _by(by)
    med = [(o, c) for o, f, c in specs if isinstance(f, str) and f == "median"]
    if med and method != "map" and not use_map(df, sorted({c for _, c in med}), by, method):
        plain = [(o, f, c) for o, f, c in specs if not (isinstance(f, str) and f == "median")]
    else:
        plain, med = list(specs), []
    exprs = [_fn(f)(F.col(c)).alias(o) for o, f, c in plain]
    if exprs:
        out = df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)
    else:
        out = df.select(*by).distinct() if by else None
    for o, c in med:
        m = median_table(df, c, by, o, "distributed")
        out = m if out is None else (attach(out, m, by) if by else
                                     out.withColumn(o, m.select(o).scalar()))
    return out.select(*by, *[o for o, _, _ in specs])


# --------------------------------------------------------------------------- A1/A2/A8
def summarise_across(df: DataFrame, by, cols: Sequence[str],
                     fns: Mapping[str, object] | Sequence[str],
                     template: str = "{col}_{fn}", method: str = "auto") -> DataFrame:
    """Apply every function to every column in one aggregation.

    ``fns`` maps an output tag to a function name of :data:`FUNCS` or a
    ``Column -> Column`` aggregate.  Output names follow ``template``.
    Medians follow :func:`aggregate` (exact either way).
    """
    if not isinstance(fns, Mapping):
        fns = {f: f for f in fns}
    specs = [(template.format(col=c, fn=tag), f, c) for c in cols for tag, f in fns.items()]
    return aggregate(df, by, specs, method)


def collapse(df: DataFrame, by, spec: Mapping[str, Sequence[str]],
             rename: Mapping[str, str] | None = None) -> DataFrame:
    """Stata ``collapse (stat) vars, by()``: replaces the table by aggregates.

    ``spec`` maps a statistic to its columns, e.g. ``{"mean": ["x"],
    "sum": ["y"], "count": ["z"]}``; output columns keep the input names
    unless ``rename`` says otherwise.
    """
    rename = rename or {}
    specs = [(rename.get(c, c), stat, c) for stat, cols in spec.items() for c in cols]
    return aggregate(df, by, specs)


# --------------------------------------------------------------------------- A3
def sum_if(cond: Column, x: Column | str) -> Column:
    """Sum of ``x`` over rows where ``cond`` holds (0 when none, per M1)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.sum(F.when(cond, x)), F.lit(0))


def count_if(cond: Column) -> Column:
    return F.count_if(cond)


def cond_sums(df: DataFrame, by, x: str, category: str,
              sets: Mapping[str, Sequence], template: str = "{x}_{name}") -> DataFrame:
    """Sums of ``x`` restricted to several category sets, in one pass."""
    exprs = [sum_if(F.col(category).isin(list(vals)), x).alias(template.format(x=x, name=name))
             for name, vals in sets.items()]
    return df.groupBy(*_by(by)).agg(*exprs)


# --------------------------------------------------------------------------- A4
def freq(df: DataFrame, cols: Sequence[str], name: str = "n") -> DataFrame:
    """One- or multi-way frequency table (long form)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, name_template: str = "{v}",
             rest: str = "raise") -> DataFrame:
    """Two-way table in wide form; ``values`` of ``col`` are listed explicitly.  Rows with another value (or
    NULL) raise, or with ``rest="cell"`` are counted in one more column, so that no row is lost."""
    from panora.operators.reshape import REST, long_to_wide
    ones = df.select(row, col, F.lit(1).cast("long").alias("__n"))
    return long_to_wide(ones, [row], col, ["__n"], values, name_template.replace("{v}", "{level}"), "sum", rest).fillna(
        0, subset=[name_template.format(v=v) for v in [*values, *([REST] if rest == "cell" else [])]])


# --------------------------------------------------------------------------- A5
def share_within(df: DataFrame, by: Sequence[str], within: Sequence[str],
                 count: str = "n", share: str = "share") -> DataFrame:
    """Counts per ``by`` and their share of the ``within`` group total.

    The group totals are a second aggregation of the (small) count table
    joined back, not a window over raw rows.
    """
    by, within = list(by), list(within)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    tot = counts.groupBy(*within).agg(F.sum(count).alias("__tot"))
    return attach(counts, tot, within).withColumn(share, F.col(count) / F.col("__tot")).drop("__tot")


# --------------------------------------------------------------------------- A6
def rate_by_levels(df: DataFrame, levels: Sequence[Sequence[str]], num: Column, den: Column,
                   rate: str = "rate", level_name: str = "level") -> DataFrame:
    """Rate = count(num)/count(den) at several area levels in one pass.

    Uses GROUPING SETS (one scan, one shuffle); ``level_name`` carries the
    grouping id so rows of different levels are distinguishable.
    """
    cols = sorted({c for lv in levels for c in lv})
    sets = [[F.col(c) for c in lv] for lv in levels]
    g = df.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        F.count_if(num).alias("numerator"), F.count_if(den).alias("denominator"),
        F.grouping_id(*[F.col(c) for c in cols]).alias(level_name))
    return g.withColumn(rate, F.try_divide(F.col("numerator"), F.col("denominator")))


# --------------------------------------------------------------------------- A7
def per_unit(df: DataFrame, cols: Sequence[str], denom: str, template: str = "{col}_percap",
             scale: float = 1.0, keep: bool = True) -> DataFrame:
    """Per-capita / per-unit scaling of many columns in one projection."""
    new = [(F.try_divide(F.col(c) * F.lit(scale), F.col(denom))).alias(template.format(col=c))
           for c in cols]
    base = [F.col(c) for c in df.columns] if keep else []
    return df.select(*base, *new)


# --------------------------------------------------------------------------- A9
def resample(df: DataFrame, entity: str | Sequence[str], date_col: str, to: str = "year_week",
             mean: Sequence[str] = (), max: Sequence[str] = (), sum: Sequence[str] = (),
             period: str | None = None, extra_keys: Sequence[Column] = (),
             template: str = "{col}") -> DataFrame:
    """Down-sample a daily panel to week / month / day.

    Levels are averaged, cumulative counters take the max, flows are summed.
    One aggregation keyed on (entity, period); the period is a pure column
    expression, so filters on the period are pushed below it.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    period = period or to
    pcol = PERIODS[to](F.col(date_col)).alias(period)
    exprs = ([F.avg(c).alias(template.format(col=c)) for c in mean]
             + [F.max(c).alias(template.format(col=c)) for c in max]
             + [F.coalesce(F.sum(c), F.lit(0)).alias(template.format(col=c)) for c in sum])
    return df.groupBy(*ents, *extra_keys, pcol).agg(*exprs)


# --------------------------------------------------------------------------- A10
def rollup(df: DataFrame, to: str | Sequence[str], fns: Mapping[str, Sequence[str]],
           template: str = "{col}_{fn}", count: str | None = "n") -> DataFrame:
    """Roll-up in space (site -> county -> state) with named statistics."""
    specs = [(template.format(col=c, fn=f), f, c) for f, cols in fns.items() for c in cols]
    return aggregate(df, to, specs + ([(count, lambda _: F.count(F.lit(1)), df.columns[0])] if count else []))


# --------------------------------------------------------------------------- A11
MAD_SCALE = 1.4826  # fixed value: normal-consistency constant of the MAD


def winsorize(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
              c: float = 2.0, suffix: str = "", method: str = "auto") -> DataFrame:
    """Clip each column to median +/- c * 1.4826 * MAD, whole table or per group.

    Two passes (median, then median absolute deviation) whose per-group
    results are joined back; no group is ever gathered into a list.  Groups
    with one row or MAD = 0 are left unchanged.  ``method``: "map" uses the
    exact ``median`` aggregate (value -> count map per group), "distributed"
    the rank route of :mod:`panora.operators.quantiles` (bounded per task for
    any group size), "auto" picks by the largest approximate distinct count.
    """
    from panora.operators.quantiles import median_table, use_map
    by = list(by or [])
    cols = list(cols)
    counts = (df.groupBy(*by) if by else df.groupBy()).agg(F.count(F.lit(1)).alias("__n"))
    if use_map(df, cols, by, method):
        med = (df.groupBy(*by) if by else df.groupBy()).agg(
            *[F.median(x).alias(f"__med_{x}") for x in cols], F.count(F.lit(1)).alias("__n"))
        base = _attach(df, med, by)
        mad = (base.groupBy(*by) if by else base.groupBy()).agg(
            *[F.median(F.abs(F.col(x) - F.col(f"__med_{x}"))).alias(f"__mad_{x}") for x in cols])
        full = _attach(base, mad, by)
    else:
        base = _attach(df, counts, by)
        for x in cols:
            base = _attach(base, median_table(df, x, by, f"__med_{x}", "distributed"), by)
        full = base
        for x in cols:
            dev = base.select(*by, F.abs(F.col(x) - F.col(f"__med_{x}")).alias("__dev"))
            full = _attach(full, median_table(dev, "__dev", by, f"__mad_{x}", "distributed"), by)
    out = {}
    for x in cols:
        half = F.lit(c * MAD_SCALE) * F.col(f"__mad_{x}")
        lo, hi = F.col(f"__med_{x}") - half, F.col(f"__med_{x}") + half
        clipped = F.least(F.greatest(F.col(x), lo), hi)
        keep = (F.col("__n") <= 1) | (F.col(f"__mad_{x}") == 0) | F.col(x).isNull()
        out[x + suffix] = F.when(keep, F.col(x)).otherwise(clipped)
    res = full.withColumns(out)
    return res.select(*df.columns, *[k for k in out if k not in df.columns])


def _attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join per-group statistics back; whole-table statistics via scalar subqueries."""
    if by:
        return attach(df, stats, list(by))
    return df.withColumns({c: stats.select(c).scalar() for c in stats.columns})


# --------------------------------------------------------------------------- A12
def collect_values(df: DataFrame, by, col: str, name: str | None = None,
                   sort: bool = True) -> DataFrame:
    """Values of ``col`` per group as an array (sorted for determinism).

    Meant for small groups (one row per variable of an entity); the list size
    is the group size.
    """
    agg = F.collect_list(col)
    return df.groupBy(*_by(by)).agg((F.array_sort(agg) if sort else agg).alias(name or col))


def collect_chunks(df: DataFrame, by, col: str, size: int, name: str | None = None, order: Sequence = ()) -> DataFrame:
    """Values of ``col`` per group as arrays of at most ``size`` values: (by..., chunk, values).

    For groups of any size: the rows are numbered in ``order`` (default: the value) over range parts, so
    no task holds more than a chunk; the chunks in turn give :func:`collect_values`' list."""
    from panora.operators.ordering import number_rows
    by = _by(by)
    given = df.select(*by, *dict.fromkeys([col, *[o for o in order if isinstance(o, str)]])).filter(F.col(col).isNotNull())
    rows = number_rows(given, list(order) or [col], by, "__pos")
    chunk = F.expr(f"CAST((__pos - 1) DIV {int(size)} AS INT)").alias("chunk")
    pairs = F.array_sort(F.collect_list(F.struct("__pos", F.col(col).alias("v"))))
    return rows.groupBy(*by, chunk).agg(pairs.alias("__l")).select(*by, "chunk", F.col("__l.v").alias(name or col))


# --------------------------------------------------------------------------- A13
def stacked_summary(df: DataFrame, flags: Mapping[str, Column], cols: Sequence[str],
                    fns: Mapping[str, object], tag: str = "subset",
                    template: str = "{col}_{fn}") -> DataFrame:
    """Summary of overlapping subsets, stacked long in one pass.

    Each row is tagged with every subset it belongs to (``explode`` of an
    array of tags), then one ``groupBy(tag)``; no per-subset rescans.
    """
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in flags.items()])
    tagged = df.select(F.explode(F.array_compact(tags)).alias(tag), *cols)
    return summarise_across(tagged, tag, cols, fns, template)


# --------------------------------------------------------------------------- A14
def null_counts(df: DataFrame, cols: Sequence[str] | None = None,
                var: str = "variable", name: str = "n_missing") -> DataFrame:
    """Missing count per column, long (variable, n_missing, n_total)."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, var, name)
    return long.withColumnRenamed("__n", "n_total")


# --------------------------------------------------------------------------- A15
def distinct_counts(df: DataFrame, key: str, flags: Mapping[str, Column] | None = None,
                    by=None) -> DataFrame:
    """Distinct entities overall and under each flag (coverage per source)."""
    flags = flags or {}
    exprs = [F.count_distinct(key).alias(f"n_{key}")]
    exprs += [F.count_distinct(F.when(cond, F.col(key))).alias(f"n_{name}")
              for name, cond in flags.items()]
    by = _by(by)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)
