"""Profiling and descriptive statistics (inventory D1-D15).

Moments are one wide aggregation over all requested columns (one scan), then
unpivoted to long ``(variable, stat...)`` rows.  Whatever needs order (full describe,
codebook, six numbers) reads one table of value counts of all columns together
(:func:`value_counts`): one scan, one shuffle, running counts per variable.
Exact ranks (Spearman) come from a distributed prefix sum
over the distinct-value table, never from an un-partitioned window over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.functions.tails import t_two_sided
from panora.operators.nullsafe import attach
from panora.operators.aggregate import MAD_SCALE
from panora.sources.writers import cut_lineage


def _long(wide: DataFrame, cols: Sequence[str], stats: Sequence[str],
          var: str = "variable") -> DataFrame:
    """Turn ``{col}__{stat}`` columns of a one-row frame into (variable, stats...).

    One projection (``inline`` of an array of structs), so the aggregate
    feeding it is computed once rather than once per variable.
    """
    rows = [F.struct(F.lit(c).alias(var), *[F.col(f"{c}__{s}").alias(s) for s in stats])
            for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, x, w, c), landed: how often every column has every value, NULL included.

    The columns are unpivoted, so one scan and one shuffle serve all of them; ``x`` is the value
    as a double, ``w`` keeps whole numbers exact."""
    whole = {c for c, t in df.dtypes if t in ("int", "bigint", "smallint", "tinyint")}
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x"),
                      (F.col(c).cast("long") if c in whole else F.lit(None).cast("long")).alias("w")) for c in cols]
    long = df.select(F.inline(F.array(*pairs)))
    return cut_lineage(long.groupBy("variable", "x", "w").agg(F.count(F.lit(1)).alias("c")), how="parquet")


def _ranked(counts: DataFrame, method: str) -> DataFrame:
    """(variable, x, lo, hi, n): the exact rank range of every value and the variable's size."""
    from panora.operators.quantiles import MAP_MAX_DISTINCT, ranges_of_counts
    some = counts.filter(F.col("x").isNotNull()).withColumnRenamed("c", "__c")
    sizes = some.groupBy("variable").agg(F.sum("__c").alias("n"), F.count(F.lit(1)).alias("values"))
    small = method == "map"
    if method == "auto":
        small = (sizes.agg(F.max("values")).first()[0] or 0) <= MAP_MAX_DISTINCT
    r = ranges_of_counts(some, ["variable"], "x", small)
    return r.join(F.broadcast(sizes.drop("values")), "variable").select(      # one row per column
        "variable", "x", F.col("__lo").alias("lo"), F.col("__hi").alias("hi"), "n")


def _at(rank: Column) -> Column:
    """The value at a rank (an aggregate over a variable's ranked values)."""
    return F.max(F.when((F.col("lo") <= rank) & (rank <= F.col("hi")), F.col("x")))


def _median() -> Column:
    n = F.col("n")
    return (_at(F.floor((n + 1) / 2)) + _at(F.floor(n / 2) + 1)) / 2


def _stata_percentile(p: float) -> Column:
    """P = n p; whole -> mean(x[P], x[P+1]), else x[ceil P]."""
    num, one = round(p * 1_000_000), 1_000_000
    scaled = F.col("n") * num
    exact = scaled % one == 0
    at = F.when(exact, (scaled / one).cast("long")).otherwise(F.ceil(scaled / one))
    return (_at(F.greatest(at, F.lit(1))) + _at(F.least(F.when(exact, at + 1).otherwise(at), F.col("n")))) / 2


def stata_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                      method: str = "auto") -> dict:
    """Stata-rule percentiles of several columns; only these reach the driver."""
    counts = value_counts(df, cols)
    rows = _ranked(counts, method).groupBy("variable").agg(*[_stata_percentile(p) for p in probs]).collect()
    return {**{c: [None] * len(probs) for c in cols}, **{r[0]: list(r[1:]) for r in rows}}


def _type7(p: float) -> Column:
    h = (F.col("n") - 1) * F.lit(p) + 1
    lower = F.floor(h)
    return _at(lower) + F.max(h - lower) * (_at(F.least(lower + 1, F.col("n"))) - _at(lower))


def _moments(counts: DataFrame) -> DataFrame:
    """(variable, total, n, values, mean, min, max, m2, m3, m4): sums of powers about the mean."""
    x, c = F.col("x"), F.col("c")
    some = F.when(x.isNotNull(), c)
    first = counts.groupBy("variable").agg(
        F.sum("c").alias("total"), F.coalesce(F.sum(some), F.lit(0)).alias("n"), F.count("x").alias("values"),
        F.try_divide(F.sum(x * c), F.sum(some)).alias("mean"), F.min("x").alias("min"), F.max("x").alias("max"))
    d = x - F.col("mean")
    powers = counts.join(F.broadcast(first.select("variable", "mean")), "variable").groupBy("variable").agg(
        *[F.sum(c * F.pow(d, F.lit(k))).alias(f"m{k}") for k in (2, 3, 4)])
    return first.join(powers, "variable")


def _sd() -> Column:
    return F.sqrt(F.try_divide(F.col("m2"), F.when(F.col("n") > 1, F.col("n") - 1)))


def _variables(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "variable string, type string")


# --------------------------------------------------------------------------- D1
def describe(df: DataFrame, cols: Sequence[str] | None = None, fast: bool = True,
             trim: float = 0.1, method: str = "auto") -> DataFrame:
    """``psych::describe``: n, mean, sd, min, max, range, se (+ median, trimmed
    mean, mad, skew, kurtosis when ``fast=False``; skew/kurtosis are psych's
    type 3: m3/s^3 and m4/s^4 - 3 with the sample sd s).

    Full mode reads one table of value counts of all columns (:func:`value_counts`).
    """
    cols = list(cols or [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float",
                                                          "smallint", "tinyint")])
    ex = []
    for c in cols:
        x = F.col(c)
        ex += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
               F.stddev_samp(x).alias(f"{c}__sd"), F.min(x).cast("double").alias(f"{c}__min"),
               F.max(x).cast("double").alias(f"{c}__max")]
    if fast:
        long = _long(df.agg(*ex), cols, ["n", "mean", "sd", "min", "max"])
        long = long.withColumns({"range": F.col("max") - F.col("min"),
                                 "se": F.col("sd") / F.sqrt(F.col("n"))})
        return long.select("variable", "n", "mean", "sd", "min", "max", "range", "se")
    counts = value_counts(df, cols)
    ranked = _ranked(counts, method)
    k = F.floor(F.col("n") * F.lit(trim))
    inner = F.greatest(F.least(F.col("hi"), F.col("n") - k) - F.greatest(F.col("lo"), k + 1) + 1, F.lit(0))
    order = ranked.groupBy("variable").agg(_median().alias("median"), F.try_divide(
        F.sum(F.col("x") * inner), F.max(F.col("n") - 2 * k)).alias("trimmed"))
    off = counts.filter(F.col("x").isNotNull()).join(F.broadcast(order), "variable").groupBy(
        "variable", F.abs(F.col("x") - F.col("median")).alias("x")).agg(F.sum("c").alias("c"))
    mad = _ranked(off, method).groupBy("variable").agg((_median() * MAD_SCALE).alias("mad"))
    sd, n = F.col("sd"), F.col("n")
    out = (_variables(df, cols).join(_moments(counts).join(order, "variable", "left").join(mad, "variable", "left"), "variable", "left")
           .withColumn("sd", _sd()))
    return out.select("variable", F.coalesce("n", F.lit(0)).alias("n"), "mean", "sd", "median", "trimmed", "mad", "min", "max",
                      (F.col("max") - F.col("min")).alias("range"),
                      F.try_divide(F.col("m3") / n, F.pow(sd, F.lit(3))).alias("skew"),
                      (F.try_divide(F.col("m4") / n, F.pow(sd, F.lit(4))) - 3).alias("kurtosis"),
                      (sd / F.sqrt(n)).alias("se"))


def trimmed_means(df: DataFrame, cols: Sequence[str], trim: float = 0.1) -> DataFrame:
    """R ``mean(x, trim)`` per column (exact; see :func:`describe`)."""
    d = describe(df, cols, fast=False, trim=trim)
    return d.select("variable", "trimmed")


# --------------------------------------------------------------------------- D2
CODEBOOK_PROBS = (0.10, 0.25, 0.50, 0.75, 0.90)


def codebook(df: DataFrame, cols: Sequence[str] | None = None, method: str = "auto") -> DataFrame:
    """Stata ``codebook``: type, range, distinct, missing/total, mean, sd, p10-p90.

    All of it from one table of value counts of all columns; percentiles by Stata's rule.
    """
    cols = list(cols or [c for c, t in df.dtypes if t in ("int", "bigint", "double")])
    counts = value_counts(df, cols)
    pct = _ranked(counts, method).groupBy("variable").agg(
        *[_stata_percentile(p).alias(f"p{round(p * 100)}") for p in CODEBOOK_PROBS])
    out = _variables(df, cols).join(_moments(counts).join(pct, "variable", "left"), "variable", "left")
    zero = F.lit(0)
    return out.select("variable", "type", "min", "max", F.coalesce("values", zero).alias("n_distinct"),
                      F.coalesce(F.col("total") - F.col("n"), zero).alias("n_missing"), "mean", _sd().alias("sd"),
                      F.coalesce("total", zero).alias("n_total"), *[f"p{round(p * 100)}" for p in CODEBOOK_PROBS])


# --------------------------------------------------------------------------- D3
def summarize(df: DataFrame, cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Stata ``summarize``: obs, sum of weights, mean, variance, sd, min, max, sum."""
    ex = []
    for c in cols:
        x = F.col(c)
        w = F.col(weight) if weight else F.lit(1.0)
        ex += [F.count(x).alias(f"{c}__obs"),
               F.sum(F.when(x.isNotNull(), w)).cast("double").alias(f"{c}__sum_w"),
               (F.sum(x * w) / F.sum(F.when(x.isNotNull(), w))).alias(f"{c}__mean"),
               F.min(x).cast("double").alias(f"{c}__min"), F.max(x).cast("double").alias(f"{c}__max")]
        if weight is None:
            ex += [F.var_samp(x).alias(f"{c}__variance"), F.stddev_samp(x).alias(f"{c}__sd"),
                   F.sum(x).cast("double").alias(f"{c}__sum")]
        else:
            # analytic weights, rescaled to sum to the number of observations:
            # variance = n / (n - 1) * sum w (x - mean)^2 / sum w, with moments
            # about an unweighted provisional centre
            centre = df.select(F.avg(x)).scalar()
            ws = F.sum(F.when(x.isNotNull(), w))
            d = (x - centre).cast("double")
            var = F.when(F.count(x) > 1, F.count(x) / (F.count(x) - 1)
                         * (F.sum(d * d * w) / ws - F.pow(F.sum(d * w) / ws, 2)))
            ex += [var.alias(f"{c}__variance"), F.sqrt(var).alias(f"{c}__sd"),
                   F.sum(x * w).cast("double").alias(f"{c}__sum")]
    return _long(df.agg(*ex), cols,
                 ["obs", "sum_w", "mean", "variance", "sd", "min", "max", "sum"])


# --------------------------------------------------------------------------- D4
def six_number(df: DataFrame, cols: Sequence[str], method: str = "auto") -> DataFrame:
    """R ``summary``: min, q1, median, mean, q3, max (type-7 quantiles) + NA count, from one
    table of value counts of all columns."""
    cols = list(cols)
    counts = value_counts(df, cols)
    order = _ranked(counts, method).groupBy("variable").agg(
        *[_type7(p).alias(c) for c, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    out = _variables(df, cols).join(_moments(counts).join(order, "variable", "left"), "variable", "left")
    return out.select("variable", "min", "q1", "median", "mean", "q3", "max",
                      F.coalesce(F.col("total") - F.col("n"), F.lit(0)).alias("n_na"))


# --------------------------------------------------------------------------- D5
def balance_table(df: DataFrame, group: str, cols: Sequence[str],
                  levels: Sequence = (0, 1)) -> DataFrame:
    """Mean and SD of each variable by a 0/1 group, one row per variable."""
    ex = []
    for lv in levels:
        sel = F.col(group) == F.lit(lv)
        for c in cols:
            x = F.when(sel, F.col(c))
            ex += [F.count(x).alias(f"{c}__n_{lv}"), F.avg(x).alias(f"{c}__mean_{lv}"),
                   F.stddev_samp(x).alias(f"{c}__sd_{lv}")]
    stats = [f"{s}_{lv}" for lv in levels for s in ("n", "mean", "sd")]
    return _long(df.agg(*ex), cols, stats)


# --------------------------------------------------------------------------- D6
def welch_test(df: DataFrame, group: str, cols: Sequence[str], levels: Sequence = (1, 0),
               with_p: bool = True) -> DataFrame:
    """Welch two-sample t-test of each variable between two groups.

    Group moments come from one aggregation; t and the Welch-Satterthwaite df
    and the p-value are column expressions; a variable without variation in both groups has none.
    """
    a, b = levels
    ex = []
    for c in cols:
        for tag, lv in (("1", a), ("2", b)):
            x = F.when(F.col(group) == F.lit(lv), F.col(c))
            ex += [F.count(x).alias(f"{c}__n{tag}"), F.avg(x).alias(f"{c}__mean{tag}"),
                   F.var_samp(x).alias(f"{c}__var{tag}")]
    long = _long(df.agg(*ex), cols, ["n1", "mean1", "var1", "n2", "mean2", "var2"])
    s1 = F.try_divide(F.col("var1"), F.col("n1"))
    s2 = F.try_divide(F.col("var2"), F.col("n2"))
    long = long.withColumns({
        "t": F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(s1 + s2)),
        "df": F.try_divide(F.pow(s1 + s2, 2), F.pow(s1, 2) / (F.col("n1") - 1) + F.pow(s2, 2) / (F.col("n2") - 1)),
    })
    out = long.select("variable", "n1", "n2", "mean1", "mean2", "t", "df")
    if not with_p:
        return out
    return out.withColumn("p", t_two_sided(F.col("t"), F.col("df")))


# --------------------------------------------------------------------------- D7
def rank_tables(df: DataFrame, cols: Sequence[str],
                method: str = "auto") -> dict[str, DataFrame]:
    """(value -> average rank) table of each column, computed distributed.

    Built on :func:`panora.operators.quantiles.rank_ranges`: each distinct
    value gets its rank range [lo, hi] from value counts, range-partitioned
    buckets, a small offset table and windows inside buckets; ties share the
    average rank (lo + hi) / 2.
    """
    from panora.operators.quantiles import rank_ranges, use_map
    if method == "auto":  # one distinct-count job decides for all columns
        method = "map" if use_map(df, cols, (), "auto") else "distributed"
    return {c: rank_ranges(df, c, (), method=method).select(
        c, ((F.col("__lo") + F.col("__hi")) / 2.0).alias("__rank")) for c in cols}


def average_ranks(df: DataFrame, cols: Sequence[str] | str, template: str = "{col}_rank",
                  method: str = "auto") -> DataFrame:
    """Attach the average (tie-sharing) rank of each column to every row.

    Every rank table is built from the same input and joined back on the value
    (AQE splits a hot value's partition if one value dominates).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    out = df
    for c, t in rank_tables(df, cols, method).items():
        out = out.join(t.withColumnRenamed("__rank", template.format(col=c)), c, "left")
    return out


def spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman correlation matrix (long), complete cases only."""
    cols = list(cols)
    d = df.select(*cols).dropna()
    r = average_ranks(d, cols, template="__r_{col}")
    return pearson(r, [f"__r_{c}" for c in cols], names=cols, with_p=False)


# --------------------------------------------------------------------------- D8
def pearson(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None,
            with_p: bool = True, listwise: bool = True) -> DataFrame:
    """Pearson correlation matrix in long form (var1, var2, r, n [, p])."""
    names = list(names or cols)
    d = df.select(*cols).dropna() if listwise else df
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols))]
    ex = [F.count(F.lit(1)).alias("__n")]
    # a column without variation has no correlation
    ex += [F.try_divide(F.covar_samp(cols[i], cols[j]), F.stddev_samp(cols[i]) * F.stddev_samp(cols[j])).alias(f"__r{i}_{j}")
           for i, j in pairs if i < j]
    wide = d.agg(*ex)
    rows = []
    for i, j in pairs:
        r = F.lit(1.0) if i == j else F.col(f"__r{min(i, j)}_{max(i, j)}")
        rows.append(F.struct(F.lit(names[i]).alias("var1"), F.lit(names[j]).alias("var2"),
                             r.alias("r"), F.col("__n").alias("n")))
    long = wide.select(F.inline(F.array(*rows)))
    if not with_p:
        return long
    r, more = F.col("r"), F.col("n") - 2
    t = r * F.sqrt(more / (1 - r * r))
    return long.withColumn("p", F.when(F.abs(r) >= 1, 0.0).when(more > 0, t_two_sided(t, more)))


# --------------------------------------------------------------------------- D9
def histogram(df: DataFrame, col: str, width: float | None = None, bins: int = 30,
              log: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins from the smallest finite value: (bin, lo, hi, n).  Infinite values and NaN
    have rows of their own, without a bin number, whose borders are the value."""
    x = (F.log1p(F.col(col)) if log else F.col(col)).cast("double")
    d = df.select(*by, x.alias("__x")).where(F.col("__x").isNotNull())
    finite = F.abs(F.col("__x")) < F.lit(float("inf"))
    known = d.filter(finite)
    lo = known.select(F.min("__x")).scalar()
    if width is None:
        hi = known.select(F.max("__x")).scalar()
        w = F.when(hi > lo, (hi - lo) / F.lit(bins)).otherwise(F.lit(1.0))
        b = F.least(F.floor((F.col("__x") - lo) / w), F.lit(bins - 1))
    else:
        w = F.lit(float(width))
        b = F.floor((F.col("__x") - lo) / w)
    g = d.select(*by, F.when(finite, b).cast("int").alias("bin"), F.when(~finite, F.col("__x")).alias("__odd"),
                 lo.alias("__lo"), w.alias("__w"))
    return g.groupBy(*by, "bin", "__odd").agg(
        F.coalesce(F.first("__lo") + F.col("bin") * F.first("__w"), F.col("__odd")).alias("lo"),
        F.coalesce(F.first("__lo") + (F.col("bin") + 1) * F.first("__w"), F.col("__odd")).alias("hi"),
        F.count(F.lit(1)).alias("n")).drop("__odd")


# --------------------------------------------------------------------------- D10
def box_stats(df: DataFrame, col: str, by: Sequence[str], method: str = "auto") -> DataFrame:
    """Box-plot numbers per group: quartiles (type 7), whiskers at 1.5 IQR, outliers."""
    from panora.operators.quantiles import type7_quantiles, use_map
    by = list(by)
    n = df.groupBy(*by).agg(F.count(F.col(col)).alias("n"))
    if use_map(df, col, by, method):
        q = df.groupBy(*by).agg(
            F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("__q"))
        q = q.select(*by, F.get("__q", 0).alias("q1"), F.get("__q", 1).alias("median"),
                     F.get("__q", 2).alias("q3"))
    else:
        q = type7_quantiles(df, col, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"])
    q = attach(n, q, by).withColumn("iqr", F.col("q3") - F.col("q1"))
    j = attach(df.select(*by, col), q.drop("n"), by)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    x = F.col(col)
    w = j.groupBy(*by).agg(
        F.min(F.when(x >= lo_f, x)).cast("double").alias("whisker_lo"),
        F.max(F.when(x <= hi_f, x)).cast("double").alias("whisker_hi"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers"))
    return attach(q, w, by).select(*by, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi",
                                "n_outliers")


# --------------------------------------------------------------------------- D11
def panel_structure(df: DataFrame, entity: str, time: str) -> DataFrame:
    """``xtdescribe``/``pdim`` summary in one row.

    n_entities, n_periods (distinct), first/last period, min/mean/max T_i,
    n_obs and whether the panel is balanced.
    """
    per = df.groupBy(entity).agg(F.count_distinct(time).alias("__ti"))
    stats = per.agg(F.count(F.lit(1)).alias("n_entities"),
                    F.min("__ti").alias("min_ti"), F.avg("__ti").alias("mean_ti"),
                    F.max("__ti").alias("max_ti"), F.sum("__ti").alias("n_obs"))
    tp = df.agg(F.count_distinct(time).alias("n_periods"), F.min(time).alias("first_period"),
                F.max(time).alias("last_period"))
    # two one-row frames: a scalar-subquery projection keeps this join-free
    out = stats.withColumns({c: tp.select(c).scalar() for c in tp.columns})
    return out.withColumn("balanced",
                          ((F.col("min_ti") == F.col("max_ti")) &
                           (F.col("max_ti") == F.col("n_periods"))).cast("int"))


WORD_BITS = 62


def participation_patterns(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Participation patterns: '1' present / '.' absent over the period range (numbers or dates; rows without a
    period do not count).

    An entity's periods are bits, ``WORD_BITS`` to a word, set by ``bit_or`` per (entity, word): a partial
    aggregate of fixed size however many rows an entity has.  The pattern is the entity's words in order.
    """
    dated = dict(df.dtypes)[time] in ("date", "timestamp", "timestamp_ntz")
    at = F.unix_date(F.to_date(time)).cast("long") if dated else F.col(time).cast("long")
    d = df.select(F.col(entity).alias("e"), at.alias("t")).filter(F.col("t").isNotNull())
    lo, hi = d.select(F.min("t")).scalar(), d.select(F.max("t")).scalar()
    word = F.floor((F.col("t") - lo) / WORD_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("t") - lo, F.lit(WORD_BITS)).cast("int"))
    words = d.groupBy("e", word.cast("int").alias("w")).agg(F.bit_or(bit).alias("b"))
    # per entity at most (range / WORD_BITS) words
    per = words.groupBy("e").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    per = per.withColumn("span", (hi - lo + 1).cast("int"))

    def shown(w: Column) -> Column:
        bits = F.bin(F.coalesce(F.element_at("m", w), F.lit(0).cast("long")))
        return F.translate(F.reverse(F.lpad(bits, WORD_BITS, "0")), "0", ".")
    last = F.floor((F.col("span") - 1) / WORD_BITS).cast("int")
    every = F.array_join(F.transform(F.sequence(F.lit(0), last), shown), "")
    return per.select(F.substring(every, F.lit(1), F.col("span")).alias("pattern")).groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n_entities"))


# --------------------------------------------------------------------------- D12
def xtsum(df: DataFrame, entity: str, cols: Sequence[str]) -> DataFrame:
    """Overall / between / within mean, sd, min, max and N, n, T-bar per variable.

    One aggregation gives every entity's count, mean, squared deviations, minimum and maximum of all
    variables; everything else is sums over that table, since a row's within value is x - mean of the entity + grand
    mean.  Rows without an entity are one of their own.
    """
    cols = list(cols)
    per = df.groupBy(F.col(entity).alias("__e")).agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"),
        F.min(c).cast("double").alias(f"a{i}"), F.max(c).cast("double").alias(f"b{i}"))])
    rows = [F.struct(F.lit(c).alias("variable"), *[F.col(f"{k}{i}").alias(k) for k in "nmvab"]) for i, c in enumerate(cols)]
    d = cut_lineage(per.select(F.inline(F.array(*rows))).filter("n > 0"), how="parquet")
    grand = d.groupBy("variable").agg((F.expr("sum(n * m) / sum(n)")).alias("g"))       # one row per variable
    d = d.join(F.broadcast(grand), "variable")
    return d.groupBy("variable").agg(
        F.first("g").alias("overall_mean"),
        F.expr("sqrt(try_divide(sum(n * v + n * (m - g) * (m - g)), nullif(sum(n) - 1, 0)))").alias("overall_sd"),
        F.min("a").alias("overall_min"), F.max("b").alias("overall_max"), F.sum("n").alias("n_obs"),
        F.stddev_samp("m").alias("between_sd"), F.min("m").alias("between_min"), F.max("m").alias("between_max"),
        F.count(F.lit(1)).alias("n_entities"), F.avg("n").alias("t_bar"),
        F.expr("sqrt(try_divide(sum(n * v), nullif(sum(n) - 1, 0)))").alias("within_sd"),
        F.expr("min(a - m + g)").alias("within_min"), F.expr("max(b - m + g)").alias("within_max"))


# --------------------------------------------------------------------------- D13
def group_trends(df: DataFrame, period: str, groups: Sequence[str], cols: Sequence[str],
                 template: str = "{col}_mean") -> DataFrame:
    """Mean outcome by period x group(s) (event-study / 2x2 trend tables)."""
    return df.groupBy(period, *groups).agg(
        *[F.avg(c).alias(template.format(col=c)) for c in cols],
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- D15
def map_intensity(measure: Column, base: Column, scale: float = 100.0) -> Column:
    """log(scale * a / b + 1) intensity for map tables (NULL when b is 0)."""
    r = F.try_divide(measure * F.lit(scale), base)
    return F.when(r > -1, F.log1p(r))
