"""Registered queries: profiling and descriptive statistics.

The group-trend table (D13) is the flagship query in ``q_design``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.functions.tails import sql_stars, sql_t_two_sided, stars
from panora.operators.aggregate import stacked_summary
from panora.operators.joins import coverage_flags, join
from panora.operators.profile import (balance_table, box_stats, codebook, describe, histogram,
                                      map_intensity, panel_structure, participation_patterns,
                                      pearson, six_number, spearman, summarize, welch_test, xtsum)
from panora.plans.common import KEY_SHIFT, LARGE_ACCOUNT, QZ, SQL_DAY_PANEL, T, events_day_panel, qz
from panora.plans.q_aggregate import SQL_SITES, sites

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


def _quantized(df, keep):
    return df.select(*[F.col(c) if c in keep else qz(c).alias(c) for c in df.columns])


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---------------------------------------------------------------------------- D1
def _sql_describe_fast(x):
    return f"""SELECT '{x}' AS variable, count({x}) AS n, {QZ(f'avg({x})')} AS mean,
  {QZ(f'stddev_samp({x})')} AS sd, {QZ(f'min({x})')} AS min, {QZ(f'max({x})')} AS max,
  {QZ(f'max({x}) - min({x})')} AS range, {QZ(f'stddev_samp({x}) / sqrt(count({x}))')} AS se FROM lineitem"""


@reg("d1_describe", " UNION ALL ".join(_sql_describe_fast(x) for x in LI_COLS))
def d1_describe(spark, sf):
    d = describe(T(spark, sf, "lineitem"), LI_COLS)
    return _quantized(d, {"variable", "n"})


def _sql_describe_full(x):
    return f"""SELECT '{x}' AS variable, count(*) AS n, {QZ('avg(x)')} AS mean, {QZ('stddev_samp(x)')} AS sd,
  {QZ('median(x)')} AS median,
  {QZ('avg(x) FILTER (WHERE r > floor(n * 0.1) AND r <= n - floor(n * 0.1))')} AS trimmed,
  {QZ('1.4826 * (SELECT median(abs(x - (SELECT median(x) FROM v_' + x + '))) FROM v_' + x + ')')} AS mad,
  {QZ('min(x)')} AS min, {QZ('max(x)')} AS max, {QZ('max(x) - min(x)')} AS range,
  {QZ('avg(power(x - mu, 3)) / power(stddev_samp(x), 3)')} AS skew,
  {QZ('avg(power(x - mu, 4)) / power(stddev_samp(x), 4) - 3')} AS kurtosis,
  {QZ('stddev_samp(x) / sqrt(count(*))')} AS se
FROM (SELECT x, row_number() OVER (ORDER BY x) AS r, count(*) OVER () AS n, avg(x) OVER () AS mu
      FROM v_{x})"""


SQL_D1_FULL = "WITH " + ", ".join(
    f"v_{x} AS (SELECT CAST({x} AS DOUBLE) AS x FROM lineitem WHERE {x} IS NOT NULL)"
    for x in LI_COLS[:3]) + " " + " UNION ALL ".join(_sql_describe_full(x) for x in LI_COLS[:3])


@reg("d1_describe_full", SQL_D1_FULL)
def d1_describe_full(spark, sf):
    d = describe(T(spark, sf, "lineitem"), LI_COLS[:3], fast=False)
    return _quantized(d, {"variable", "n"})


# ---------------------------------------------------------------------------- D2
def _sql_stata_pct(x, pcts):
    parts = []
    for j in pcts:
        parts.append(f"{QZ(f'avg({x}) FILTER (WHERE (n * {j} % 100 = 0 AND r IN (n * {j} // 100, n * {j} // 100 + 1)) OR (n * {j} % 100 <> 0 AND r = n * {j} // 100 + 1))')} AS p{j}")
    return ", ".join(parts)


def _sql_codebook(x):
    return f"""SELECT '{x}' AS variable, 'double' AS type, {QZ('min(a.x)')} AS min, {QZ('max(a.x)')} AS max,
  count(DISTINCT a.x) AS n_distinct, (SELECT count(*) FROM s) - count(a.x) AS n_missing,
  {QZ('avg(a.x)')} AS mean, {QZ('stddev_samp(a.x)')} AS sd, (SELECT count(*) FROM s) AS n_total,
  {_sql_stata_pct('a.x', (10, 25, 50, 75, 90))}
FROM (SELECT {x} AS x, row_number() OVER (ORDER BY {x}) AS r, count(*) OVER () AS n FROM s
      WHERE {x} IS NOT NULL) a"""


SITES_NULL = f"""SELECT c_custkey, c_nationkey, CASE WHEN emple > 0 THEN emple END AS emple,
  CASE WHEN emple > 0 THEN budget END AS budget FROM ({SQL_SITES})"""


def _sites_null(spark, sf):
    s = sites(spark, sf)
    has = F.col("emple") > 0
    return s.select("c_custkey", "c_nationkey", F.when(has, F.col("emple")).alias("emple"),
                    F.when(has, F.col("budget")).alias("budget"))


@reg("d2_codebook", f"WITH s AS ({SITES_NULL}) " + " UNION ALL ".join(
    _sql_codebook(x) for x in ("emple", "budget")))
def d2_codebook(spark, sf):
    cb = codebook(_sites_null(spark, sf), ["emple", "budget"])
    return _quantized(cb, {"variable", "type", "n_distinct", "n_missing", "n_total"})


# ---------------------------------------------------------------------------- D3
def _sql_summarize(x):
    return f"""SELECT '{x}' AS variable, count({x}) AS obs, CAST(count({x}) AS DOUBLE) AS sum_w,
  {QZ(f'avg({x})')} AS mean, {QZ(f'var_samp({x})', 2)} AS variance, {QZ(f'stddev_samp({x})')} AS sd,
  {QZ(f'min({x})')} AS min, {QZ(f'max({x})')} AS max, {QZ(f'sum({x})')} AS sum FROM s"""


@reg("d3_summarize", f"WITH s AS ({SITES_NULL}) " + " UNION ALL ".join(
    _sql_summarize(x) for x in ("emple", "budget")))
def d3_summarize(spark, sf):
    s = summarize(_sites_null(spark, sf), ["emple", "budget"])
    return s.select("variable", "obs", "sum_w", qz("mean").alias("mean"),
                    qz("variance", 2).alias("variance"),
                    *[qz(c).alias(c) for c in ("sd", "min", "max", "sum")])


# ---------------------------------------------------------------------------- D4
def _sql_six(x):
    return f"""SELECT '{x}' AS variable, {QZ(f'min({x})')} AS min, {QZ(f'quantile_cont({x}, 0.25)')} AS q1,
  {QZ(f'quantile_cont({x}, 0.5)')} AS median, {QZ(f'avg({x})')} AS mean,
  {QZ(f'quantile_cont({x}, 0.75)')} AS q3, {QZ(f'max({x})')} AS max, count(*) - count({x}) AS n_na FROM li"""


@reg("d4_six_number", "WITH li AS (SELECT l_extendedprice, l_quantity, "
     "CASE WHEN l_discount > 0 THEN l_tax END AS tax_nz FROM lineitem) " + " UNION ALL ".join(
         _sql_six(x) for x in ("l_extendedprice", "l_quantity", "tax_nz")))
def d4_six_number(spark, sf):
    li = T(spark, sf, "lineitem").select(
        "l_extendedprice", "l_quantity", F.when(F.col("l_discount") > 0, F.col("l_tax")).alias("tax_nz"))
    return _quantized(six_number(li, ["l_extendedprice", "l_quantity", "tax_nz"]), {"variable", "n_na"})


# ---------------------------------------------------------------------------- D5 / D6
def _docs(spark, sf):
    d = T(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"))
    lab = T(spark, sf, "labels").select("doc_id", "quality", F.col("toxic").cast("double").alias("toxic"))
    return d.join(lab, "doc_id")


SQL_DOCS = """SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality, CAST(l.toxic AS DOUBLE) AS toxic
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""


def _sql_balance(x):
    return f"""SELECT '{x}' AS variable,
  count({x}) FILTER (WHERE quality = 0) AS n_0, {QZ(f'avg({x}) FILTER (WHERE quality = 0)')} AS mean_0,
  {QZ(f'stddev_samp({x}) FILTER (WHERE quality = 0)')} AS sd_0,
  count({x}) FILTER (WHERE quality = 1) AS n_1, {QZ(f'avg({x}) FILTER (WHERE quality = 1)')} AS mean_1,
  {QZ(f'stddev_samp({x}) FILTER (WHERE quality = 1)')} AS sd_1 FROM d"""


@reg("d5_balance_table", f"WITH d AS ({SQL_DOCS}) " + " UNION ALL ".join(
    _sql_balance(x) for x in ("n_chars", "toxic")))
def d5_balance_table(spark, sf):
    b = balance_table(_docs(spark, sf), "quality", ["n_chars", "toxic"])
    return _quantized(b, {"variable", "n_0", "n_1"})


def _sql_welch(x, show=QZ):
    v1 = f"var_samp({x}) FILTER (WHERE quality = 1) / count({x}) FILTER (WHERE quality = 1)"
    v2 = f"var_samp({x}) FILTER (WHERE quality = 0) / count({x}) FILTER (WHERE quality = 0)"
    n1 = f"count({x}) FILTER (WHERE quality = 1)"
    n2 = f"count({x}) FILTER (WHERE quality = 0)"
    m1 = f"avg({x}) FILTER (WHERE quality = 1)"
    m2 = f"avg({x}) FILTER (WHERE quality = 0)"
    return f"""SELECT '{x}' AS variable, {n1} AS n1, {n2} AS n2, {show(m1)} AS mean1, {show(m2)} AS mean2,
  {show(f'({m1} - {m2}) / sqrt({v1} + {v2})')} AS t,
  {show(f'power({v1} + {v2}, 2) / (power({v1}, 2) / ({n1} - 1) + power({v2}, 2) / ({n2} - 1))')} AS df FROM d"""


@reg("d6_welch_t", f"WITH d AS ({SQL_DOCS}) " + " UNION ALL ".join(
    _sql_welch(x) for x in ("n_chars", "toxic")))
def d6_welch_t(spark, sf):
    w = welch_test(_docs(spark, sf), "quality", ["n_chars", "toxic"], levels=(1, 0), with_p=False)
    return _quantized(w, {"variable", "n1", "n2"})


@reg("d6_welch_table", f"WITH d AS ({SQL_DOCS}), w AS (" + " UNION ALL ".join(_sql_welch(x, show=str) for x in ("n_chars", "toxic"))
     + f"), p AS (SELECT *, {sql_t_two_sided('t', 'df')} AS p FROM w) SELECT variable, n1, n2, {QZ('mean1')} AS mean1, {QZ('mean2')} AS mean2, "
     f"{QZ('t')} AS t, {QZ('df')} AS df, {QZ('p', 6)} AS p, {sql_stars('p')} AS stars FROM p")
def d6_welch_table(spark, sf):
    w = welch_test(_docs(spark, sf), "quality", ["n_chars", "toxic"], levels=(1, 0)).withColumn("stars", stars(F.col("p")))
    return w.select("variable", "n1", "n2", *[qz(c).alias(c) for c in ("mean1", "mean2", "t", "df")], qz("p", 6).alias("p"), "stars")


# ---------------------------------------------------------------------------- D7 / D8
def _sql_corr(rank: bool):
    cols = LI_COLS
    if rank:
        sel = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}"
                        for c in cols)
        src = f"(SELECT {sel} FROM (SELECT * FROM lineitem WHERE " + " AND ".join(
            f"{c} IS NOT NULL" for c in cols) + "))"
    else:
        src = "lineitem"
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            r = "1.0" if i == j else f"corr({a}, {b})" if i < j else f"corr({b}, {a})"
            parts.append(f"SELECT '{a}' AS var1, '{b}' AS var2, {QZ(r, 6)} AS r, count(*) AS n FROM {src}")
    return " UNION ALL ".join(parts)


@reg("d7_spearman", _sql_corr(True))
def d7_spearman(spark, sf):
    s = spearman(T(spark, sf, "lineitem"), LI_COLS)
    return s.select("var1", "var2", qz("r", 6).alias("r"), "n")


@reg("d8_pearson", _sql_corr(False))
def d8_pearson(spark, sf):
    p = pearson(T(spark, sf, "lineitem"), LI_COLS, with_p=False)
    return p.select("var1", "var2", qz("r", 6).alias("r"), "n")


@reg("d8_pearson_table", f"""WITH c AS ({" UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r, count(*) AS n FROM lineitem"
    for i, a in enumerate(LI_COLS) for j, b in enumerate(LI_COLS) if i < j)}),
 p AS (SELECT *, {sql_t_two_sided('(r * sqrt((n - 2) / (1 - r * r)))', '(n - 2)')} AS p FROM c)
SELECT var1, var2, {QZ('r', 6)} AS r, n, {QZ('p', 6)} AS p, {sql_stars('p')} AS stars FROM p""")
def d8_pearson_table(spark, sf):
    p = pearson(T(spark, sf, "lineitem"), LI_COLS).withColumn("stars", stars(F.col("p")))
    first = F.array_position(F.array(*[F.lit(c) for c in LI_COLS]), F.col("var1"))
    second = F.array_position(F.array(*[F.lit(c) for c in LI_COLS]), F.col("var2"))
    return p.filter(first < second).select("var1", "var2", qz("r", 6).alias("r"), "n", qz("p", 6).alias("p"), "stars")


# ---------------------------------------------------------------------------- D9
@reg("d9_histogram", f"""
WITH m AS (SELECT min(o_totalprice) AS lo FROM orders)
SELECT CAST(floor((o_totalprice - lo) / 50000.0) AS INTEGER) AS bin,
  {QZ('lo + floor((o_totalprice - lo) / 50000.0) * 50000.0')} AS lo,
  {QZ('lo + (floor((o_totalprice - lo) / 50000.0) + 1) * 50000.0')} AS hi, count(*) AS n
FROM orders, m GROUP BY 1, 2, 3""")
def d9_histogram(spark, sf):
    h = histogram(T(spark, sf, "orders"), "o_totalprice", width=50000.0)
    return h.select("bin", qz("lo").alias("lo"), qz("hi").alias("hi"), "n")


@reg("d9_histogram_by_group", f"""
WITH m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin,
  count(*) AS n FROM orders, m GROUP BY 1, 2""")
def d9_histogram_by_group(spark, sf):
    h = histogram(T(spark, sf, "orders"), "o_totalprice", bins=20, by=["o_orderstatus"])
    return h.select("o_orderstatus", "bin", "n")


@reg("d9_histogram_log", f"""
WITH v AS (SELECT ln(o_totalprice + 1) AS x FROM orders),
 m AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
FROM v, m GROUP BY 1""")
def d9_histogram_log(spark, sf):
    h = histogram(T(spark, sf, "orders"), "o_totalprice", bins=20, log=True)
    return h.select("bin", "n")


# ---------------------------------------------------------------------------- D10
@reg("d10_box_stats", f"""
WITH q AS (SELECT c_mktsegment, count(c_acctbal) AS n, quantile_cont(c_acctbal, 0.25) AS q1,
                  quantile_cont(c_acctbal, 0.5) AS median, quantile_cont(c_acctbal, 0.75) AS q3
           FROM customer GROUP BY 1),
 w AS (SELECT c.c_mktsegment, min(c_acctbal) FILTER (WHERE c_acctbal >= q1 - 1.5 * (q3 - q1)) AS wl,
              max(c_acctbal) FILTER (WHERE c_acctbal <= q3 + 1.5 * (q3 - q1)) AS wh,
              count(*) FILTER (WHERE c_acctbal < q1 - 1.5 * (q3 - q1) OR c_acctbal > q3 + 1.5 * (q3 - q1))
                AS n_outliers
       FROM customer c JOIN q ON q.c_mktsegment = c.c_mktsegment GROUP BY 1)
SELECT q.c_mktsegment, q.n, {QZ('q1')} AS q1, {QZ('median')} AS median, {QZ('q3')} AS q3,
  {QZ('q3 - q1')} AS iqr, {QZ('wl')} AS whisker_lo, {QZ('wh')} AS whisker_hi, n_outliers
FROM q JOIN w ON w.c_mktsegment = q.c_mktsegment""")
def d10_box_stats(spark, sf):
    b = box_stats(T(spark, sf, "customer"), "c_acctbal", ["c_mktsegment"])
    return _quantized(b, {"c_mktsegment", "n", "n_outliers"})


# ---------------------------------------------------------------------------- D11
@reg("d11_panel_structure", f"""
WITH p AS ({SQL_DAY_PANEL}), t AS (SELECT user_id, count(DISTINCT day) AS ti FROM p GROUP BY 1)
SELECT count(*) AS n_entities, min(ti) AS min_ti, {QZ('avg(ti)')} AS mean_ti, max(ti) AS max_ti,
  CAST(sum(ti) AS BIGINT) AS n_obs, (SELECT count(DISTINCT day) FROM p) AS n_periods,
  (SELECT min(day) FROM p) AS first_period, (SELECT max(day) FROM p) AS last_period,
  CAST(min(ti) = max(ti) AND max(ti) = (SELECT count(DISTINCT day) FROM p) AS INTEGER) AS balanced
FROM t""")
def d11_panel_structure(spark, sf):
    s = panel_structure(events_day_panel(spark, sf), "user_id", "day")
    return s.withColumn("mean_ti", qz("mean_ti"))


@reg("d11_participation_patterns", f"""
WITH p AS ({SQL_DAY_PANEL}),
 d AS (SELECT CAST(unnest(range(min(day), max(day) + 1)) AS INTEGER) AS day FROM p),
 g AS (SELECT u.user_id, d.day FROM (SELECT DISTINCT user_id FROM p) u CROSS JOIN d),
 s AS (SELECT g.user_id, string_agg(CASE WHEN p.day IS NULL THEN '.' ELSE '1' END, '' ORDER BY g.day) AS pattern
       FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.day = g.day GROUP BY g.user_id)
SELECT pattern, count(*) AS n_entities FROM s GROUP BY pattern""")
def d11_participation_patterns(spark, sf):
    return participation_patterns(events_day_panel(spark, sf), "user_id", "day")


# ---------------------------------------------------------------------------- D12
def _sql_xtsum(x):
    return f"""SELECT '{x}' AS variable, {QZ(f'avg(p.{x})')} AS overall_mean, {QZ(f'stddev_samp(p.{x})')} AS overall_sd,
  {QZ(f'min(p.{x})')} AS overall_min, {QZ(f'max(p.{x})')} AS overall_max, count(*) AS n_obs,
  (SELECT {QZ('stddev_samp(m)')} FROM e_{x}) AS between_sd, (SELECT {QZ('min(m)')} FROM e_{x}) AS between_min,
  (SELECT {QZ('max(m)')} FROM e_{x}) AS between_max, (SELECT count(*) FROM e_{x}) AS n_entities,
  (SELECT {QZ('avg(t)')} FROM e_{x}) AS t_bar,
  {QZ(f'stddev_samp(p.{x} - e.m + (SELECT avg({x}) FROM p))')} AS within_sd,
  {QZ(f'min(p.{x} - e.m + (SELECT avg({x}) FROM p))')} AS within_min,
  {QZ(f'max(p.{x} - e.m + (SELECT avg({x}) FROM p))')} AS within_max
FROM p JOIN e_{x} e ON e.user_id = p.user_id"""


XT_COLS = ["value_mean", "n_events"]

SQL_D12 = (f"WITH p AS (SELECT user_id, day, value_mean, CAST(n_events AS DOUBLE) AS n_events FROM ({SQL_DAY_PANEL})), "
           + ", ".join(f"e_{x} AS (SELECT user_id, avg({x}) AS m, count(*) AS t FROM p GROUP BY 1)" for x in XT_COLS)
           + " " + " UNION ALL ".join(_sql_xtsum(x) for x in XT_COLS))


@reg("d12_xtsum", SQL_D12)
def d12_xtsum(spark, sf):
    p = events_day_panel(spark, sf).withColumn("n_events", F.col("n_events").cast("double"))
    x = xtsum(p, "user_id", XT_COLS)
    return _quantized(x, {"variable", "n_obs", "n_entities"})


# ---------------------------------------------------------------------------- D14
@reg("d14_representativeness", f"""
WITH nat AS (SELECT c_nationkey AS n_nationkey, count(*) AS n_customers, avg(c_acctbal) AS acctbal_mean
             FROM customer GROUP BY 1),
 f AS (SELECT nat.*,
   CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey) THEN 1 ELSE 0 END AS in_orders,
   CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1 ELSE 0 END AS in_suppliers,
   CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > {LARGE_ACCOUNT}) THEN 1 ELSE 0 END AS in_large
   FROM nat)
SELECT 'all' AS subset, count(*) AS n_customers_count, {QZ('avg(n_customers)')} AS n_customers_mean,
  {QZ('avg(acctbal_mean)')} AS acctbal_mean_mean FROM f
UNION ALL SELECT 'orders', count(*), {QZ('avg(n_customers)')}, {QZ('avg(acctbal_mean)')} FROM f WHERE in_orders = 1
UNION ALL SELECT 'suppliers', count(*), {QZ('avg(n_customers)')}, {QZ('avg(acctbal_mean)')} FROM f WHERE in_suppliers = 1
UNION ALL SELECT 'large', count(*), {QZ('avg(n_customers)')}, {QZ('avg(acctbal_mean)')} FROM f WHERE in_large = 1""")
def d14_representativeness(spark, sf):
    c, o = T(spark, sf, "customer"), T(spark, sf, "orders")
    nat = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("c_acctbal").alias("acctbal_mean"))
    srcs = {
        "orders": c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
                   .select(F.col("c_nationkey").alias("n_nationkey")),
        "suppliers": T(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey")),
        "large": c.filter(F.col("c_acctbal") > LARGE_ACCOUNT).select(F.col("c_nationkey").alias("n_nationkey")),
    }
    f = coverage_flags(nat, srcs, "n_nationkey")
    flags = {"all": F.lit(True), **{k: F.col(f"in_{k}") == 1 for k in srcs}}
    s = stacked_summary(f, flags, ["n_customers", "acctbal_mean"], {"mean": "mean"})
    n = stacked_summary(f, flags, ["n_customers"], {"count": "count"})
    out = s.join(n, "subset")
    return out.select("subset", "n_customers_count", qz("n_customers_mean").alias("n_customers_mean"),
                      qz("acctbal_mean_mean").alias("acctbal_mean_mean"))


# ---------------------------------------------------------------------------- D15
@reg("d15_map_table", f"""
WITH m AS (SELECT c.c_nationkey + {KEY_SHIFT} AS c_nationkey, sum(o.o_totalprice) AS revenue, count(DISTINCT c.c_custkey) AS n_cust
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
           GROUP BY 1)
SELECT n.n_nationkey AS c_nationkey, n.n_name, m.n_cust,
  {QZ('CASE WHEN 100.0 * m.revenue / nullif(m.n_cust, 0) > -1 THEN ln(100.0 * m.revenue / nullif(m.n_cust, 0) + 1) END')}
    AS intensity
FROM m RIGHT JOIN nation n ON n.n_nationkey = m.c_nationkey""")
def d15_map_table(spark, sf):
    c = T(spark, sf, "customer").withColumn("c_nationkey", F.col("c_nationkey") + KEY_SHIFT)
    m = (T(spark, sf, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"))
         .groupBy("c_nationkey").agg(F.sum("o_totalprice").alias("revenue"),
                                     F.count_distinct("c_custkey").alias("n_cust")))
    geo = T(spark, sf, "nation").select("n_nationkey", "n_name")
    j = join(m, geo, "c_nationkey", "right", right_on="n_nationkey")
    return j.select("c_nationkey", "n_name", "n_cust",
                    qz(map_intensity(F.col("revenue"), F.col("n_cust"))).alias("intensity"))


QUERIES, SQL = Q, S
