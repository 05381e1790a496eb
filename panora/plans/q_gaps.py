"""Registered queries over data with gaps: rows off a grid, missing periods and order values,
values outside a level list, constant columns, models on differing samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.functions.clean import first_per_key
from panora.operators import aggregate as A
from panora.operators import estimate, joins, profile, reshape, window
from panora.plans import q_estimate, sql_fit
from panora.plans.common import QZ, SQL_DAY_PANEL, T, events_day_panel, qz

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- J13
SQL_MONTHS = """SELECT o_custkey % 50 AS grp, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(1) AS BIGINT) AS n
  FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 7 < 2 GROUP BY ALL"""


def _months(spark, sf):
    o = T(spark, sf, "orders").filter("o_custkey % 3 = 0 AND o_orderkey % 7 < 2")
    return o.groupBy((F.col("o_custkey") % 50).alias("grp"),
                     F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@reg("j13_balance_months", f"""WITH p AS ({SQL_MONTHS}),
 m AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM p), (SELECT max(month) FROM p), INTERVAL 1 MONTH)) AS DATE) AS month)
SELECT g.grp, m.month, coalesce(p.n, 0) AS n, CASE WHEN p.n IS NULL THEN 1 ELSE 3 END AS status
FROM (SELECT DISTINCT grp FROM p) g CROSS JOIN m LEFT JOIN p ON p.grp = g.grp AND p.month = m.month""")
def j13_balance_months(spark, sf):
    return joins.fill_balanced(_months(spark, sf), "grp", "month", {"n": 0}, status="status")


@reg("j13_rows_off_the_grid", f"""WITH p AS (SELECT user_id, nullif(day, 3) AS day, n_events FROM ({SQL_DAY_PANEL}) WHERE user_id % 2 = 0),
 g AS (SELECT u.user_id, CAST(d.day AS INTEGER) AS day FROM (SELECT DISTINCT user_id FROM p) u
   CROSS JOIN (SELECT unnest(range((SELECT min(day) FROM p), (SELECT max(day) FROM p) + 1, 2)) AS day) d)
SELECT g.user_id, g.day, p.n_events, CASE WHEN p.user_id IS NULL THEN 1 ELSE 3 END AS status
  FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.day = g.day
UNION ALL SELECT p.user_id, p.day, p.n_events, 2 FROM p LEFT JOIN g ON p.user_id = g.user_id AND p.day = g.day WHERE g.user_id IS NULL""")
def j13_rows_off_the_grid(spark, sf):
    p = events_day_panel(spark, sf).filter("user_id % 2 = 0").select("user_id", F.nullif("day", F.lit(3)).alias("day"), "n_events")
    return joins.fill_balanced(p, "user_id", "day", step=2, status="status")


# ---------------------------------------------------------------------------- M7
SQL_ATTRIBUTES = """a AS (SELECT c_custkey AS user_id, c_acctbal FROM customer)"""


@reg("j1_align_drop_null_period", f"""WITH p AS ({SQL_DAY_PANEL}), {SQL_ATTRIBUTES}
SELECT user_id, day, n_events, c_acctbal FROM p FULL JOIN a USING (user_id) WHERE day IS NOT NULL""")
def j1_align_drop_null_period(spark, sf):
    a = T(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    p = events_day_panel(spark, sf).select("user_id", "day", "n_events")
    return joins.drop_null_period(joins.join(p, a, ["user_id"], "full"), "day")


# ---------------------------------------------------------------------------- O1 / J8 / A12
@reg("o1_sort_text_key", """SELECT o_orderkey, o_clerk_, o_totalprice,
  row_number() OVER (ORDER BY o_clerk_ NULLS LAST, o_totalprice DESC, o_orderkey) AS position
FROM (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS o_clerk_, o_totalprice FROM orders)""")
def o1_sort_text_key(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("o_clerk_"), "o_totalprice")
    return reshape.sort_position(o, "o_clerk_", tiebreak=[("o_totalprice", True), "o_orderkey"])


@reg("j8_merge_mm_date_order", """WITH l AS (SELECT o_custkey AS k, o_orderdate, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p,
   count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
 r AS (SELECT c_custkey % 40 AS k, c_name, row_number() OVER (PARTITION BY c_custkey % 40 ORDER BY c_name) AS p,
   count(*) OVER (PARTITION BY c_custkey % 40) AS n FROM customer),
 a AS (SELECT l.k, l.o_orderdate, l.o_orderkey, r.c_name FROM l LEFT JOIN r ON r.k = l.k AND r.p = least(l.p, r.n)),
 b AS (SELECT r.k, l.o_orderdate, l.o_orderkey, r.c_name FROM r LEFT JOIN l ON l.k = r.k AND l.p = l.n WHERE r.p > coalesce(l.n, 0))
SELECT * FROM a UNION ALL SELECT * FROM b""")
def j8_merge_mm_date_order(spark, sf):
    left = T(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderkey")
    right = T(spark, sf, "customer").select((F.col("c_custkey") % 40).alias("k"), "c_name")
    return joins.merge_mm(left, right, "k", ["o_orderdate", "o_orderkey"], ["c_name"])


CHUNK = 64


@reg("a12_collect_chunks", f"""WITH v AS (SELECT o_orderstatus, o_totalprice, o_orderkey,
   row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1 AS p FROM orders)
SELECT o_orderstatus, CAST(p // {CHUNK} AS INTEGER) AS chunk, list(o_totalprice ORDER BY p) AS prices FROM v GROUP BY ALL""")
def a12_collect_chunks(spark, sf):
    return A.collect_chunks(T(spark, sf, "orders"), "o_orderstatus", "o_totalprice", CHUNK, "prices", ["o_orderdate", "o_orderkey"])


# ---------------------------------------------------------------------------- W3 / C12
SQL_SERIES = """SELECT l_suppkey % 20 AS e, nullif(CAST(l_shipdate AS DATE), DATE '1995-01-01') AS t, l_orderkey, l_linenumber,
   CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END AS v FROM lineitem WHERE l_linenumber <= 3 AND l_orderkey % 5 = 0"""


@reg("w3_locf_dates", f"""WITH s AS ({SQL_SERIES}), u AS (SELECT e, t, max(v) AS v, count(*) AS n FROM s GROUP BY e, t)
SELECT e, t, n, last_value(v IGNORE NULLS) OVER (PARTITION BY e ORDER BY t NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM u""")
def w3_locf_dates(spark, sf):
    s = T(spark, sf, "lineitem").filter("l_linenumber <= 3 AND l_orderkey % 5 = 0").select(
        (F.col("l_suppkey") % 20).alias("e"), F.expr("nullif(CAST(l_shipdate AS DATE), DATE '1995-01-01')").alias("t"),
        F.expr("CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END").alias("v"))
    u = s.groupBy("e", "t").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("n"))
    return window.locf(u, "e", "t", ["v"])


@reg("c12_first_per_key_null_order", """SELECT o_custkey, o_orderkey, p FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY p NULLS LAST, o_orderkey) AS k
  FROM (SELECT o_custkey, o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p FROM orders)) WHERE k = 1""")
def c12_first_per_key_null_order(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p"))
    return first_per_key(o, ["o_custkey"], ["p", "o_orderkey"])


# ---------------------------------------------------------------------------- pivots
SQL_FLAGS = "SELECT l_suppkey, nullif(l_returnflag, 'R') AS flag, l_linestatus AS st, l_quantity AS q FROM lineitem"


def _flags(spark, sf):
    return T(spark, sf, "lineitem").select("l_suppkey", F.nullif("l_returnflag", F.lit("R")).alias("flag"),
                                           F.col("l_linestatus").alias("st"), F.col("l_quantity").alias("q"))


@reg("r1_wide_cast_rest", f"""SELECT l_suppkey, {', '.join(f"coalesce(sum(q) FILTER (flag = 'A' AND st = '{s}'), 0) AS qflagAst{s}" for s in 'FX')},
  coalesce(sum(q) FILTER (coalesce(flag = 'A' AND st IN ('F', 'X'), false) = false), 0) AS qrest FROM ({SQL_FLAGS}) GROUP BY l_suppkey""")
def r1_wide_cast_rest(spark, sf):
    return reshape.wide_cast(_flags(spark, sf), ["l_suppkey"], ["flag", "st"], [["A"], ["F", "X"]], ["q"], rest="cell")


@reg("a4_crosstab_rest", f"""SELECT st, count(*) FILTER (flag = 'A') AS n_A, count(*) FILTER (flag IS NULL OR flag <> 'A') AS n_rest
FROM ({SQL_FLAGS}) GROUP BY st""")
def a4_crosstab_rest(spark, sf):
    return A.crosstab(_flags(spark, sf), "st", "flag", ["A"], "n_{v}", rest="cell")


@reg("r2_long_to_wide_found", f"""SELECT l_suppkey, sum(q) FILTER (flag = 'A') AS q_A, sum(q) FILTER (flag = 'N') AS q_N,
  sum(q) FILTER (flag IS NULL) AS q_rest FROM ({SQL_FLAGS}) GROUP BY l_suppkey""")
def r2_long_to_wide_found(spark, sf):
    return reshape.long_to_wide(_flags(spark, sf), ["l_suppkey"], "flag", ["q"], agg="sum", rest="cell", max_levels=10)


# ---------------------------------------------------------------------------- profile
SQL_CONST = "SELECT l_quantity AS x, l_extendedprice AS y, 1.5::DOUBLE AS k FROM lineitem"


@reg("d8_pearson_constant", f"""WITH d AS ({SQL_CONST}), r AS (SELECT corr(x, y) AS xy, count(*) AS n FROM d)
SELECT v.a AS var1, v.b AS var2, CASE WHEN v.a = v.b THEN 1.0 WHEN 'k' IN (v.a, v.b) THEN NULL ELSE {QZ('xy', 6)} END AS r, n
FROM r, (SELECT a.v AS a, b.v AS b FROM (VALUES ('x'), ('y'), ('k')) a(v), (VALUES ('x'), ('y'), ('k')) b(v)) v""")
def d8_pearson_constant(spark, sf):
    d = T(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.lit(1.5).alias("k"))
    p = profile.pearson(d, ["x", "y", "k"], with_p=False)
    return p.select("var1", "var2", qz("r", 6).alias("r"), "n")


@reg("d12_xtsum_null_entity", f"""WITH d AS (SELECT nullif(o_custkey % 30, 7) AS e, o_totalprice AS x FROM orders),
 g AS (SELECT avg(x) AS g FROM d), m AS (SELECT e, avg(x) AS m, count(*) AS t FROM d GROUP BY e),
 w AS (SELECT x - m + g AS w FROM d JOIN m ON d.e IS NOT DISTINCT FROM m.e, g)
SELECT 'x' AS variable, {QZ('(SELECT g FROM g)', 2)} AS overall_mean, {QZ('(SELECT stddev_samp(x) FROM d)', 2)} AS overall_sd,
  (SELECT count(*) FROM d) AS n_obs, {QZ('stddev_samp(m)', 2)} AS between_sd, count(*) AS n_entities,
  {QZ('(SELECT stddev_samp(w) FROM w)', 2)} AS within_sd, {QZ('(SELECT min(w) FROM w)', 2)} AS within_min,
  {QZ('(SELECT max(w) FROM w)', 2)} AS within_max FROM m""")
def d12_xtsum_null_entity(spark, sf):
    d = T(spark, sf, "orders").select(F.expr("nullif(o_custkey % 30, 7)").alias("e"), F.col("o_totalprice").alias("x"))
    x = profile.xtsum(d, "e", ["x"])
    return x.select("variable", "n_obs", "n_entities", *[qz(c, 2).alias(c) for c in (
        "overall_mean", "overall_sd", "between_sd", "within_sd", "within_min", "within_max")])


@reg("d11_patterns_of_dates", """WITH p AS (SELECT DISTINCT o_custkey % 11 AS e, CAST(o_orderdate AS DATE) AS t FROM orders WHERE o_orderkey % 9 = 0),
 d AS (SELECT CAST(unnest(generate_series((SELECT min(t) FROM p), (SELECT max(t) FROM p), INTERVAL 1 DAY)) AS DATE) AS t),
 s AS (SELECT u.e, string_agg(CASE WHEN p.t IS NULL THEN '.' ELSE '1' END, '' ORDER BY d.t) AS pattern
   FROM (SELECT DISTINCT e FROM p) u CROSS JOIN d LEFT JOIN p ON p.e = u.e AND p.t = d.t GROUP BY u.e)
SELECT pattern, count(*) AS n_entities FROM s GROUP BY pattern""")
def d11_patterns_of_dates(spark, sf):
    p = T(spark, sf, "orders").filter("o_orderkey % 9 = 0").select((F.col("o_custkey") % 11).alias("e"),
                                                                  F.to_date("o_orderdate").alias("t"))
    return profile.participation_patterns(p, "e", "t")


# ---------------------------------------------------------------------------- estimators
GAP_MODELS = [(f"g{i}", o, m) for i, (o, m) in enumerate((o, m) for o in ("y_late", "y_few") for m in ("n_events", "m_some"))]
SQL_GAPS = """gp AS MATERIALIZED (SELECT *, CASE WHEN day > 8 THEN value_mean END AS y_late,
    CASE WHEN last_event % 4 <> 0 THEN value_mean END AS y_few, CASE WHEN user_id % 5 <> 0 THEN n_events END AS m_some FROM est)"""


def gap_grid(spark, sf):
    """Outcomes and moderators missing on different rows (one of them NaN)."""
    nan = F.lit(float("nan"))
    p = q_estimate.est_panel(spark, sf)
    p = p.withColumns({"y_late": F.when(F.col("day") > 8, F.col("value_mean")),
                       "y_few": F.when(F.col("last_event") % 4 != 0, F.col("value_mean")).otherwise(nan),
                       "m_some": F.when(F.col("user_id") % 5 != 0, F.col("n_events"))})
    return estimate.grid(p, ["y_late", "y_few"], ["n_events", "m_some"], lambda o, m: ["tre", m], absorb="user_id", time="day")


@reg("e7_grid_over_gaps", q_estimate._fit_sql(
    [SQL_GAPS, *(sql_fit.chain(t, "gp", ["tre", m], o, "user_id", "day") for t, o, m in GAP_MODELS)],
    "\nUNION ALL ".join(f"SELECT '{o}|{m}' AS model_id, n, c.* FROM ({q_estimate._coef_sql(t, ['tre', m])}) c, {t}_f"
                        for t, o, m in GAP_MODELS)))
def e7_grid_over_gaps(spark, sf):
    fits = gap_grid(spark, sf)
    n = estimate.stats_table(spark, fits).select("model_id", "n")
    return q_estimate._coefs(spark, fits, "model_id").join(n, "model_id").select(
        "model_id", "n", "term", "coef", "se", "omitted")


@reg("e3_period_effects", q_estimate._fit_sql(
    [sql_fit.chain("f", "est", ["n_events"], "value_mean", "user_id", "day")],
    f"""SELECT day, {QZ("CASE WHEN nr = 1 THEN 0.0 ELSE s[nr][w] END", 6)} AS effect
  FROM (SELECT day, row_number() OVER (ORDER BY day) AS nr FROM (SELECT DISTINCT day FROM est WHERE value_mean IS NOT NULL)), f_f"""))
def e3_period_effects(spark, sf):
    fit = estimate.areg(q_estimate.est_panel(spark, sf), "value_mean", ["n_events"], absorb="user_id", time="day")
    return spark.createDataFrame(fit.effects, "day int, effect double").select("day", qz("effect", 6).alias("effect"))


QUERIES, SQL = Q, S
