"""Registered queries: estimators.

Proxy panel: events -> user x day (outcome = mean value, control = event
count), treatment = effective policy day (T1/T2), moderator = user mean value
above the median.  Estimator outputs are k x k algebra results turned into
small DataFrames; one- and two-regressor cases have closed-form SQL twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.functions.tails import sql_stars, sql_t_quantile, sql_t_two_sided
from panora.operators.estimate import (areg, coef_table, event_study, factor_levels, grid, margins, ols,
                                       stats_table, tests_table, wide_table, within)
from panora.operators.joins import fill_balanced
from panora.operators.window import high_low
from panora.plans import sql_fit
from panora.plans.common import QZ, SQL_DAY_PANEL, T, events_day_panel, qz
from panora.plans.q_design import LAGS, LEADS, SQL_DAY_PANEL_T, SQL_WEEK_PANEL, day_panel, week_panel

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


COEF_COLS = ("term", "coef", "se")


def _coef_rows(spark, fits, terms=None, digits=6):
    c = coef_table(spark, fits)
    if terms is not None:
        c = c.filter(F.col("term").isin(list(terms)))
    return c.select("term", qz("coef", digits).alias("coef"), qz("se", digits).alias("se"))


def est_panel(spark, sf):
    """Day panel + moderator ``high`` and event-time dummies."""
    p = day_panel(spark, sf).withColumn("n_events", F.col("n_events").cast("double"))
    users = high_low(T(spark, sf, "events").groupBy("user_id").agg(F.avg("value").alias("um")),
                     "um", out="high").select("user_id", "high")
    p = p.join(users, "user_id", "left")
    e = F.col("day") - F.col("t0")
    dummies = {f"b{k}": F.coalesce((e == -k).cast("int"), F.lit(0)) for k in range(LEADS, 0, -1)}
    dummies.update({f"a{k}": F.coalesce((e == k).cast("int"), F.lit(0)) for k in range(LAGS + 1)})
    return p.withColumns(dummies)


_LAST_DUMMIES = [f"b{k}" for k in range(LEADS, 0, -1)] + [f"a{k}" for k in range(LAGS + 1)]
SQL_EST_PANEL = f"""est AS MATERIALIZED (SELECT p.*, CASE WHEN um > (SELECT median(um) FROM (SELECT avg(value) AS um FROM events GROUP BY user_id))
    THEN 1 ELSE 0 END AS high, {', '.join(
      f"CASE WHEN day - t0 = {-int(d[1:]) if d[0] == 'b' else int(d[1:])} THEN 1 ELSE 0 END AS {d}" for d in _LAST_DUMMIES)}
  FROM ({SQL_DAY_PANEL_T}) p JOIN (SELECT user_id, avg(value) AS um FROM events GROUP BY user_id) USING (user_id))"""


def _fit_sql(fits, select):
    """WITH RECURSIVE over the panel, its fits and the final selection."""
    return "WITH RECURSIVE " + ",\n".join([SQL_EST_PANEL, *fits]) + "\n" + select


def _terms_sql(terms):
    """Products of panel columns for notation such as ``tre#high``."""
    return [" * ".join(f"CAST({v} AS DOUBLE)" for v in t.replace("c.", "").split("#")) for t in terms]


def _coef_sql(tag, terms, robust=True, extra=""):
    return (f"SELECT {extra}term, {QZ('coef', 6)} AS coef, {QZ('se', 6)} AS se, omitted "
            f"FROM ({sql_fit.coefficients(tag, terms, robust)})")


def _coefs(spark, fits, *keep):
    """Rounded coefficient rows."""
    return coef_table(spark, fits).select(*keep, "term", qz("coef", 6).alias("coef"), qz("se", 6).alias("se"), "omitted")


# ---------------------------------------------------------------------------- E1
SQL_E1 = f"""WITH p AS (SELECT value_mean AS y, CAST(n_events AS DOUBLE) AS x FROM ({SQL_DAY_PANEL})),
 m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
              regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_count(y, x) AS n, avg(x) AS xbar FROM p),
 s AS (SELECT *, (syy - b * sxy) / (n - 2) AS s2 FROM m)
SELECT 'n_events' AS term, {QZ('b', 6)} AS coef, {QZ('sqrt(s2 / sxx)', 6)} AS se FROM s
UNION ALL SELECT '_cons', {QZ('a', 6)}, {QZ('sqrt(s2 * (1.0 / n + xbar * xbar / sxx))', 6)} FROM s"""


@reg("e1_ols_one_regressor", SQL_E1)
def e1_ols_one_regressor(spark, sf):
    p = events_day_panel(spark, sf).withColumn("n_events", F.col("n_events").cast("double"))
    return _coef_rows(spark, [ols(p, "value_mean", ["n_events"], vce="classic")])


E1_TERMS = ["tre", "high", "tre#high", "n_events"]


@reg("e1_ols_interaction", _fit_sql([sql_fit.chain("f", "est", _terms_sql(E1_TERMS), "value_mean", None)],
                                    _coef_sql("f", E1_TERMS, robust=False)))
def e1_ols_interaction(spark, sf):
    p = est_panel(spark, sf)
    fit = ols(p, "value_mean", ["tre##high", "c.n_events"], vce="classic", model_id="ols_int")
    return _coefs(spark, [fit])


# ---------------------------------------------------------------------------- E2
SQL_E2 = f"""WITH p AS (SELECT user_id, value_mean AS y, CAST(n_events AS DOUBLE) AS x FROM ({SQL_DAY_PANEL})),
 d AS (SELECT user_id, x, y, x - avg(x) OVER (PARTITION BY user_id) AS xt,
              y - avg(y) OVER (PARTITION BY user_id) AS yt FROM p),
 b AS (SELECT sum(xt * yt) / sum(xt * xt) AS b, sum(xt * xt) AS sxx, count(*) AS n,
              count(DISTINCT user_id) AS g, avg(x) AS xbar, avg(y) AS ybar FROM d),
 r AS (SELECT d.*, yt - b.b * xt AS e FROM d, b)
SELECT 'n_events' AS term, {QZ('(SELECT b FROM b)', 6)} AS coef,
  {QZ('sqrt(b.n / (b.n - b.g - 1) * sum(e * e * xt * xt)) / b.sxx', 6)} AS se FROM r, b GROUP BY b.n, b.g, b.sxx
UNION ALL
SELECT '_cons', {QZ('b.ybar - b.b * b.xbar', 6)},
  {QZ('sqrt(b.n / (b.n - b.g - 1) * sum(e * e * power(1.0 / b.n - b.xbar * xt / b.sxx, 2)))', 6)}
FROM r, b GROUP BY b.n, b.g, b.sxx, b.ybar, b.b, b.xbar"""


@reg("e2_areg_one_regressor", SQL_E2)
def e2_areg_one_regressor(spark, sf):
    p = events_day_panel(spark, sf).withColumn("n_events", F.col("n_events").cast("double"))
    return _coef_rows(spark, [areg(p, "value_mean", ["n_events"], absorb="user_id")])


E2_TERMS = ["tre", "tre#high", "n_events"]


@reg("e2_areg_controls", _fit_sql(
    [sql_fit.chain("f", "est", _terms_sql(E2_TERMS), "value_mean", "user_id", "day")],
    _coef_sql("f", E2_TERMS) + f" UNION ALL SELECT '_stats', {QZ('r2', 6)}, {QZ('rmse', 6)}, false FROM ({sql_fit.statistics('f')})"))
def e2_areg_controls(spark, sf):
    p = est_panel(spark, sf)
    fit = areg(p, "value_mean", E2_TERMS, absorb="user_id", time="day", model_id="areg_did")
    return _coefs(spark, [fit]).unionByName(stats_table(spark, [fit]).select(
        F.lit("_stats").alias("term"), qz("r2", 6).alias("coef"), qz("rmse", 6).alias("se"),
        F.lit(False).alias("omitted")))


# ---------------------------------------------------------------------------- E3
def _balanced(spark, sf):
    p = events_day_panel(spark, sf).select("user_id", "day", "value_mean",
                                           F.col("n_events").cast("double").alias("n_events"))
    return fill_balanced(p, "user_id", "day", {"value_mean": 0.0, "n_events": 0.0})


SQL_BAL = f"""WITH p0 AS ({SQL_DAY_PANEL}),
 dd AS (SELECT CAST(unnest(range(min(day), max(day) + 1)) AS INTEGER) AS day FROM p0),
 g AS (SELECT u.user_id, dd.day FROM (SELECT DISTINCT user_id FROM p0) u CROSS JOIN dd),
 p AS (SELECT g.user_id, g.day, COALESCE(p0.value_mean, 0.0) AS y, CAST(COALESCE(p0.n_events, 0) AS DOUBLE) AS x
       FROM g LEFT JOIN p0 ON p0.user_id = g.user_id AND p0.day = g.day)"""

SQL_E3 = f"""{SQL_BAL},
 d AS (SELECT user_id, day,
   x - avg(x) OVER (PARTITION BY user_id) - avg(x) OVER (PARTITION BY day) + avg(x) OVER () AS xh,
   y - avg(y) OVER (PARTITION BY user_id) - avg(y) OVER (PARTITION BY day) + avg(y) OVER () AS yh FROM p),
 b AS (SELECT sum(xh * yh) / sum(xh * xh) AS b, sum(xh * xh) AS sxx, count(*) AS n,
              count(DISTINCT user_id) AS g, count(DISTINCT day) AS t FROM d)
SELECT 'n_events' AS term, {QZ('b.b', 6)} AS coef,
  {QZ('sqrt(b.n / (b.n - b.g - b.t) * sum(power(yh - b.b * xh, 2) * xh * xh)) / b.sxx', 6)} AS se
FROM d, b GROUP BY b.b, b.n, b.g, b.t, b.sxx"""


@reg("e3_areg_two_way", SQL_E3)
def e3_areg_two_way(spark, sf):
    fit = areg(_balanced(spark, sf), "value_mean", ["n_events"], absorb="user_id", time="day")
    return _coef_rows(spark, [fit], terms=["n_events"])


@reg("e3_areg_two_way_unbalanced", _fit_sql(
    [sql_fit.chain("f", "est", ["n_events"], "value_mean", "user_id", "day")], _coef_sql("f", ["n_events"])))
def e3_areg_two_way_unbalanced(spark, sf):
    return _coefs(spark, [areg(est_panel(spark, sf), "value_mean", ["n_events"], absorb="user_id", time="day")])


# ---------------------------------------------------------------------------- E4
SQL_E4 = f"""WITH p AS (SELECT user_id, value_mean AS y, CAST(n_events AS DOUBLE) AS x FROM ({SQL_DAY_PANEL})),
 d AS (SELECT user_id, x - avg(x) OVER (PARTITION BY user_id) AS xt,
              y - avg(y) OVER (PARTITION BY user_id) AS yt FROM p),
 b AS (SELECT sum(xt * yt) / sum(xt * xt) AS b, sum(xt * xt) AS sxx, sum(yt * yt) AS syy,
              count(*) AS n, count(DISTINCT user_id) AS g FROM d)
SELECT 'n_events' AS term, {QZ('b', 6)} AS coef, {QZ('sqrt((syy - b * b * sxx) / (n - g - 1) / sxx)', 6)} AS se
FROM b"""


@reg("e4_within_classic", SQL_E4)
def e4_within_classic(spark, sf):
    p = events_day_panel(spark, sf).withColumn("n_events", F.col("n_events").cast("double"))
    return _coef_rows(spark, [within(p, "value_mean", ["n_events"], "user_id")])


SQL_E4_TW = f"""{SQL_BAL},
 d AS (SELECT user_id, day,
   x - avg(x) OVER (PARTITION BY user_id) - avg(x) OVER (PARTITION BY day) + avg(x) OVER () AS xh,
   y - avg(y) OVER (PARTITION BY user_id) - avg(y) OVER (PARTITION BY day) + avg(y) OVER () AS yh FROM p),
 b AS (SELECT sum(xh * yh) / sum(xh * xh) AS b, sum(xh * xh) AS sxx, sum(yh * yh) AS syy, count(*) AS n,
              count(DISTINCT user_id) AS g, count(DISTINCT day) AS t FROM d)
SELECT 'n_events' AS term, {QZ('b', 6)} AS coef, {QZ('sqrt((syy - b * b * sxx) / (n - g - t) / sxx)', 6)} AS se
FROM b"""


@reg("e4_within_two_way", SQL_E4_TW)
def e4_within_two_way(spark, sf):
    fit = within(_balanced(spark, sf), "value_mean", ["n_events"], "user_id", time="day",
                 effect="twoways", model_id="within_tw")
    return _coef_rows(spark, [fit])


# ---------------------------------------------------------------------------- E5
PATH_SCHEMA = ("series string, event_time int, term string, coef double, se double, "
               "ci_lo double, ci_hi double")


def _event_terms():
    dummies = [f"b{k}" for k in range(LEADS, 1, -1)] + [f"a{k}" for k in range(LAGS + 1)]
    times = [-k for k in range(LEADS, 1, -1)] + list(range(LAGS + 1))
    return dummies, times


def _path_sql(terms, group):
    names = list(terms) + ([f"{d}#{group}" for d in terms] if group else [])
    times = ", ".join(str(t) for t in _event_terms()[1] * (2 if group else 1))
    n = len(terms)
    return _fit_sql([sql_fit.chain("f", "est", _terms_sql(names), "value_mean", "user_id", "day")],
                    f"SELECT CASE WHEN i <= {n} THEN 'base' ELSE 'diff' END AS series, CAST(([{times}])[i] AS INTEGER) AS event_time, "
                    f"[{', '.join(repr(t) for t in names)}][i] AS term, {QZ('coef', 6)} AS coef, {QZ('se', 6)} AS se "
                    f"FROM ({sql_fit.coefficients('f', names, cons=False)})")


def _path(spark, rows):
    return spark.createDataFrame(rows, PATH_SCHEMA).select(
        "series", "event_time", "term", qz("coef", 6).alias("coef"), qz("se", 6).alias("se"))


@reg("e5_event_study", _path_sql(_event_terms()[0], None))
def e5_event_study(spark, sf):
    p = est_panel(spark, sf)
    dummies, times = _event_terms()
    fit, path = event_study(p, "value_mean", dummies, absorb="user_id", period="day",
                            event_times=times)
    return _path(spark, path)


@reg("e5_event_study_by_group", _path_sql(_event_terms()[0], "high"))
def e5_event_study_by_group(spark, sf):
    p = est_panel(spark, sf)
    dummies, times = _event_terms()
    fit, path = event_study(p, "value_mean", dummies, absorb="user_id", period="day",
                            event_times=times, group="high", model_id="event_by_high")
    return _path(spark, path)


# ---------------------------------------------------------------------------- E6
E6_TERMS = ["tre", "high", "n_events", "tre#high", "tre#n_events", "high#n_events", "tre#high#n_events"]


@reg("e6_three_way", _fit_sql([sql_fit.chain("f", "est", _terms_sql(E6_TERMS), "value_mean", "user_id", "day")],
                              _coef_sql("f", E6_TERMS)))
def e6_three_way(spark, sf):
    p = est_panel(spark, sf)
    fit = areg(p, "value_mean", ["tre##high##c.n_events"], absorb="user_id", time="day", model_id="het")
    return _coefs(spark, [fit])


# ---------------------------------------------------------------------------- E7 / E8
OUTCOMES = ["value_mean", "n_events"]
MODERATORS = ["high", "heavy"]


def grid_panel(spark, sf):
    p = est_panel(spark, sf)
    heavy = high_low(p.groupBy("user_id").agg(F.avg("n_events").alias("ne")), "ne", out="heavy")
    return p.join(heavy.select("user_id", "heavy"), "user_id", "left")


def run_grid(spark, sf):
    p = grid_panel(spark, sf)
    return grid(p, OUTCOMES, MODERATORS, lambda o, m: ["tre", f"tre#{m}"], absorb="user_id", time="day",
                tests=lambda s: [("joint_tre", ["tre", s[2][1]])])


SQL_GRID_PANEL = """gp AS MATERIALIZED (SELECT est.*, CASE WHEN ne > (SELECT median(ne) FROM (SELECT avg(n_events) AS ne FROM est GROUP BY user_id))
    THEN 1 ELSE 0 END AS heavy FROM est JOIN (SELECT user_id, avg(n_events) AS ne FROM est GROUP BY user_id) USING (user_id))"""
GRID = [(f"m{i}", o, m) for i, (o, m) in enumerate((o, m) for o in OUTCOMES for m in MODERATORS)]


def _grid_sql(select):
    """One fit per model of the grid; ``select(tag, outcome, moderator)`` of each."""
    return _fit_sql([SQL_GRID_PANEL, *(sql_fit.chain(t, "gp", _terms_sql(["tre", f"tre#{m}"]), o, "user_id", "day")
                                       for t, o, m in GRID)],
                    "\nUNION ALL ".join(select(*g) for g in GRID))


@reg("e7_model_grid", _grid_sql(lambda t, o, m: _coef_sql(t, ["tre", f"tre#{m}"], extra=f"'{o}|{m}' AS model_id, ")))
def e7_model_grid(spark, sf):
    return _coefs(spark, run_grid(spark, sf), "model_id")


@reg("e8_wald_tests", _grid_sql(lambda t, o, m: f"SELECT '{o}|{m}' AS model_id, 'joint_tre' AS test, 2 AS q, df_r, "
                                                f"{QZ('f', 6)} AS f FROM ({sql_fit.wald2(t)})"))
def e8_wald_tests(spark, sf):
    return tests_table(spark, run_grid(spark, sf)).select("model_id", "test", "q", "df_r", qz("f", 6).alias("f"))


GRID_Y = ["value_mean", "last_event"]
GRID_X = ["n_events", "tre"]


def _sql_areg1(y, x, mid):
    return f"""SELECT '{mid}' AS model_id, '{x}' AS term, {QZ('b.b', 6)} AS coef,
  {QZ('sqrt(b.n / (b.n - b.g - 1) * sum(power(d.yt - b.b * d.xt, 2) * d.xt * d.xt)) / b.sxx', 6)} AS se
FROM (SELECT user_id, {x} - avg({x}) OVER (PARTITION BY user_id) AS xt,
             {y} - avg({y}) OVER (PARTITION BY user_id) AS yt FROM g) d,
     (SELECT sum(xt * yt) / sum(xt * xt) AS b, sum(xt * xt) AS sxx, count(*) AS n,
             count(DISTINCT user_id) AS g
      FROM (SELECT user_id, {x} - avg({x}) OVER (PARTITION BY user_id) AS xt,
                   {y} - avg({y}) OVER (PARTITION BY user_id) AS yt FROM g)) b
GROUP BY b.b, b.n, b.g, b.sxx"""


SQL_E7 = (f"""WITH g AS (SELECT user_id, value_mean, CAST(last_event AS DOUBLE) AS last_event,
  CAST(n_events AS DOUBLE) AS n_events, CAST(tre AS DOUBLE) AS tre FROM ({SQL_DAY_PANEL_T})) """
          + " UNION ALL ".join(_sql_areg1(y, x, f"{y}|{x}") for y in GRID_Y for x in GRID_X))


@reg("e7_grid_one_regressor", SQL_E7)
def e7_grid_one_regressor(spark, sf):
    p = day_panel(spark, sf).select(
        "user_id", "value_mean", F.col("last_event").cast("double").alias("last_event"),
        F.col("n_events").cast("double").alias("n_events"), F.col("tre").cast("double").alias("tre"))
    fits = grid(p, GRID_Y, GRID_X, lambda o, m: [m], absorb="user_id")
    c = coef_table(spark, fits).filter(F.col("term") != "_cons")
    return c.select("model_id", "term", qz("coef", 6).alias("coef"), qz("se", 6).alias("se"))


def _sql_stats1(y, x, mid):
    return f"""SELECT '{mid}' AS model_id, n, g AS n_groups, g - 1 AS df_a, n - g - 1 AS df_r,
  {QZ('1 - rss / tss', 6)} AS r2, {QZ('sqrt(rss / (n - g - 1))', 6)} AS rmse
FROM (SELECT count(*) AS n, count(DISTINCT user_id) AS g,
             sum(power(yt - bb * xt, 2)) AS rss, sum(power(yy - ybar, 2)) AS tss
      FROM (SELECT user_id, yt, xt, yy, avg(yy) OVER () AS ybar,
                   sum(xt * yt) OVER () / sum(xt * xt) OVER () AS bb
            FROM (SELECT user_id, {y} AS yy, {x} - avg({x}) OVER (PARTITION BY user_id) AS xt,
                         {y} - avg({y}) OVER (PARTITION BY user_id) AS yt FROM g)))"""


SQL_E10 = (f"""WITH g AS (SELECT user_id, value_mean, CAST(last_event AS DOUBLE) AS last_event,
  CAST(n_events AS DOUBLE) AS n_events, CAST(tre AS DOUBLE) AS tre FROM ({SQL_DAY_PANEL_T})) """
           + " UNION ALL ".join(_sql_stats1(y, x, f"{y}|{x}") for y in GRID_Y for x in GRID_X))


@reg("e10_model_stats_one_regressor", SQL_E10)
def e10_model_stats_one_regressor(spark, sf):
    p = day_panel(spark, sf).select(
        "user_id", "value_mean", F.col("last_event").cast("double").alias("last_event"),
        F.col("n_events").cast("double").alias("n_events"), F.col("tre").cast("double").alias("tre"))
    fits = grid(p, GRID_Y, GRID_X, lambda o, m: [m], absorb="user_id")
    st = stats_table(spark, fits)
    return st.select("model_id", "n", "n_groups", "df_a", "df_r", qz("r2", 6).alias("r2"),
                     qz("rmse", 6).alias("rmse"))


SQL_E8 = f"""WITH p AS ({SQL_DAY_PANEL_T}),
 s AS (SELECT user_id, value_mean AS y, CAST(tre AS DOUBLE) AS x1, CAST(n_events AS DOUBLE) AS x2 FROM p),
 d AS (SELECT user_id, x1 - avg(x1) OVER (PARTITION BY user_id) AS a1, x2 - avg(x2) OVER (PARTITION BY user_id) AS a2,
              y - avg(y) OVER (PARTITION BY user_id) AS yt FROM s),
 m AS (SELECT sum(a1 * a1) AS s11, sum(a1 * a2) AS s12, sum(a2 * a2) AS s22, sum(a1 * yt) AS s1y,
              sum(a2 * yt) AS s2y, count(*) AS n, count(DISTINCT user_id) AS g FROM d),
 b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
              (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m),
 e AS (SELECT d.a1, d.a2, d.yt - b.b1 * d.a1 - b.b2 * d.a2 AS r FROM d, b),
 mt AS (SELECT sum(r * r * a1 * a1) AS m11, sum(r * r * a1 * a2) AS m12, sum(r * r * a2 * a2) AS m22 FROM e),
 v AS (SELECT b.*, n * 1.0 / (n - g - 2) AS q,
   n * 1.0 / (n - g - 2) * (s22 * s22 * m11 - 2 * s22 * s12 * m12 + s12 * s12 * m22) / (det * det) AS v11,
   n * 1.0 / (n - g - 2) * (s12 * s12 * m11 - 2 * s11 * s12 * m12 + s11 * s11 * m22) / (det * det) AS v22,
   n * 1.0 / (n - g - 2) * (-s22 * s12 * m11 + (s11 * s22 + s12 * s12) * m12 - s11 * s12 * m22) / (det * det) AS v12
   FROM b, mt)
SELECT 'joint' AS test, 2 AS q, CAST(n - g - 2 AS BIGINT) AS df_r,
  {QZ('(b1 * b1 * v22 - 2 * b1 * b2 * v12 + b2 * b2 * v11) / (v11 * v22 - v12 * v12) / 2', 6)} AS f
FROM v"""


@reg("e8_wald_two_regressors", SQL_E8)
def e8_wald_two_regressors(spark, sf):
    p = day_panel(spark, sf).select("user_id", "value_mean", F.col("tre").cast("double").alias("tre"),
                                    F.col("n_events").cast("double").alias("n_events"))
    fit = areg(p, "value_mean", ["tre", "n_events"], absorb="user_id", tests=[("joint", ["tre", "n_events"])])
    t = tests_table(spark, [fit])
    return t.select("test", "q", "df_r", qz("f", 6).alias("f"))


# ---------------------------------------------------------------------------- E9
@reg("e9_margins", f"""WITH p AS ({SQL_WEEK_PANEL}),
 s AS (SELECT week, high, value_mean AS y, avg(value_mean) OVER (PARTITION BY week, high) AS m, count(*) OVER () AS n,
         count(*) OVER (PARTITION BY week, high) AS c FROM p
       WHERE value_mean IS NOT NULL AND high IS NOT NULL AND week IS NOT NULL),
 k AS (SELECT count(*) AS k FROM (SELECT DISTINCT week, high FROM s))
SELECT week, high, {QZ('any_value(m)')} AS margin,
  {QZ('sqrt(any_value(n) * 1.0 / (any_value(n) - any_value(k)) * sum(power(y - m, 2))) / any_value(c)')} AS se
FROM s, k GROUP BY week, high""")
def e9_margins(spark, sf):
    p = week_panel(spark, sf)
    fit = ols(p, "value_mean", ["high##i.week"], vce="robust", model_id="saturated")
    rows = margins(p, fit, {"week": factor_levels(p, "week"), "high": [0, 1]})
    m = spark.createDataFrame(rows, "week int, high int, margin double, se double, lo double, hi double")
    return m.select("week", "high", qz("margin").alias("margin"), qz("se").alias("se"))


# ---------------------------------------------------------------------------- E10
def _wide_sql():
    """Cells without stars: the t distribution is beyond SQL."""
    cell = "CASE WHEN omitted THEN '(omitted)' ELSE format('{:,.3f}', coef) || ' (' || format('{:,.3f}', se) || ')' END"
    one = lambda t, o, m: (f"SELECT '{o}|{m}' AS model_id, term, {cell} AS cell "  # noqa: E731
                           f"FROM ({sql_fit.coefficients(t, ['tre', f'tre#{m}'])})")
    cells = ", ".join(f"max(cell) FILTER (model_id = '{o}|{m}') AS \"{o}|{m}\"" for _, o, m in GRID)
    return _fit_sql([SQL_GRID_PANEL, *(sql_fit.chain(t, "gp", _terms_sql(["tre", f"tre#{m}"]), o, "user_id", "day")
                                       for t, o, m in GRID),
                     "cells AS (" + "\nUNION ALL ".join(one(*g) for g in GRID) + ")"],
                    f"SELECT term, {cells} FROM cells GROUP BY term")


@reg("e10_coef_table_wide", _wide_sql())
def e10_coef_table_wide(spark, sf):
    fits = run_grid(spark, sf)
    c = coef_table(spark, fits).withColumn("stars", F.lit(""))
    return wide_table(c, [f.model_id for f in fits])


STATS = ["r2", "r2_adj", "r2_within", "rmse"]


@reg("e10_model_stats", _grid_sql(
    lambda t, o, m: f"SELECT '{o}|{m}' AS model_id, n, n_groups, df_a, df_r, k, "
                    f"{', '.join(f'{QZ(c, 6)} AS {c}' for c in STATS)} FROM ({sql_fit.statistics(t)})"))
def e10_model_stats(spark, sf):
    return stats_table(spark, run_grid(spark, sf)).select(
        "model_id", "n", "n_groups", "df_a", "df_r", "k", *[qz(c, 6).alias(c) for c in STATS])


# ---------------------------------------------------------------------------- E11
SQL_E11 = f"""WITH p AS ({SQL_DAY_PANEL_T}),
 u AS (SELECT user_id, CASE WHEN avg(value) > (SELECT median(um) FROM (SELECT avg(value) AS um FROM events
                                                                      GROUP BY user_id)) THEN 1 ELSE 0 END AS high
       FROM events GROUP BY user_id),
 s AS (SELECT p.user_id, p.value_mean AS y, CAST(p.tre AS DOUBLE) AS x1, CAST(p.n_events AS DOUBLE) AS x2
       FROM p JOIN u ON u.user_id = p.user_id WHERE p.value_mean IS NOT NULL),
 d AS (SELECT user_id, x1 - avg(x1) OVER (PARTITION BY user_id) AS a1, x2 - avg(x2) OVER (PARTITION BY user_id) AS a2,
              y - avg(y) OVER (PARTITION BY user_id) AS yt FROM s),
 m AS (SELECT sum(a1 * a1) AS s11, sum(a1 * a2) AS s12, sum(a2 * a2) AS s22, sum(a1 * yt) AS s1y,
              sum(a2 * yt) AS s2y, count(*) AS n, count(DISTINCT user_id) AS g FROM d),
 b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
              (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM m),
 e AS (SELECT d.a1, d.a2, d.yt - b.b1 * d.a1 - b.b2 * d.a2 AS r FROM d, b),
 mt AS (SELECT sum(r * r * a1 * a1) AS m11, sum(r * r * a1 * a2) AS m12, sum(r * r * a2 * a2) AS m22 FROM e),
 v AS (SELECT b.*, mt.*, n * 1.0 / (n - g - 2) AS q FROM b, mt)
SELECT 'tre' AS term, {QZ('b1', 6)} AS coef,
  {QZ('sqrt(q * (s22 * s22 * m11 - 2 * s22 * s12 * m12 + s12 * s12 * m22) / (det * det))', 6)} AS se,
  false AS omitted FROM v
UNION ALL SELECT 'high', 0.0, NULL, true
UNION ALL SELECT 'n_events', {QZ('b2', 6)},
  {QZ('sqrt(q * (s12 * s12 * m11 - 2 * s11 * s12 * m12 + s11 * s11 * m22) / (det * det))', 6)}, false FROM v"""


@reg("e11_collinear_omitted", SQL_E11)
def e11_collinear_omitted(spark, sf):
    p = est_panel(spark, sf)
    fit = areg(p, "value_mean", ["tre", "high", "n_events"], absorb="user_id", model_id="collinear")
    c = coef_table(spark, [fit]).filter(F.col("term") != "_cons")
    return c.select("term", qz("coef", 6).alias("coef"), qz("se", 6).alias("se"), "omitted")


# an entity-constant term without an exact binary value, first and last in the order
E11_ORDERS = {"first": ["tenth", "n_events"], "last": ["n_events", "tenth"]}


@reg("e11_absorbed_term", _fit_sql(
    ["tp AS MATERIALIZED (SELECT *, 0.1 * (user_id % 7 + 1) AS tenth FROM est)",
     *(sql_fit.chain(k, "tp", ts, "value_mean", "user_id") for k, ts in E11_ORDERS.items())],
    " UNION ALL ".join(_coef_sql(k, ts, extra=f"'{k}' AS model_id, ") for k, ts in E11_ORDERS.items())))
def e11_absorbed_term(spark, sf):
    p = est_panel(spark, sf).withColumn("tenth", F.lit(0.1) * (F.pmod("user_id", F.lit(7)) + 1))
    fits = [areg(p, "value_mean", ts, absorb="user_id", model_id=k) for k, ts in E11_ORDERS.items()]
    return _coefs(spark, fits, "model_id")


# ---------------------------------------------------------------------------- printed tables: t, p, limits, stars
def _printed_sql(fits, rows, select):
    """``rows`` (.., coef, se, df_r) with t, p, 95 % limits and stars; the quantile is taken once per df_r."""
    return _fit_sql([*fits, f"rows AS ({rows})",
                     f"crit AS (SELECT df_r, {sql_t_quantile(0.975, 'df_r')} AS c FROM (SELECT DISTINCT df_r FROM rows))",
                     f"printed AS (SELECT rows.*, coef / se AS t, {sql_t_two_sided('(coef / se)', 'rows.df_r')} AS p, "
                     "coef - c * se AS ci_lo, coef + c * se AS ci_hi FROM rows JOIN crit USING (df_r))"],
                    select)


PRINTED = ("coef", "se", "t", "p", "ci_lo", "ci_hi")
SQL_PRINTED = ", ".join(f"{QZ(c, 5)} AS {c}" for c in PRINTED)


def _printed(coefs, *keep):
    return coefs.select(*keep, *[qz(c, 5).alias(c) for c in PRINTED], "stars")


@reg("e2_areg_table", _printed_sql(
    [sql_fit.chain("f", "est", _terms_sql(E2_TERMS), "value_mean", "user_id", "day")],
    f"SELECT x.*, CAST(df_r AS BIGINT) AS df_r FROM ({sql_fit.coefficients('f', E2_TERMS, cons=False)}) x, f_f",
    f"SELECT term, {SQL_PRINTED}, {sql_stars('p')} AS stars FROM printed"))
def e2_areg_table(spark, sf):
    fit = areg(est_panel(spark, sf), "value_mean", E2_TERMS, absorb="user_id", time="day", model_id="areg_did")
    return _printed(coef_table(spark, [fit]).filter("term != '_cons'"), "term")


@reg("e5_event_study_table", _printed_sql(
    [sql_fit.chain("f", "est", _terms_sql(_event_terms()[0]), "value_mean", "user_id", "day")],
    f"SELECT x.*, CAST(df_r AS BIGINT) AS df_r FROM ({sql_fit.coefficients('f', _event_terms()[0], cons=False)}) x, f_f",
    f"SELECT CAST(({_event_terms()[1]})[i] AS INTEGER) AS event_time, term, {SQL_PRINTED}, {sql_stars('p')} AS stars FROM printed"))
def e5_event_study_table(spark, sf):
    dummies, times = _event_terms()
    fit, _ = event_study(est_panel(spark, sf), "value_mean", dummies, absorb="user_id", period="day", event_times=times)
    at = F.element_at(F.create_map(*[F.lit(x) for pair in zip(dummies, times) for x in pair]), F.col("term"))
    c = coef_table(spark, [fit]).withColumn("event_time", at.cast("int")).filter("event_time IS NOT NULL")
    return _printed(c, "event_time", "term")


def _starred_sql():
    """One fit per model; a cell holds coefficient, stars and standard error."""
    names = {f"{o}|{m}": t for t, o, m in GRID}
    rows = "\nUNION ALL ".join(
        f"SELECT '{o}|{m}' AS model_id, x.*, CAST(df_r AS BIGINT) AS df_r FROM "
        f"({sql_fit.coefficients(t, ['tre', f'tre#{m}'])}) x, {t}_f" for t, o, m in GRID)
    cell = (f"CASE WHEN omitted THEN '(omitted)' ELSE format('{{:,.3f}}', coef) || {sql_stars('p')} || ' (' || "
            "format('{:,.3f}', se) || ')' END")
    cells = ", ".join(f"max(cell) FILTER (model_id = '{n}') AS \"{n}\"" for n in names)
    head = _fit_sql([SQL_GRID_PANEL, *(sql_fit.chain(t, "gp", _terms_sql(["tre", f"tre#{m}"]), o, "user_id", "day") for t, o, m in GRID),
                     f"rows AS ({rows})", f"printed AS (SELECT *, {sql_t_two_sided('(coef / se)', 'df_r')} AS p FROM rows)"], "")
    return f"{head} SELECT term, {cells} FROM (SELECT model_id, term, {cell} AS cell FROM printed) GROUP BY term"


@reg("e10_coef_table_starred", _starred_sql())
def e10_coef_table_starred(spark, sf):
    fits = run_grid(spark, sf)
    return wide_table(coef_table(spark, fits), [f.model_id for f in fits])


QUERIES, SQL = Q, S
