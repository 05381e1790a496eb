"""Registered queries: window-type operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.operators.joins import fill_balanced
from panora.operators.window import flag, group_stat, latest, locf, table_stat, time_lag, xtile
from panora.plans.common import QZ, SQL_DAY_PANEL, T, events_day_panel, qz
from panora.plans.q_aggregate import SQL_SITES, sites

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- W1
@reg("w1_group_stat", """
SELECT o_orderkey, o_custkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS cust_max,
  count(*) OVER (PARTITION BY o_custkey) AS cust_n FROM orders""")
def w1_group_stat(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    g = group_stat(o, "o_custkey", {"cust_max": ("max", "o_totalprice"), "cust_n": ("count", "o_orderkey")})
    return g.select("o_orderkey", "o_custkey", "cust_max", "cust_n")


# ---------------------------------------------------------------------------- W2
@reg("w2_table_stat", f"""
SELECT o_orderkey, {QZ('o_totalprice - (SELECT avg(o_totalprice) FROM orders)', 2)} AS dev_mean,
  CASE WHEN o_totalprice > (SELECT median(o_totalprice) FROM orders) THEN 1 ELSE 0 END AS above_median
FROM orders""")
def w2_table_stat(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    t = table_stat(o, {"m": ("mean", "o_totalprice"), "md": ("median", "o_totalprice")})
    return t.select("o_orderkey", qz(F.col("o_totalprice") - F.col("m"), 2).alias("dev_mean"),
                    flag("o_totalprice", ">", F.col("md")).alias("above_median"))


# ---------------------------------------------------------------------------- W3
def _gappy_grid(spark, sf):
    p = events_day_panel(spark, sf).select("user_id", "day", "value_mean")
    return fill_balanced(p, "user_id", "day")


SQL_W3 = f"""WITH p AS ({SQL_DAY_PANEL}),
 d AS (SELECT CAST(unnest(range(min(day), max(day) + 1)) AS INTEGER) AS day FROM p),
 g AS (SELECT u.user_id, d.day FROM (SELECT DISTINCT user_id FROM p) u CROSS JOIN d),
 j AS (SELECT g.user_id, g.day, p.value_mean FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.day = g.day)
SELECT user_id, day, {QZ('''last_value(value_mean IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''')} AS value_mean FROM j"""


@reg("w3_locf", SQL_W3)
def w3_locf(spark, sf):
    f = locf(_gappy_grid(spark, sf), "user_id", "day", ["value_mean"], chunk=0)
    return f.select("user_id", "day", qz("value_mean").alias("value_mean"))


@reg("w3_locf_chunked", SQL_W3)
def w3_locf_chunked(spark, sf):
    f = locf(_gappy_grid(spark, sf), "user_id", "day", ["value_mean"], chunk=7)
    return f.select("user_id", "day", qz("value_mean").alias("value_mean"))


# ---------------------------------------------------------------------------- W4
@reg("w4_time_lag", f"""
WITH p AS ({SQL_DAY_PANEL})
SELECT p.user_id, p.day, {QZ('p.value_mean')} AS value_mean, {QZ('a.value_mean')} AS L1_value_mean,
  b.n_events AS L7_n_events
FROM p LEFT JOIN p a ON a.user_id = p.user_id AND a.day = p.day - 1
       LEFT JOIN p b ON b.user_id = p.user_id AND b.day = p.day - 7""")
def w4_time_lag(spark, sf):
    p = events_day_panel(spark, sf).select("user_id", "day", "value_mean", "n_events")
    p1 = time_lag(p, "user_id", "day", ["value_mean"], 1)
    p7 = time_lag(p1, "user_id", "day", ["n_events"], 7)
    return p7.select("user_id", "day", qz("value_mean").alias("value_mean"),
                     qz("L1_value_mean").alias("L1_value_mean"), "L7_n_events")


# ---------------------------------------------------------------------------- W5
def _sql_cuts(x, k):
    parts = []
    for j in range(1, k):
        parts.append(f"avg({x}) FILTER (WHERE (n * {j} % {k} = 0 AND r IN (n * {j} // {k}, n * {j} // {k} + 1))"
                     f" OR (n * {j} % {k} <> 0 AND r = n * {j} // {k} + 1)) AS c{j}")
    return ", ".join(parts)


def _sql_bins(x, k):
    whens = " ".join(f"WHEN {x} <= c{j} THEN {j}" for j in range(1, k))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE {k} END"


def _sql_xtile(x, k, source):
    return f"""WITH s AS ({source}),
 v AS (SELECT {x}, row_number() OVER (ORDER BY {x}) AS r, count(*) OVER () AS n FROM s WHERE {x} IS NOT NULL),
 c AS (SELECT {_sql_cuts(x, k)} FROM v),
 b AS (SELECT s.*, CAST({_sql_bins(x, k)} AS INTEGER) AS q FROM s, c)"""


SITES_NULL = f"""SELECT c_custkey, c_nationkey, CASE WHEN emple > 0 THEN emple END AS emple,
  CASE WHEN emple > 0 THEN budget END AS budget FROM ({SQL_SITES})"""


def _sites_null(spark, sf):
    s = sites(spark, sf)
    has = F.col("emple") > 0
    return s.select("c_custkey", "c_nationkey", F.when(has, F.col("emple")).alias("emple"),
                    F.when(has, F.col("budget")).alias("budget"))


@reg("w5_xtile", f"""{_sql_xtile('budget', 4, SITES_NULL)}
SELECT q, count(*) AS n, {QZ('min(budget)')} AS lo, {QZ('max(budget)')} AS hi FROM b GROUP BY q""")
def w5_xtile(spark, sf):
    b = xtile(_sites_null(spark, sf), "budget", 4, out="q")
    return b.groupBy("q").agg(F.count(F.lit(1)).alias("n"), qz(F.min("budget")).alias("lo"),
                              qz(F.max("budget")).alias("hi"))


@reg("w5_xtile_ties", f"""{_sql_xtile('emple', 5, SITES_NULL)}
SELECT q, count(*) AS n, min(emple) AS lo, max(emple) AS hi FROM b GROUP BY q""")
def w5_xtile_ties(spark, sf):
    b = xtile(_sites_null(spark, sf), "emple", 5, out="q")
    return b.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("emple").alias("lo"),
                              F.max("emple").alias("hi"))


# ---------------------------------------------------------------------------- W6
@reg("w6_quantile_flags", f"""{_sql_xtile('budget', 4, SITES_NULL)}
SELECT q, CASE WHEN q IS NULL THEN NULL WHEN q = 4 THEN 1 ELSE 0 END AS q4_high,
  CASE WHEN q IS NULL THEN NULL WHEN q > 2 THEN 1 ELSE 0 END AS q2_high,
  CASE WHEN q IS NULL THEN 0 WHEN q = 4 THEN 1 ELSE 0 END AS q4_high_stata,
  CASE WHEN q IS NULL THEN 1 WHEN q > 2 THEN 1 ELSE 0 END AS q2_high_stata,
  CASE WHEN emple > (SELECT avg(emple) FROM s) THEN 1 WHEN emple IS NULL THEN NULL ELSE 0 END AS emple_high,
  count(*) AS n
FROM b GROUP BY ALL""")
def w6_quantile_flags(spark, sf):
    b = xtile(_sites_null(spark, sf), "budget", 4, out="q")
    emean = b.select(F.avg("emple")).scalar()
    b = b.select("q", flag("q", "==", 4).alias("q4_high"), flag("q", ">", 2).alias("q2_high"),
                 flag("q", "==", 4, missing="stata").alias("q4_high_stata"),
                 flag("q", ">", 2, missing="stata").alias("q2_high_stata"),
                 flag("emple", ">", emean).alias("emple_high"))
    return b.groupBy(*b.columns).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- W7
@reg("w7_latest_per_entity", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders o
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders i WHERE i.o_custkey = o.o_custkey)""")
def w7_latest_per_entity(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest(o, "o_orderdate", "o_custkey")


@reg("w7_latest_table", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def w7_latest_table(spark, sf):
    o = T(spark, sf, "orders")
    return latest(o, "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


QUERIES, SQL = Q, S
