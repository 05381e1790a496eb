"""Registered queries: treatment / panel design (T1-T7) and the flagship
group-trend table (D13).  Proxy: events -> user x week (or day) panel; the
user's own policy day and its group's policy day (see ``common``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.operators.aggregate import resample
from panora.operators.design import (ever_treated, event_dummies, event_time, estimation_sample,
                                     group_2x2, interact, post, treatment_time)
from panora.operators.profile import group_trends
from panora.operators.window import high_low
from panora.plans.common import (QZ, SQL_DAY_PANEL, SQL_POLICY, SQL_WEEK, T, events_day_panel,
                                 policy_days, qz)


def _week_of_day(c):
    return (F.floor((F.col(c) - 1) / 7) + 1).cast("int")


SQL_WEEK_OF_T0 = "CAST(floor((t0 - 1) / 7) + 1 AS INTEGER)"


def week_panel(spark, sf):
    """user x week panel with effective treatment week, post flag and the
    high-value moderator (user mean above the median of user means)."""
    ev = T(spark, sf, "events")
    wk = resample(ev, "user_id", "ts", to="week", mean=["value"], template="{col}_mean")
    pol = policy_days(spark, sf).select("user_id", _week_of_day("t0").alias("t0_week"))
    users = high_low(ev.groupBy("user_id").agg(F.avg("value").alias("user_mean")),
                     "user_mean", by="median", out="high").select("user_id", "high")
    p = wk.join(pol, "user_id", "left").join(users, "user_id", "left")
    return p.withColumn("tre", post("week", "t0_week"))


SQL_WEEK_PANEL = f"""WITH wk AS (SELECT user_id, {SQL_WEEK} AS week, avg(value) AS value_mean
                FROM events GROUP BY 1, 2),
 pol AS ({SQL_POLICY}),
 um AS (SELECT user_id, avg(value) AS user_mean FROM events GROUP BY 1),
 hi AS (SELECT user_id, CASE WHEN user_mean > (SELECT median(user_mean) FROM um) THEN 1 ELSE 0 END
          AS high FROM um)
 SELECT wk.user_id, wk.week, wk.value_mean, {SQL_WEEK_OF_T0} AS t0_week, hi.high,
        COALESCE(CAST(wk.week > {SQL_WEEK_OF_T0} AS INTEGER), 0) AS tre
 FROM wk LEFT JOIN pol ON pol.user_id = wk.user_id LEFT JOIN hi ON hi.user_id = wk.user_id"""


def day_panel(spark, sf):
    """user x day panel with effective treatment day and post flag."""
    pol = policy_days(spark, sf).select("user_id", "t0")
    p = events_day_panel(spark, sf).join(pol, "user_id", "left")
    return p.withColumn("tre", post("day", "t0"))


SQL_DAY_PANEL_T = f"""SELECT d.*, pol.t0, COALESCE(CAST(d.day > pol.t0 AS INTEGER), 0) AS tre
  FROM ({SQL_DAY_PANEL}) d LEFT JOIN ({SQL_POLICY}) pol ON pol.user_id = d.user_id"""


# ---------------------------------------------------------------------------- D13 (flagship)
def d13_group_trends(spark, sf):
    p = week_panel(spark, sf)
    g = group_trends(p, "week", ["tre", "high"], ["value_mean"])
    return g.select("week", "tre", "high", qz("value_mean_mean").alias("value_mean"), "n")


SQL_D13 = f"""WITH p AS ({SQL_WEEK_PANEL})
SELECT week, tre, high, {QZ('avg(value_mean)')} AS value_mean, count(*) AS n
FROM p GROUP BY week, tre, high"""


# ---------------------------------------------------------------------------- T1
def t1_treatment_date(spark, sf):
    pol = policy_days(spark, sf)
    return pol.select("user_id", "t_user", "t_group",
                      treatment_time("t_user", "t_group").alias("t0"))


SQL_T1 = f"SELECT user_id, t_user, t_group, t0 FROM ({SQL_POLICY})"


# ---------------------------------------------------------------------------- T2
def t2_post_indicator(spark, sf):
    p = day_panel(spark, sf)
    return p.select("user_id", "day", post("day", "t0").alias("tre"),
                    post("day", "t0", inclusive=True).alias("tre_incl"))


SQL_T2 = f"""SELECT user_id, day, COALESCE(CAST(day > t0 AS INTEGER), 0) AS tre,
  COALESCE(CAST(day >= t0 AS INTEGER), 0) AS tre_incl FROM ({SQL_DAY_PANEL_T})"""


# ---------------------------------------------------------------------------- T3
def t3_ever_treated(spark, sf):
    p = ever_treated(week_panel(spark, sf), "user_id", "tre")
    return p.select("user_id", "week", "tre", "ever_treated")


SQL_T3 = f"""WITH p AS ({SQL_WEEK_PANEL})
SELECT user_id, week, tre, max(tre) OVER (PARTITION BY user_id) AS ever_treated FROM p"""


# ---------------------------------------------------------------------------- T4
LEADS, LAGS = 5, 5


def t4_event_dummies(spark, sf):
    p = day_panel(spark, sf).withColumn("event_time", event_time("day", "t0"))
    p = event_dummies(p, "day", "t0", LEADS, LAGS)
    dummies = [f"b{k}" for k in range(LEADS, 0, -1)] + [f"a{k}" for k in range(LAGS + 1)]
    return p.select("user_id", "day", "event_time", *dummies)


def _sql_dummies():
    out = []
    for k in range(LEADS, 0, -1):
        out.append(f"COALESCE(CAST(day - t0 = -{k} AS INTEGER), 0) AS b{k}")
    for k in range(LAGS + 1):
        out.append(f"COALESCE(CAST(day - t0 = {k} AS INTEGER), 0) AS a{k}")
    return ", ".join(out)


SQL_T4 = f"""SELECT user_id, day, CAST(day - t0 AS INTEGER) AS event_time, {_sql_dummies()}
FROM ({SQL_DAY_PANEL_T})"""


# ---------------------------------------------------------------------------- T5
def t5_interactions(spark, sf):
    p = week_panel(spark, sf)
    p, names = interact(p, ["tre##high", "tre#value_mean", "tre#high#value_mean"])
    return p.select("user_id", "week", *[qz(n).alias(n) if "value" in n else F.col(n)
                                         for n in names])


SQL_T5 = f"""WITH p AS ({SQL_WEEK_PANEL})
SELECT user_id, week, tre, high, tre * high AS tre_x_high,
  {QZ('tre * value_mean')} AS tre_x_value_mean,
  {QZ('tre * high * value_mean')} AS tre_x_high_x_value_mean FROM p"""


# ---------------------------------------------------------------------------- T6
def t6_group_2x2(spark, sf):
    p = week_panel(spark, sf)
    ever = p.groupBy("user_id").agg(F.max("tre").alias("ever"))
    p = p.join(ever, "user_id").withColumn("group", group_2x2("ever", "high"))
    return p.groupBy("week", "group").agg(qz(F.avg("value_mean")).alias("value_mean"),
                                          F.count(F.lit(1)).alias("n"))


SQL_T6 = f"""WITH p AS ({SQL_WEEK_PANEL}),
 e AS (SELECT user_id, max(tre) AS ever FROM p GROUP BY 1),
 g AS (SELECT p.*, CASE WHEN e.ever = 1 AND p.high = 1 THEN 'treated_high'
                        WHEN e.ever = 1 AND p.high = 0 THEN 'treated_low'
                        WHEN e.ever = 0 AND p.high = 1 THEN 'control_high'
                        WHEN e.ever = 0 AND p.high = 0 THEN 'control_low' END AS "group"
       FROM p JOIN e ON e.user_id = p.user_id)
SELECT week, "group", {QZ('avg(value_mean)')} AS value_mean, count(*) AS n FROM g GROUP BY 1, 2"""


# ---------------------------------------------------------------------------- T7
def t7_estimation_sample(spark, sf):
    # single-event days carry no spread: their mean is set missing, as a
    # source with suppressed small cells would be
    p = day_panel(spark, sf).withColumn(
        "value_mean", F.when(F.col("n_events") > 1, F.col("value_mean")))
    s = estimation_sample(p, ["user_id", "day", "value_mean", "n_events", "tre"])
    return s.agg(F.count(F.lit(1)).alias("n_obs"), F.count_distinct("user_id").alias("n_entities"))


SQL_T7 = f"""SELECT count(*) AS n_obs, count(DISTINCT user_id) AS n_entities
FROM (SELECT * FROM ({SQL_DAY_PANEL_T}) WHERE n_events > 1 AND value_mean IS NOT NULL)"""


QUERIES = {
    "d13_group_trends": d13_group_trends,
    "t1_treatment_date": t1_treatment_date,
    "t2_post_indicator": t2_post_indicator,
    "t3_ever_treated": t3_ever_treated,
    "t4_event_dummies": t4_event_dummies,
    "t5_interactions": t5_interactions,
    "t6_group_2x2": t6_group_2x2,
    "t7_estimation_sample": t7_estimation_sample,
}

SQL = {
    "d13_group_trends": SQL_D13,
    "t1_treatment_date": SQL_T1,
    "t2_post_indicator": SQL_T2,
    "t3_ever_treated": SQL_T3,
    "t4_event_dummies": SQL_T4,
    "t5_interactions": SQL_T5,
    "t6_group_2x2": SQL_T6,
    "t7_estimation_sample": SQL_T7,
}
