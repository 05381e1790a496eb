"""Shared pieces of the registered queries: table loading, the events panel
proxy (entity = user, period = day or 7-day block), and the rounding policy
used on float outputs that are compared with the SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panora.functions.clean import quantize
from panora.functions.dates import week_block


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def qz(col, digits: int = 4) -> Column:
    return quantize(col, digits)


def QZ(expr: str, digits: int = 4) -> str:
    """SQL twin of :func:`qz` (half-up at ``digits`` decimals, -0.0 -> 0.0)."""
    s = f"1e{digits}"
    return f"(CAST(floor(({expr}) * {s} + 0.5) AS DOUBLE) / {s} + 0.0)"


def cents_sum(col) -> Column:
    """Exact sum of a two-decimal money column: summed as integer cents, so the
    result does not depend on summation order (float sums of many values do)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(F.round(c * 100).cast("bigint")).cast("double") / 100.0


def CENTS_SUM(expr: str) -> str:
    return f"(CAST(sum(CAST(round(({expr}) * 100) AS BIGINT)) AS DOUBLE) / 100.0)"


# period keys of the events proxy ------------------------------------------------
def ev_day(ts: str = "ts") -> Column:
    return F.to_date(F.col(ts))


def ev_week(ts: str = "ts") -> Column:
    return week_block(F.to_date(F.col(ts)))


SQL_DAY = "CAST(ts AS DATE)"
SQL_WEEK = "CAST(floor((dayofyear(CAST(ts AS DATE)) - 1) / 7) + 1 AS INTEGER)"
SQL_DAYNUM = "CAST(dayofyear(CAST(ts AS DATE)) AS INTEGER)"


def events_day_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user x day panel: mean value (level), max event id (cumulative counter),
    event count; ``day`` is the day of year (integer period)."""
    ev = T(spark, sf_dir, "events")
    return ev.groupBy("user_id", F.dayofyear(F.to_date("ts")).cast("int").alias("day")).agg(
        F.avg("value").alias("value_mean"), F.max("event_id").alias("last_event"),
        F.count(F.lit(1)).alias("n_events"))


SQL_DAY_PANEL = f"""SELECT user_id, {SQL_DAYNUM} AS day, avg(value) AS value_mean,
  max(event_id) AS last_event, count(*) AS n_events
  FROM events GROUP BY user_id, {SQL_DAYNUM}"""


# policy-date proxies -------------------------------------------------------------
# fixed values: the "policy" definitions of the proxy (an event of this type
# with a value above the threshold), and the number of user groups
POLICY_VALUE = 100.0
GROUP_POLICY_EVENT = "signup"
ENTITY_POLICY_EVENT = "purchase"
N_GROUPS = 5
LARGE_ACCOUNT = 9000.0  # "large account" threshold
KEY_SHIFT = 5           # keys moved by this much leave some unmatched on both sides


def user_group(col: str = "user_id") -> Column:
    return F.pmod(F.col(col), F.lit(N_GROUPS)).cast("int")


def policy_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: own policy day, group policy day, effective day (T1), all as
    day of year; NULL when the policy never happens."""
    ev = T(spark, sf_dir, "events").select(
        "user_id", "event_type", "value", F.dayofyear(F.to_date("ts")).cast("int").alias("day"))
    users = ev.select("user_id").distinct().withColumn("grp", user_group())
    own = (ev.filter((F.col("event_type") == ENTITY_POLICY_EVENT) & (F.col("value") > POLICY_VALUE))
           .groupBy("user_id").agg(F.min("day").alias("t_user")))
    grp = (ev.filter((F.col("event_type") == GROUP_POLICY_EVENT) & (F.col("value") > POLICY_VALUE))
           .groupBy(user_group().alias("grp")).agg(F.min("day").alias("t_group")))
    return (users.join(own, "user_id", "left").join(grp, "grp", "left")
            .withColumn("t0", F.least("t_user", "t_group")))


SQL_POLICY = f"""SELECT u.user_id, u.grp, o.t_user, g.t_group, least(o.t_user, g.t_group) AS t0
  FROM (SELECT DISTINCT user_id, CAST(user_id % {N_GROUPS} AS INTEGER) AS grp FROM events) u
  LEFT JOIN (SELECT user_id, min({SQL_DAYNUM}) AS t_user FROM events
             WHERE event_type = '{ENTITY_POLICY_EVENT}' AND value > {POLICY_VALUE} GROUP BY user_id) o
    ON o.user_id = u.user_id
  LEFT JOIN (SELECT CAST(user_id % {N_GROUPS} AS INTEGER) AS grp, min({SQL_DAYNUM}) AS t_group FROM events
             WHERE event_type = '{GROUP_POLICY_EVENT}' AND value > {POLICY_VALUE} GROUP BY 1) g
    ON g.grp = u.grp"""
