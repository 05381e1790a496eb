"""Registered queries: sort / top-k / custom order / append (O1-O3, U1) and
reshape (R1-R5)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from panora.operators.reshape import (append, category_rank, long_to_wide, one_hot,
                                      sort_position, status_matrix, top_k, wide_cast, wide_to_long)
from panora.plans.common import QZ, T, qz
from panora.plans.q_design import SQL_WEEK_PANEL, week_panel

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- O1
@reg("o1_sort", """
SELECT c_custkey, c_acctbal, c_mktsegment,
  row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer""")
def o1_sort(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return sort_position(c, "c_acctbal", desc=True, tiebreak=["c_custkey"])


@reg("o1_sort_two_keys", """
SELECT o_orderkey, o_custkey, o_totalprice,
  row_number() OVER (ORDER BY o_custkey, o_totalprice DESC, o_orderkey) AS position FROM orders""")
def o1_sort_two_keys(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sort_position(o, "o_custkey", tiebreak=[F.col("o_totalprice").desc(), "o_orderkey"])


# ---------------------------------------------------------------------------- O2
@reg("o2_top_k", f"""
SELECT c.c_nationkey, {QZ('sum(o.o_totalprice)')} AS revenue
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY c.c_nationkey ORDER BY revenue DESC, c.c_nationkey LIMIT 10""")
def o2_top_k(spark, sf):
    o, c = T(spark, sf, "orders"), T(spark, sf, "customer")
    r = (o.join(c, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey")
         .agg(qz(F.sum("o_totalprice")).alias("revenue")))
    return top_k(r, 10, "revenue", tiebreak=["c_nationkey"])


# ---------------------------------------------------------------------------- O3
# fixed values: custom order of the priority codes
PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@reg("o3_category_order", """
SELECT CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '3-MEDIUM' THEN 3
         WHEN '2-HIGH' THEN 4 WHEN '1-URGENT' THEN 5 END AS prio_rank, o_orderpriority, count(*) AS n
FROM orders GROUP BY 1, 2""")
def o3_category_order(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy(category_rank("o_orderpriority", PRIORITY_ORDER).alias("prio_rank"),
                     "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- U1
@reg("u1_append", """
SELECT 'customer' AS source, c_nationkey AS nationkey, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2""")
def u1_append(spark, sf):
    c = (T(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nationkey"))
         .agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("customer")))
    s = (T(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey"))
         .agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("supplier")))
    return append(c, s)


# ---------------------------------------------------------------------------- R1
SEX, EDU = ["A", "N", "R"], ["F", "O"]
MEASURES = {"emp": "l_quantity", "earn": "l_extendedprice", "pay": "l_tax"}


def _r1_sql():
    cols = []
    for m, src in MEASURES.items():
        for s, e in product(SEX, EDU):
            expr = f"COALESCE(sum(CASE WHEN l.l_returnflag = '{s}' AND l.l_linestatus = '{e}' THEN l.{src} END), 0)"
            cols.append(f"{QZ(expr)} AS {m}sex{s}edu{e}")
    return f"""SELECT l.l_suppkey AS geography, year(l.l_shipdate) AS yr, quarter(l.l_shipdate) AS qtr,
  {', '.join(cols)} FROM lineitem l GROUP BY 1, 2, 3"""


@reg("r1_wide_cast", _r1_sql())
def r1_wide_cast(spark, sf):
    li = T(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("geography"), F.year("l_shipdate").alias("yr"),
        F.quarter("l_shipdate").alias("qtr"), F.col("l_returnflag").alias("sex"),
        F.col("l_linestatus").alias("edu"), *[F.col(v).alias(k) for k, v in MEASURES.items()])
    w = wide_cast(li, ["geography", "yr", "qtr"], ["sex", "edu"], [SEX, EDU], list(MEASURES))
    return w.select("geography", "yr", "qtr", *[qz(c).alias(c) for c in w.columns
                                                if c not in ("geography", "yr", "qtr")])


# ---------------------------------------------------------------------------- R2 / R3
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

SQL_R2 = """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, """ + ", ".join(
    f"max(n) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in EVENT_TYPES) + \
    " FROM c GROUP BY user_id"


def _r2(spark, sf):
    c = T(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return long_to_wide(c, ["user_id"], "event_type", ["n"], EVENT_TYPES, template="{value}_{level}")


@reg("r2_long_to_wide", SQL_R2)
def r2_long_to_wide(spark, sf):
    return _r2(spark, sf)


@reg("r3_wide_to_long", f"WITH w AS ({SQL_R2}) " + " UNION ALL ".join(
    f"SELECT user_id, 'n_{t}' AS variable, n_{t} AS value FROM w" for t in EVENT_TYPES))
def r3_wide_to_long(spark, sf):
    return wide_to_long(_r2(spark, sf), ["user_id"], [f"n_{t}" for t in EVENT_TYPES])


# ---------------------------------------------------------------------------- R4
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@reg("r4_one_hot", "SELECT o_orderstatus, " + ", ".join(
    f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS prio{i}"
    for i, p in enumerate(PRIORITIES, 1)) + " FROM orders GROUP BY o_orderstatus")
def r4_one_hot(spark, sf):
    o = one_hot(T(spark, sf, "orders"), "o_orderpriority", "prio")
    return o.groupBy("o_orderstatus").agg(*[F.sum(f"prio{i}").alias(f"prio{i}")
                                            for i in range(1, len(PRIORITIES) + 1)])


# ---------------------------------------------------------------------------- R5
def _r5(spark, sf):
    """Week x user status, the columns those of the data."""
    return status_matrix(week_panel(spark, sf), "user_id", "week", "tre", max_times=200)


def _r5_sql():
    return f"PIVOT (SELECT user_id, 't' || week AS w, tre FROM ({SQL_WEEK_PANEL})) ON w USING max(tre) GROUP BY user_id"


Q["r5_status_matrix"], S["r5_status_matrix"] = _r5, _r5_sql()


QUERIES, SQL = Q, S
