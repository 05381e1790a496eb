"""Registered queries: joins and merges.

NULL keys are produced inside both the query and its SQL twin (``nullif``)
so the null-safe matching rules (M6) are exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.operators.joins import (align, coverage_flags, crosswalk, fill_balanced, join, link,
                                    lookup, membership_flag, merge_m1, merge_mm, neighbor_sum,
                                    restrict)
from panora.plans.common import (CENTS_SUM, KEY_SHIFT, LARGE_ACCOUNT, QZ, SQL_DAYNUM, SQL_WEEK, T, cents_sum,
                                 ev_week, qz)

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- J1 / J2
UNKNOWN_WEEK = 5  # fixed value: the week whose key is set missing in the proxy


def _type_means(spark, sf, etype, name):
    ev = T(spark, sf, "events").filter(F.col("event_type") == etype)
    return ev.groupBy("user_id", F.nullif(ev_week(), F.lit(UNKNOWN_WEEK)).alias("week")).agg(
        F.avg("value").alias(name))


def _sql_type_means(etype, name):
    return (f"SELECT user_id, nullif({SQL_WEEK}, {UNKNOWN_WEEK}) AS week, avg(value) AS {name} "
            f"FROM events WHERE event_type = '{etype}' GROUP BY 1, 2")


SQL_J1 = f"""WITH v AS ({_sql_type_means('view', 'view_mean')}),
 c AS ({_sql_type_means('click', 'click_mean')}),
 p AS ({_sql_type_means('purchase', 'purchase_mean')}),
 vc AS (SELECT COALESCE(v.user_id, c.user_id) AS user_id, COALESCE(v.week, c.week) AS week,
               v.view_mean, c.click_mean
        FROM v FULL JOIN c ON v.user_id IS NOT DISTINCT FROM c.user_id
                          AND v.week IS NOT DISTINCT FROM c.week)
SELECT COALESCE(vc.user_id, p.user_id) AS user_id, COALESCE(vc.week, p.week) AS week,
  {QZ('vc.view_mean')} AS view_mean, {QZ('vc.click_mean')} AS click_mean,
  {QZ('p.purchase_mean')} AS purchase_mean
FROM vc FULL JOIN p ON vc.user_id IS NOT DISTINCT FROM p.user_id AND vc.week IS NOT DISTINCT FROM p.week"""


@reg("j1_align_full_outer", SQL_J1)
def j1_align_full_outer(spark, sf):
    frames = [_type_means(spark, sf, t, f"{t}_mean") for t in ("view", "click", "purchase")]
    a = align(*frames, keys=["user_id", "week"], check=True)
    return a.select("user_id", "week", *[qz(f"{t}_mean").alias(f"{t}_mean")
                                         for t in ("view", "click", "purchase")])


@reg("j2_full_join_renamed_keys", f"""WITH v AS ({_sql_type_means('view', 'view_mean')}),
 c AS ({_sql_type_means('click', 'click_mean')})
SELECT COALESCE(v.user_id, c.user_id) AS user_id, COALESCE(v.week, c.week) AS week,
  {QZ('v.view_mean')} AS view_mean, {QZ('c.click_mean')} AS click_mean
FROM v FULL JOIN c ON v.user_id IS NOT DISTINCT FROM c.user_id AND v.week IS NOT DISTINCT FROM c.week""")
def j2_full_join_renamed_keys(spark, sf):
    v = _type_means(spark, sf, "view", "view_mean")
    c = _type_means(spark, sf, "click", "click_mean").withColumnsRenamed({"user_id": "uid", "week": "wk"})
    j = join(v, c, ["user_id", "week"], "full", right_on=["uid", "wk"])
    return j.select("user_id", "week", qz("view_mean").alias("view_mean"),
                    qz("click_mean").alias("click_mean"))


# ---------------------------------------------------------------------------- J3
@reg("j3_lookup_left", f"""
SELECT p.p_type, count(*) AS n, {QZ('sum(l.l_quantity)')} AS qty
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_type""")
def j3_lookup_left(spark, sf):
    li = T(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    j = lookup(li, T(spark, sf, "part"), "l_partkey", right_on="p_partkey", cols=["p_type"])
    return j.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), qz(F.sum("l_quantity")).alias("qty"))


# ---------------------------------------------------------------------------- J4
@reg("j4_right_join", f"""
WITH c AS (SELECT c_nationkey + {KEY_SHIFT} AS c_nationkey, count(*) AS n_cust FROM customer GROUP BY 1)
SELECT n.n_nationkey AS c_nationkey, n.n_name, c.n_cust
FROM c RIGHT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def j4_right_join(spark, sf):
    c = (T(spark, sf, "customer").groupBy((F.col("c_nationkey") + KEY_SHIFT).alias("c_nationkey"))
         .agg(F.count(F.lit(1)).alias("n_cust")))
    n = T(spark, sf, "nation").select("n_nationkey", "n_name")
    return join(c, n, "c_nationkey", "right", right_on="n_nationkey")


# ---------------------------------------------------------------------------- J5
@reg("j5_inner_join_two_keys", f"""
WITH a AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
 b AS (SELECT l_suppkey AS s, l_partkey + 1 AS p, sum(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2)
SELECT a.l_suppkey, a.l_partkey, {QZ('a.qty')} AS qty, {QZ('b.price')} AS price
FROM a JOIN b ON a.l_suppkey = b.s AND a.l_partkey = b.p""")
def j5_inner_join_two_keys(spark, sf):
    li = T(spark, sf, "lineitem")
    a = li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    b = (li.groupBy(F.col("l_suppkey").alias("s"), (F.col("l_partkey") + 1).alias("p"))
         .agg(F.sum("l_extendedprice").alias("price")))
    j = join(a, b, ["l_suppkey", "l_partkey"], "inner", right_on=["s", "p"], null_keys="drop")
    return j.select("l_suppkey", "l_partkey", qz("qty").alias("qty"), qz("price").alias("price"))


# ---------------------------------------------------------------------------- J6 / J6b
def part_supplier_xw(spark, sf):
    """part -> supplier crosswalk with the supplier's share of the part's quantity."""
    li = T(spark, sf, "lineitem")
    cell = li.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    tot = cell.groupBy("l_partkey").agg(F.sum("q").alias("qt"))
    return cell.join(tot, "l_partkey").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("suppkey"),
        (F.col("q") / F.col("qt")).alias("ratio"))


SQL_XW = """SELECT l_partkey AS p_partkey, l_suppkey AS suppkey,
  sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_partkey) AS ratio
  FROM lineitem GROUP BY l_partkey, l_suppkey"""


@reg("j6_crosswalk_expand", f"""
SELECT x.suppkey, count(*) AS n_parts, {QZ('sum(p.p_retailprice)')} AS price_sum
FROM part p LEFT JOIN ({SQL_XW}) x ON x.p_partkey = p.p_partkey GROUP BY x.suppkey""")
def j6_crosswalk_expand(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_retailprice")
    e = crosswalk(p, part_supplier_xw(spark, sf), "p_partkey", "suppkey", "ratio", mode="expand")
    return e.groupBy("suppkey").agg(F.count(F.lit(1)).alias("n_parts"),
                                    qz(F.sum("p_retailprice")).alias("price_sum"))


def part_flag_xw(spark, sf):
    """part -> return-flag crosswalk with the flag's share of the part's quantity
    (a many-to-many map in which some shares are a majority)."""
    li = T(spark, sf, "lineitem")
    cell = li.groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    tot = cell.groupBy("l_partkey").agg(F.sum("q").alias("qt"))
    return cell.join(tot, "l_partkey").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("flag"),
        (F.col("q") / F.col("qt")).alias("ratio"))


SQL_FLAG_XW = """SELECT l_partkey AS p_partkey, l_returnflag AS flag,
  sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_partkey) AS ratio
  FROM lineitem GROUP BY l_partkey, l_returnflag"""


@reg("j6b_crosswalk_majority", f"""
SELECT x.flag, count(*) AS n_parts, {QZ('sum(p.p_retailprice)')} AS price_sum
FROM part p LEFT JOIN (SELECT * FROM ({SQL_FLAG_XW}) WHERE ratio > 0.5) x ON x.p_partkey = p.p_partkey
GROUP BY x.flag""")
def j6b_crosswalk_majority(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_retailprice")
    e = crosswalk(p, part_flag_xw(spark, sf), "p_partkey", "flag", "ratio", mode="majority")
    return e.groupBy("flag").agg(F.count(F.lit(1)).alias("n_parts"),
                                 qz(F.sum("p_retailprice")).alias("price_sum"))


@reg("j6b_crosswalk_allocate", f"""
SELECT x.flag, {QZ('sum(p.p_retailprice * x.ratio)')} AS price_alloc
FROM part p JOIN ({SQL_FLAG_XW}) x ON x.p_partkey = p.p_partkey GROUP BY x.flag""")
def j6b_crosswalk_allocate(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_retailprice")
    e = crosswalk(p, part_flag_xw(spark, sf), "p_partkey", "flag", "ratio", mode="allocate",
                  allocate=["p_retailprice"])
    return e.filter(F.col("flag").isNotNull()).groupBy("flag").agg(
        qz(F.sum("p_retailprice")).alias("price_alloc"))


# ---------------------------------------------------------------------------- J7
UNKNOWN_NATION = 24        # fixed value: nation whose key is set missing on both sides


@reg("j7_merge_m1_status", f"""
WITH m AS (SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_nationkey END AS nationkey,
                  c_custkey, 1 AS in_m FROM customer),
 u AS (SELECT nullif(n_nationkey, {UNKNOWN_NATION}) + {KEY_SHIFT} AS nationkey, n_name, 2 AS in_u FROM nation)
SELECT COALESCE(m.nationkey, u.nationkey) AS nationkey, m.c_custkey, u.n_name,
       CAST(COALESCE(m.in_m, 0) + COALESCE(u.in_u, 0) AS INTEGER) AS _merge
FROM m FULL JOIN u ON m.nationkey IS NOT DISTINCT FROM u.nationkey""")
def j7_merge_m1_status(spark, sf):
    m = (T(spark, sf, "customer")
         .select(F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey")).alias("nationkey"),
                 "c_custkey"))
    u = T(spark, sf, "nation").select(
        (F.nullif(F.col("n_nationkey"), F.lit(UNKNOWN_NATION)) + KEY_SHIFT).alias("nationkey"), "n_name")
    return merge_m1(m, u, "nationkey")


# ---------------------------------------------------------------------------- J8
@reg("j8_merge_mm", """
WITH l AS (SELECT c_nationkey AS k, c_custkey,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rl FROM customer),
 r AS (SELECT s_nationkey AS k, s_suppkey,
              row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rr FROM supplier),
 nl AS (SELECT k, count(*) AS nl FROM l GROUP BY k),
 nr AS (SELECT k, count(*) AS nr FROM r GROUP BY k)
SELECT l.k AS nationkey, l.c_custkey, r.s_suppkey
FROM l LEFT JOIN nr ON nr.k = l.k LEFT JOIN r ON r.k = l.k AND r.rr = least(l.rl, nr.nr)
UNION ALL
SELECT r.k AS nationkey, l.c_custkey, r.s_suppkey
FROM r LEFT JOIN nl ON nl.k = r.k LEFT JOIN l ON l.k = r.k AND l.rl = nl.nl
WHERE r.rr > COALESCE(nl.nl, 0)""")
def j8_merge_mm(spark, sf):
    left = T(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), "c_custkey")
    right = T(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey")
    return merge_mm(left, right, "nationkey", ["c_custkey"], ["s_suppkey"])


# ---------------------------------------------------------------------------- J9 / J10
def nation_ring(spark, sf):
    """Adjacency list: each nation borders the previous and next nation key."""
    n = T(spark, sf, "nation")
    size = n.select(F.count(F.lit(1))).scalar()
    k = F.col("n_nationkey")
    ring = F.array(F.pmod(k + 1, size).cast("int"), F.pmod(k - 1 + size, size).cast("int"))
    return n.select(k.alias("entity"), F.explode(ring).alias("neighbor"))


SQL_RING = """SELECT n_nationkey AS entity, CAST(nb AS INTEGER) AS neighbor FROM nation,
  unnest([(n_nationkey + 1) % (SELECT count(*) FROM nation),
          (n_nationkey - 1 + (SELECT count(*) FROM nation)) % (SELECT count(*) FROM nation)]) t(nb)"""


@reg("j9_joinby_pairs", f"""
WITH p AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT e.entity, e.neighbor, p.c_mktsegment, p.n FROM ({SQL_RING}) e JOIN p ON p.c_nationkey = e.neighbor""")
def j9_joinby_pairs(spark, sf):
    p = T(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    e = nation_ring(spark, sf)
    return join(e, p, "neighbor", "inner", right_on="c_nationkey", null_keys="drop")


@reg("j10_neighbor_sum", f"""
WITH p AS (SELECT c.c_nationkey AS nation, year(o.o_orderdate) AS yr, sum(o.o_totalprice) AS total
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)
SELECT e.entity AS nation, p.yr, {QZ('sum(p.total)')} AS nbr_sum_total
FROM ({SQL_RING}) e JOIN p ON p.nation = e.neighbor GROUP BY e.entity, p.yr""")
def j10_neighbor_sum(spark, sf):
    o, c = T(spark, sf, "orders"), T(spark, sf, "customer")
    p = (o.join(c, F.col("c_custkey") == F.col("o_custkey"))
         .groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").alias("yr"))
         .agg(F.sum("o_totalprice").alias("total")))
    out = neighbor_sum(p, nation_ring(spark, sf), "nation", "yr", "total")
    return out.select("nation", "yr", qz("nbr_sum_total").alias("nbr_sum_total"))


# ---------------------------------------------------------------------------- J11
@reg("j11_membership_flag", """
SELECT c_mktsegment, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
                          THEN 1 ELSE 0 END AS member, count(*) AS n
FROM customer GROUP BY 1, 2""")
def j11_membership_flag(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    members = (T(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
               .select(F.col("o_custkey").alias("c_custkey")))
    f = membership_flag(c, members, "c_custkey")
    return f.groupBy("c_mktsegment", "member").agg(F.count(F.lit(1)).alias("n"))


@reg("j11_restrict_semi_anti", """
SELECT 'kept' AS part, count(*) AS n FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'dropped', count(*) FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def j11_restrict_semi_anti(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey")
    members = (T(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
               .select(F.col("o_custkey").alias("c_custkey")))
    kept = restrict(c, members, "c_custkey").select(F.lit("kept").alias("part"))
    dropped = restrict(c, members, "c_custkey", keep=False).select(F.lit("dropped").alias("part"))
    return kept.unionByName(dropped).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- J12
@reg("j12_coverage_flags", f"""
SELECT n_nationkey,
  CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)
       THEN 1 ELSE 0 END AS in_orders,
  CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 1 ELSE 0 END AS in_suppliers,
  CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > {LARGE_ACCOUNT})
       THEN 1 ELSE 0 END AS in_large
FROM nation""")
def j12_coverage_flags(spark, sf):
    c, o = T(spark, sf, "customer"), T(spark, sf, "orders")
    srcs = {
        "orders": c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
                   .select(F.col("c_nationkey").alias("n_nationkey")),
        "suppliers": T(spark, sf, "supplier").select(F.col("s_nationkey").alias("n_nationkey")),
        "large": c.filter(F.col("c_acctbal") > LARGE_ACCOUNT).select(F.col("c_nationkey").alias("n_nationkey")),
    }
    out = coverage_flags(T(spark, sf, "nation").select("n_nationkey"), srcs, "n_nationkey")
    return out.select("n_nationkey", *[F.col(f"in_{k}").cast("int").alias(f"in_{k}") for k in srcs])


# ---------------------------------------------------------------------------- J13
@reg("j13_balance_grid", f"""
WITH p AS (SELECT user_id, {SQL_DAYNUM} AS day, count(*) AS n_events FROM events GROUP BY 1, 2),
 d AS (SELECT CAST(unnest(range(min(day), max(day) + 1)) AS INTEGER) AS day FROM p),
 g AS (SELECT u.user_id, d.day FROM (SELECT DISTINCT user_id FROM p) u CROSS JOIN d)
SELECT g.user_id, g.day, COALESCE(p.n_events, 0) AS n_events
FROM g LEFT JOIN p ON p.user_id = g.user_id AND p.day = g.day""")
def j13_balance_grid(spark, sf):
    ev = T(spark, sf, "events")
    p = ev.groupBy("user_id", F.dayofyear(F.to_date("ts")).cast("int").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"))
    return fill_balanced(p, "user_id", "day", {"n_events": 0}).select("user_id", "day", "n_events")


# ---------------------------------------------------------------------------- J14
@reg("j14_link_frames", f"""
SELECT o.o_orderpriority, l.l_returnflag, count(*) AS n, {CENTS_SUM('l.l_extendedprice')} AS price
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2""")
def j14_link_frames(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    o = T(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    j = link(li, o, "l_orderkey", ["o_orderpriority"])
    return j.groupBy("o_orderpriority", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), cents_sum("l_extendedprice").alias("price"))


QUERIES, SQL = Q, S
