"""Registered queries whose keys, groups or order values are partly NULL: a NULL
is a value of its own, so no row may be lost and no statistic left out."""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.operators import aggregate as A
from panora.operators import design, joins, profile, quantiles, reshape, window
from panora.plans.common import CENTS_SUM, QZ, T, qz

Q, S = {}, {}


def reg(key, sql):
    def deco(fn):
        Q[key], S[key] = fn, sql
        return fn
    return deco


SQL_LINES = "(SELECT *, nullif(l_returnflag, 'R') AS flag FROM lineitem)"
SQL_CUST = "(SELECT *, nullif(c_mktsegment, 'HOUSEHOLD') AS seg, nullif(c_nationkey, 3) AS nk FROM customer)"


def lines(spark, sf):
    return T(spark, sf, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("R")))


def customers(spark, sf):
    return T(spark, sf, "customer").withColumns({"seg": F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")),
                                                 "nk": F.nullif(F.col("c_nationkey"), F.lit(3))})


SQL_MEDIANS = f"""SELECT flag, {QZ('median(l_extendedprice)')} AS price_median, {QZ('avg(l_quantity)')} AS qty_mean
FROM {SQL_LINES} GROUP BY flag"""


def _medians(method):
    def run(spark, sf):
        got = A.aggregate(lines(spark, sf), "flag", [("price_median", "median", "l_extendedprice"),
                                                     ("qty_mean", "mean", "l_quantity")], method=method)
        return got.select("flag", *[qz(c).alias(c) for c in ("price_median", "qty_mean")])
    return run


# both routes of the exact median on the same NULL group
reg("a1_null_group_map", SQL_MEDIANS)(_medians("map"))
reg("a1_null_group_distributed", SQL_MEDIANS)(_medians("distributed"))


@reg("a5_null_group_share", f"""WITH c AS (SELECT seg, nk, count(*) AS n FROM {SQL_CUST} GROUP BY 1, 2)
SELECT seg, nk, n, {QZ('n * 1.0 / sum(n) OVER (PARTITION BY seg)')} AS share FROM c""")
def a5_null_group_share(spark, sf):
    s = A.share_within(customers(spark, sf), ["seg", "nk"], ["seg"])
    return s.select("seg", "nk", "n", qz("share").alias("share"))


@reg("a10_null_area_rollup", f"""SELECT nk, {CENTS_SUM('c_acctbal')} AS bal, max(c_acctbal) AS top, count(*) AS n
FROM {SQL_CUST} GROUP BY nk""")
def a10_null_area_rollup(spark, sf):
    c = customers(spark, sf).withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    r = A.rollup(c, "nk", {"sum": ["cents"], "max": ["c_acctbal"]})
    return r.select("nk", (F.col("cents_sum").cast("double") / 100.0).alias("bal"), F.col("c_acctbal_max").alias("top"), "n")


@reg("a11_null_group_winsorize", f"""WITH m AS (SELECT *, median(c_acctbal) OVER (PARTITION BY seg) AS med FROM {SQL_CUST}),
 d AS (SELECT *, 1.0 * 1.4826 * median(abs(c_acctbal - med)) OVER (PARTITION BY seg) AS half FROM m)
SELECT c_custkey, {QZ('least(greatest(c_acctbal, med - half), med + half)')} AS bal FROM d""")
def a11_null_group_winsorize(spark, sf):
    w = A.winsorize(customers(spark, sf), ["c_acctbal"], ["seg"], c=1.0, method="distributed")
    return w.select("c_custkey", qz("c_acctbal").alias("bal"))


@reg("w1_null_group_stat", f"""SELECT c_custkey, max(c_acctbal) OVER (PARTITION BY seg) AS top,
  {QZ('median(c_acctbal) OVER (PARTITION BY seg)')} AS mid FROM {SQL_CUST}""")
def w1_null_group_stat(spark, sf):
    g = window.group_stat(customers(spark, sf), "seg", {"top": ("max", "c_acctbal"), "mid": ("median", "c_acctbal")},
                          method="distributed")
    return g.select("c_custkey", "top", qz("mid").alias("mid"))


SQL_SERIES = """(SELECT nullif(c_nationkey, 3) AS e, c_custkey AS t, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS v FROM customer)"""


def _series(spark, sf):
    return T(spark, sf, "customer").select(F.nullif(F.col("c_nationkey"), F.lit(3)).alias("e"), F.col("c_custkey").cast("long").alias("t"),
                                           F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("v"))


SQL_LOCF = f"""SELECT e, CAST(t AS BIGINT) AS t, last_value(v IGNORE NULLS) OVER (PARTITION BY e ORDER BY t
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM {SQL_SERIES}"""
reg("w3_null_entity_chunked", SQL_LOCF)(lambda spark, sf: window.locf(_series(spark, sf), "e", "t", ["v"], chunk=64))
reg("w3_null_entity_window", SQL_LOCF)(lambda spark, sf: window.locf(_series(spark, sf), "e", "t", ["v"], chunk=0))


@reg("w7_null_entity_latest", f"""SELECT seg, c_custkey FROM {SQL_CUST}
QUALIFY c_custkey = max(c_custkey) OVER (PARTITION BY seg)""")
def w7_null_entity_latest(spark, sf):
    return window.latest(customers(spark, sf).select("seg", "c_custkey"), "c_custkey", "seg")


@reg("t3_null_entity_ever", f"""SELECT c_custkey, max(CASE WHEN c_acctbal > 9900 THEN 1 ELSE 0 END) OVER (PARTITION BY nk) AS ever_treated
FROM {SQL_CUST}""")
def t3_null_entity_ever(spark, sf):
    c = customers(spark, sf).withColumn("rich", (F.col("c_acctbal") > 9900).cast("int"))
    return design.ever_treated(c, "nk", "rich").select("c_custkey", "ever_treated")


@reg("o1_null_sort_position", """SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END NULLS LAST, c_custkey) AS position
FROM customer""")
def o1_null_sort_position(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("v"))
    return reshape.sort_position(c, "v", tiebreak=["c_custkey"]).select("c_custkey", "position")


@reg("d10_null_group_box", f"""WITH q AS (SELECT seg, count(*) AS n, quantile_cont(c_acctbal, 0.25) AS q1, median(c_acctbal) AS md,
  quantile_cont(c_acctbal, 0.75) AS q3 FROM {SQL_CUST} GROUP BY seg)
SELECT seg, n, {QZ('q1')} AS q1, {QZ('md')} AS median, {QZ('q3')} AS q3 FROM q""")
def d10_null_group_box(spark, sf):
    b = profile.box_stats(customers(spark, sf), "c_acctbal", ["seg"], method="distributed")
    return b.select("seg", "n", *[qz(c).alias(c) for c in ("q1", "median", "q3")])


SQL_NATIONS = "(SELECT nullif(n_nationkey, 3) AS nk, n_name, n_regionkey FROM nation)"


def _nations(spark, sf):
    return T(spark, sf, "nation").select(F.nullif(F.col("n_nationkey"), F.lit(3)).alias("nk"), "n_name", "n_regionkey")


@reg("j6_null_crosswalk", f"SELECT c.c_custkey, x.n_name FROM {SQL_CUST} c LEFT JOIN {SQL_NATIONS} x ON c.nk IS NOT DISTINCT FROM x.nk")
def j6_null_crosswalk(spark, sf):
    return joins.crosswalk(customers(spark, sf), _nations(spark, sf), "nk", "n_name").select("c_custkey", "n_name")


@reg("j8_null_merge_mm", f"""WITH l AS (SELECT nk AS k, c_custkey, row_number() OVER (PARTITION BY nk ORDER BY c_custkey) AS rl FROM {SQL_CUST}),
 r AS (SELECT k, s_suppkey, row_number() OVER (PARTITION BY k ORDER BY o NULLS LAST, s_suppkey) AS rr FROM
   (SELECT nullif(s_nationkey, 3) AS k, s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END AS o FROM supplier)),
 nl AS (SELECT k, count(*) AS nl FROM l GROUP BY k), nr AS (SELECT k, count(*) AS nr FROM r GROUP BY k)
SELECT l.k, c_custkey, s_suppkey FROM l LEFT JOIN nr ON l.k IS NOT DISTINCT FROM nr.k
  LEFT JOIN r ON r.k IS NOT DISTINCT FROM l.k AND r.rr = least(l.rl, nr.nr)
UNION ALL SELECT r.k, c_custkey, s_suppkey FROM r LEFT JOIN nl ON r.k IS NOT DISTINCT FROM nl.k
  LEFT JOIN l ON l.k IS NOT DISTINCT FROM r.k AND l.rl = nl.nl WHERE r.rr > coalesce(nl.nl, 0)""")
def j8_null_merge_mm(spark, sf):
    left = customers(spark, sf).select(F.col("nk").alias("k"), "c_custkey")
    right = T(spark, sf, "supplier").select(F.nullif(F.col("s_nationkey"), F.lit(3)).alias("k"), "s_suppkey",
                                            F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal")).alias("o"))
    return joins.merge_mm(left, right, "k", ["c_custkey"], ["o"]).select("k", "c_custkey", "s_suppkey")


@reg("j11_null_membership", f"""SELECT c_custkey, CASE WHEN nk IS NULL OR nk IN (SELECT nk FROM {SQL_NATIONS} WHERE n_regionkey < 2 AND nk IS NOT NULL)
  THEN 1 ELSE 0 END AS member FROM {SQL_CUST}""")
def j11_null_membership(spark, sf):
    some = _nations(spark, sf).filter("n_regionkey < 2 OR nk IS NULL")
    return joins.membership_flag(customers(spark, sf), some, "nk").select("c_custkey", "member")


@reg("j12_null_coverage", f"""SELECT DISTINCT nk, CAST(coalesce(nk IN (SELECT nk FROM {SQL_CUST} WHERE nk IS NOT NULL), true) AS INTEGER) AS in_c,
  CAST(coalesce(nk IN (SELECT s_nationkey FROM supplier WHERE s_nationkey <> 3), false) AS INTEGER) AS in_s FROM {SQL_NATIONS}""")
def j12_null_coverage(spark, sf):
    s = T(spark, sf, "supplier").filter("s_nationkey <> 3").select(F.col("s_nationkey").alias("nk"))
    got = joins.coverage_flags(_nations(spark, sf).select("nk"), {"c": customers(spark, sf).select("nk"), "s": s}, "nk")
    return got.select("nk", F.col("in_c").cast("int").alias("in_c"), F.col("in_s").cast("int").alias("in_s"))


@reg("j1_align_repeated_keys", f"""SELECT coalesce(a.nk, b.nk) AS nk, a.c_custkey, b.s_suppkey FROM (SELECT nk, c_custkey FROM {SQL_CUST}) a
FULL JOIN (SELECT nullif(s_nationkey, 3) AS nk, s_suppkey FROM supplier) b ON a.nk IS NOT DISTINCT FROM b.nk""")
def j1_align_repeated_keys(spark, sf):
    s = T(spark, sf, "supplier").select(F.nullif(F.col("s_nationkey"), F.lit(3)).alias("nk"), "s_suppkey")
    return joins.align(customers(spark, sf).select("nk", "c_custkey"), s, keys=["nk"])


@reg("w5_null_values_cut", f"""SELECT {QZ('median(v)')} AS m FROM {SQL_SERIES}""")
def w5_null_values_cut(spark, sf):
    return quantiles.median_table(_series(spark, sf), "v", (), "m", "distributed").select(qz("m").alias("m"))


QUERIES, SQL = Q, S
