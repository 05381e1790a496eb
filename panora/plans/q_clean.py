"""Registered queries: cleaning and scalar functions.

Proxies (see FIXTURES.md part B): dirty numbers, codes and labels are made
from customer / orders / lineitem columns inside both the query and its SQL
twin, so the missing-value rules are really exercised.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.functions.clean import (add_affix, blank_flag, case_when, coerce_numeric,
                                    complete_cases, first_per_key, literal_table, log1p, map_codes,
                                    normalize_key, null_flag, percent, recode, relocate, rename,
                                    rename_regex, safe_div, safe_ln, select_like, split_parts,
                                    strip_leading_zeros, strip_pattern)
from panora.functions.dates import date_from_parts, week_block, year_month
from panora.functions.labels import label_columns
from panora.plans.common import CENTS_SUM, QZ, T, cents_sum, qz

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- C1
def _dirty_balance():
    bal = F.col("c_acctbal").cast("string")
    return case_when([(F.col("c_acctbal") < 0, F.lit("NA")),
                      (F.col("c_mktsegment") == "BUILDING", F.concat(F.lit(" "), bal)),
                      (F.col("c_mktsegment") == "MACHINERY", F.lit("."))],
                     F.concat(F.lit("$"), bal))


SQL_DIRTY = """CASE WHEN c_acctbal < 0 THEN 'NA'
  WHEN c_mktsegment = 'BUILDING' THEN ' ' || CAST(c_acctbal AS VARCHAR)
  WHEN c_mktsegment = 'MACHINERY' THEN '.'
  ELSE '$' || CAST(c_acctbal AS VARCHAR) END"""


@reg("c1_coerce_numeric", f"""
WITH d AS (SELECT c_mktsegment, TRY_CAST(trim(replace({SQL_DIRTY}, '$', '')) AS DOUBLE) AS bal
           FROM customer)
SELECT c_mktsegment, count(*) AS n, count(bal) AS n_valid, {QZ('sum(bal)')} AS bal_sum
FROM d GROUP BY c_mktsegment""")
def c1_coerce_numeric(spark, sf):
    c = T(spark, sf, "customer").select("c_mktsegment", _dirty_balance().alias("bal"))
    c = coerce_numeric(c, ["bal"], ignore=("$",))
    return c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count("bal").alias("n_valid"),
                                         qz(F.sum("bal")).alias("bal_sum"))


# ---------------------------------------------------------------------------- C2
@reg("c2_recode", """
SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS finished,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Yes' ELSE '' END AS urgent,
       count(*) AS n
FROM orders GROUP BY 1, 2""")
def c2_recode(spark, sf):
    o = T(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("finished"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Yes").otherwise("").alias("urgent"))
    o = recode(o, ["finished"], {"F": 1, "O": 0})
    return o.groupBy("finished", "urgent").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C3
@reg("c3_strip_pattern", """
WITH d AS (SELECT c_nationkey AS nationkey, c_custkey AS custkey,
  TRY_CAST(ltrim(regexp_replace(c_name, '^Customer#', ''), '0') AS BIGINT) AS name_id FROM customer)
SELECT nationkey, count(*) AS n, min(name_id) AS name_id_min, max(name_id) AS name_id_max,
  count(*) FILTER (WHERE name_id = custkey) AS n_match
FROM d GROUP BY nationkey""")
def c3_strip_pattern(spark, sf):
    c = rename_regex(T(spark, sf, "customer"), "^c_", "")
    c = c.withColumn("name_id", strip_leading_zeros(strip_pattern("name", "^Customer#")).try_cast("bigint"))
    return c.groupBy("nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("name_id").alias("name_id_min"),
        F.max("name_id").alias("name_id_max"),
        F.count_if(F.col("name_id") == F.col("custkey")).alias("n_match"))


# ---------------------------------------------------------------------------- C4
@reg("c4_normalize_key", """
WITH d AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '-' || substr(o_orderpriority, 1, 1)
                  || '000' AS zip4 FROM orders)
SELECT TRY_CAST(substr(trim(zip4), 1, 9) AS BIGINT) AS cust, count(*) AS n FROM d GROUP BY 1""")
def c4_normalize_key(spark, sf):
    o = T(spark, sf, "orders").select(F.concat(
        F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("-"),
        F.substring("o_orderpriority", 1, 1), F.lit("000")).alias("zip4"))
    return o.groupBy(normalize_key("zip4", 9, "bigint").alias("cust")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C5
@reg("c5_split_parts", """
WITH d AS (SELECT string_split_regex(o_orderpriority, '[^A-Za-z0-9]+') AS p FROM orders)
SELECT TRY_CAST(p[1] AS INTEGER) AS prio_num, p[2] AS prio_name, count(*) AS n FROM d GROUP BY 1, 2""")
def c5_split_parts(spark, sf):
    o = split_parts(T(spark, sf, "orders").select("o_orderpriority"), "o_orderpriority",
                    ["prio_num", "prio_name"])
    o = o.withColumn("prio_num", F.col("prio_num").try_cast("int"))
    return o.groupBy("prio_num", "prio_name").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C6
# fixed values: the code -> label map of the proxy
PRIORITY_LABELS = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


@reg("c6_map_codes", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
         WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'low' ELSE 'unknown' END AS priority,
       CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'mid'
            ELSE 'large' END AS band,
       count(*) AS n
FROM orders GROUP BY 1, 2""")
def c6_map_codes(spark, sf):
    o = T(spark, sf, "orders")
    band = case_when([(F.col("o_totalprice") < 50000, "small"),
                      (F.col("o_totalprice") < 200000, "mid")], "large")
    return o.groupBy(map_codes("o_orderpriority", PRIORITY_LABELS, "unknown").alias("priority"),
                     band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C7
@reg("c7_select_columns", f"""
SELECT {CENTS_SUM('l_quantity')} AS l_quantity, {CENTS_SUM('l_extendedprice')} AS l_extendedprice,
       {CENTS_SUM('l_discount')} AS l_discount, {CENTS_SUM('l_tax')} AS l_tax, count(*) AS n_rows
FROM lineitem""")
def c7_select_columns(spark, sf):
    li = T(spark, sf, "lineitem")
    sel = select_like(li, between=("l_quantity", "l_tax"))
    assert select_like(li, contains="price").columns == ["l_extendedprice"]
    return sel.agg(*[cents_sum(c).alias(c) for c in sel.columns], F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------- C8
@reg("c8_rename", f"""
SELECT c_nationkey AS nationkey, {QZ('avg(c_acctbal)')} AS c_acctbal_mean,
       count(*) AS n_customers FROM customer GROUP BY c_nationkey""")
def c8_rename(spark, sf):
    g = T(spark, sf, "customer").groupBy("c_nationkey").agg(
        qz(F.avg("c_acctbal")).alias("c_acctbal"), F.count(F.lit(1)).alias("n"))
    g = add_affix(g, ["c_acctbal"], suffix="_mean")
    return rename(g, {"c_nationkey": "nationkey", "n": "n_customers"})


# ---------------------------------------------------------------------------- C9
@reg("c9_relocate", "SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer")
def c9_relocate(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    c = relocate(c, ["c_nationkey"], after="c_custkey")
    assert c.columns == ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return relocate(c, ["c_acctbal"], before=None, after="c_mktsegment")


# ---------------------------------------------------------------------------- C10
@reg("c10_filter_rows", f"""
SELECT l_returnflag, count(*) AS n, {QZ('sum(l_quantity)')} AS qty
FROM lineitem
WHERE ((l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R'))
       OR (l_discount > 0.08 AND l_linestatus = 'O') OR l_returnflag > 'M')
  AND nullif(l_tax, 0) IS NOT NULL
GROUP BY l_returnflag""")
def c10_filter_rows(spark, sf):
    li = T(spark, sf, "lineitem")
    q, rf = F.col("l_quantity"), F.col("l_returnflag")
    cond = (((q >= 10) & (q <= 20) & rf.isin("A", "R"))
            | ((F.col("l_discount") > 0.08) & (F.col("l_linestatus") == "O")) | (rf > "M"))
    cond = cond & F.nullif(F.col("l_tax"), F.lit(0.0)).isNotNull()
    return li.filter(cond).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), qz(F.sum("l_quantity")).alias("qty"))


# ---------------------------------------------------------------------------- C11
@reg("c11_complete_cases", """
SELECT c_nationkey, count(*) AS n FROM (
  SELECT c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acct,
         nullif(c_mktsegment, 'HOUSEHOLD') AS seg FROM customer)
WHERE acct IS NOT NULL AND seg IS NOT NULL GROUP BY c_nationkey""")
def c11_complete_cases(spark, sf):
    c = T(spark, sf, "customer").select(
        "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acct"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("seg"))
    return complete_cases(c, ["acct", "seg"]).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C12
@reg("c12_first_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def c12_first_per_key(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@reg("c12_distinct_rows", """
SELECT o_orderstatus, count(*) AS n_pairs FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
GROUP BY o_orderstatus""")
def c12_distinct_rows(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_pairs"))


# ---------------------------------------------------------------------------- C13
@reg("c13_date_from_parts", """
WITH d AS (SELECT month(l_shipdate) AS ship_month,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE month(l_shipdate) END AS m,
  year(l_shipdate) AS y, day(l_shipdate) + 2 AS dd FROM lineitem)
SELECT ship_month, count(*) AS n,
  count(CASE WHEN m IS NULL THEN NULL ELSE TRY_CAST(printf('%04d-%02d-%02d', y, m, dd) AS DATE) END)
    AS n_valid,
  min(CASE WHEN m IS NULL THEN NULL ELSE TRY_CAST(printf('%04d-%02d-%02d', y, m, dd) AS DATE) END)
    AS first_date
FROM d GROUP BY ship_month""")
def c13_date_from_parts(spark, sf):
    li = T(spark, sf, "lineitem").select(
        F.month("l_shipdate").alias("ship_month"),
        F.when(F.col("l_returnflag") != "N", F.month("l_shipdate")).alias("m"),
        F.year("l_shipdate").alias("y"), (F.dayofmonth("l_shipdate") + 2).alias("dd"))
    li = li.withColumn("d", date_from_parts("y", "m", "dd"))
    return li.groupBy("ship_month").agg(F.count(F.lit(1)).alias("n"), F.count("d").alias("n_valid"),
                                        F.min("d").alias("first_date"))


# ---------------------------------------------------------------------------- C14
@reg("c14_week_block", """
SELECT CAST(floor((dayofyear(CAST(l_shipdate AS DATE)) - 1) / 7) + 1 AS INTEGER) AS week,
       count(*) AS n FROM lineitem GROUP BY 1""")
def c14_week_block(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.groupBy(week_block(F.to_date("l_shipdate")).alias("week")).agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C15
@reg("c15_year_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1""")
def c15_year_month(spark, sf):
    o = T(spark, sf, "orders")
    return o.groupBy(year_month("o_orderdate").alias("ym")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C16
@reg("c16_math", f"""
SELECT l_returnflag,
  {QZ('avg(ln(l_extendedprice + 1))')} AS ln_price1,
  {QZ('avg(CASE WHEN l_quantity > 0 THEN ln(l_quantity) END)')} AS ln_qty,
  {QZ('avg(l_tax / nullif(l_discount, 0))')} AS tax_per_discount,
  {QZ('100.0 * sum(l_tax) / nullif(sum(l_extendedprice), 0)', 6)} AS tax_pct,
  {QZ('sum(l_extendedprice) / 1000.0')} AS price_k
FROM lineitem GROUP BY l_returnflag""")
def c16_math(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        qz(F.avg(log1p("l_extendedprice"))).alias("ln_price1"),
        qz(F.avg(safe_ln("l_quantity"))).alias("ln_qty"),
        qz(F.avg(safe_div("l_tax", "l_discount"))).alias("tax_per_discount"),
        qz(percent(F.sum("l_tax"), F.sum("l_extendedprice")), 6).alias("tax_pct"),
        qz(F.sum("l_extendedprice") / 1000.0).alias("price_k"))


# ---------------------------------------------------------------------------- C17
@reg("c17_lower_key", """
WITH c AS (SELECT lower(n.n_name) AS nkey, count(*) AS n_customers
           FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1),
 d AS (SELECT lower(n_name) AS nkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey)
SELECT c.nkey, d.r_name, c.n_customers FROM c LEFT JOIN d ON d.nkey = c.nkey""")
def c17_lower_key(spark, sf):
    from panora.operators.joins import lookup
    nation, region = T(spark, sf, "nation"), T(spark, sf, "region")
    c = (T(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .groupBy(F.lower("n_name").alias("nkey")).agg(F.count(F.lit(1)).alias("n_customers")))
    dim = nation.join(region, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.lower("n_name").alias("nkey"), "r_name")
    return lookup(c, dim, "nkey").select("nkey", "r_name", "n_customers")


# ---------------------------------------------------------------------------- C18
@reg("c18_blank_flag", """
WITH d AS (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN ''
                       WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS seg,
                  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer)
SELECT CASE WHEN trim(seg) IS NULL OR trim(seg) = '' THEN 0 ELSE 1 END AS has_seg,
       CASE WHEN bal IS NULL THEN 0 ELSE 1 END AS has_bal, count(*) AS n
FROM d GROUP BY 1, 2""")
def c18_blank_flag(spark, sf):
    c = T(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(""))
         .when(F.col("c_mktsegment") == "MACHINERY", F.lit(None)).otherwise(F.col("c_mktsegment"))
         .alias("seg"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return c.groupBy(blank_flag("seg").alias("has_seg"), null_flag("bal").alias("has_bal")).agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------- C19
# fixed values: a region dimension written out as literals, plus appended rows
REGION_ROWS = [(0, "AFRICA"), (1, "AMERICA"), (2, "ASIA"), (3, "EUROPE"), (4, "MIDDLE EAST")]
EXTRA_REGION_ROWS = [(90, "ARCTIC"), (91, "ANTARCTIC")]


@reg("c19_literal_table", """
WITH dim AS (SELECT * FROM (VALUES (0, 'AFRICA'), (1, 'AMERICA'), (2, 'ASIA'), (3, 'EUROPE'),
                                   (4, 'MIDDLE EAST'), (90, 'ARCTIC'), (91, 'ANTARCTIC')) t(rkey, rname)),
 c AS (SELECT n.n_regionkey AS rkey, count(*) AS n FROM customer c
       JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1)
SELECT dim.rkey, dim.rname, COALESCE(c.n, 0) AS n_customers FROM dim LEFT JOIN c ON c.rkey = dim.rkey""")
def c19_literal_table(spark, sf):
    dim = literal_table(spark, REGION_ROWS, "rkey int, rname string", EXTRA_REGION_ROWS)
    c = (T(spark, sf, "customer").join(T(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
         .groupBy(F.col("n_regionkey").alias("rkey")).agg(F.count(F.lit(1)).alias("n")))
    return dim.join(c, "rkey", "left").select(
        "rkey", "rname", F.coalesce(F.col("n"), F.lit(0)).alias("n_customers"))


# ---------------------------------------------------------------------------- C20
# fixed values: labels of the proxy columns
CUSTOMER_LABELS = {"c_custkey": "Customer key", "c_acctbal": "Account balance (USD)",
                   "c_mktsegment": "Market segment", "c_nationkey": "Nation key"}


@reg("c20_label_columns", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, "
     + ", ".join(f"'{label}' AS label_{c}" for c, label in CUSTOMER_LABELS.items())
     + ", 'negative = overdrawn' AS note_c_acctbal FROM customer")
def c20_label_columns(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    c = label_columns(c, CUSTOMER_LABELS, notes={"c_acctbal": ["negative = overdrawn"]})
    # the labels as they are read back from the schema
    meta = {f.name: f.metadata for f in c.select("*").schema.fields}
    return c.withColumns({f"label_{k}": F.lit(meta[k].get("comment")) for k in CUSTOMER_LABELS}
                         | {"note_c_acctbal": F.lit(meta["c_acctbal"]["notes"][0])})


QUERIES, SQL = Q, S
