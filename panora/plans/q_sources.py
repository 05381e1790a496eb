"""Registered queries: sources and sinks.

Each source query lands a copy of a provided table in the file format under
test (written by Spark into the shared checkpoint folder), reads it back with
the library reader and aggregates, so the SQL twin can run on the original
Parquet table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panora.functions.clean import quantize
from panora.operators.reshape import long_to_wide, wide_to_long
from panora.plans.common import CENTS_SUM, QZ, T, cents_sum, qz
from panora.session import scratch_path
from panora.sources.readers import (parse_json_column, read_delimited, read_dir, read_fixed_width,
                                    read_jsonl, read_table, signal_window, stack_parts,
                                    survey_estimates)
from panora.sources.writers import write_table

Q, S = {}, {}


def reg(key, sql=None):
    def deco(fn):
        Q[key] = fn
        if sql is not None:
            S[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------- S1
@reg("s1_read_csv", """
SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acct, c_mktsegment
FROM customer""")
def s1_read_csv(spark, sf):
    c = T(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acct"),
        "c_mktsegment")
    path = scratch_path(spark, "s1")
    c.write.option("header", True).option("nullValue", "NA").csv(path)
    schema = "c_custkey long, c_nationkey int, acct double, c_mktsegment string"
    return read_table(spark, path, schema)


# ---------------------------------------------------------------------------- S2
@reg("s2_read_dir", f"""
SELECT l_returnflag, count(*) AS n, {QZ('sum(l_quantity)')} AS qty,
       {CENTS_SUM('l_extendedprice')} AS price FROM lineitem GROUP BY l_returnflag""")
def s2_read_dir(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity",
                                         "l_extendedprice", "l_tax")
    path = scratch_path(spark, "s2")
    li.repartition(4).write.option("header", True).csv(path)  # a directory of same-shape files
    schema = ("l_orderkey long, l_returnflag string, l_linestatus string, l_quantity double, "
              "l_extendedprice double, l_tax double")
    d = read_dir(spark, path, schema, cols=["l_returnflag", "l_quantity", "l_extendedprice"])
    return d.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), qz(F.sum("l_quantity")).alias("qty"),
                                         cents_sum("l_extendedprice").alias("price"))


# ---------------------------------------------------------------------------- S3
@reg("s3_read_delimited", f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS n, {CENTS_SUM('o_totalprice')} AS total
FROM orders GROUP BY 1, 2""")
def s3_read_delimited(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                      "o_orderpriority")
    path = scratch_path(spark, "s3")
    o.write.option("header", True).option("sep", "\t").csv(path)
    schema = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderpriority string")
    d = read_delimited(spark, path, schema, cols=["o_orderstatus", "o_orderpriority", "o_totalprice"])
    return d.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), cents_sum("o_totalprice").alias("total"))


# ---------------------------------------------------------------------------- S4
@reg("s4_json_lines", f"""
SELECT event_type, count(*) AS n,
  CAST(sum(CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS BIGINT)) AS BIGINT) AS k_sum,
  {QZ('avg(value)')} AS value_mean
FROM events GROUP BY event_type""")
def s4_json_lines(spark, sf):
    ev = T(spark, sf, "events").select("event_id", "event_type", "value", "props")
    path = scratch_path(spark, "s4")
    ev.write.json(path)
    d = read_jsonl(spark, path, "event_id long, event_type string, value double, props string")
    d = parse_json_column(d, "props", "k long")
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum"),
                                       qz(F.avg("value")).alias("value_mean"))


# ---------------------------------------------------------------------------- S5
LAYOUT = [("orderkey", 1, 12, "long"), ("linenumber", 13, 4, "int"),
          ("price", 17, 14, "double"), ("flag", 31, 1, "string")]


@reg("s5_fixed_width", f"""
SELECT l_returnflag AS flag, count(*) AS n, {CENTS_SUM('l_extendedprice')} AS price,
       CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_returnflag""")
def s5_fixed_width(spark, sf):
    li = T(spark, sf, "lineitem")
    txt = li.select(F.format_string("%12d%4d%14.2f%1s", "l_orderkey", "l_linenumber",
                                    "l_extendedprice", "l_returnflag").alias("value"))
    path = scratch_path(spark, "s5")
    txt.write.text(path)
    d = read_fixed_width(spark, path, LAYOUT)
    return d.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), cents_sum("price").alias("price"),
                                 F.sum("linenumber").alias("lines"))


# ---------------------------------------------------------------------------- S6
@reg("s6_stack_parts", f"""
SELECT part, count(*) AS n, {CENTS_SUM('o_totalprice')} AS total FROM (
  SELECT 1 AS part, o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 2 AS part, o_totalprice FROM orders WHERE o_orderstatus <> 'F')
GROUP BY part""")
def s6_stack_parts(spark, sf):
    o = T(spark, sf, "orders")
    a = o.filter(F.col("o_orderstatus") == "F")
    b = o.filter(F.col("o_orderstatus") != "F")
    st = stack_parts([a, b], ["o_orderkey", "o_custkey", "o_totalprice"], part_col="part")
    return st.groupBy("part").agg(F.count(F.lit(1)).alias("n"), cents_sum("o_totalprice").alias("total"))


# ---------------------------------------------------------------------------- S7
SIGNALS = ["click", "purchase", "view"]


@reg("s7_signal_window", f"""
WITH f AS (SELECT event_type AS signal, user_id AS geo_value, CAST(ts AS DATE) AS time_value, value
           FROM events),
 w AS (SELECT * FROM f WHERE time_value BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
       AND signal IN ('click', 'purchase', 'view'))
SELECT time_value, {QZ("avg(value) FILTER (WHERE signal = 'click')")} AS click,
  {QZ("avg(value) FILTER (WHERE signal = 'purchase')")} AS purchase,
  {QZ("avg(value) FILTER (WHERE signal = 'view')")} AS view
FROM w GROUP BY time_value""")
def s7_signal_window(spark, sf):
    feed = T(spark, sf, "events").select(
        F.col("event_type").alias("signal"), F.col("user_id").alias("geo_value"),
        F.to_date("ts").alias("time_value"), "value")
    w = signal_window(feed, "2024-01-08", "2024-01-21", SIGNALS)
    wide = long_to_wide(w, ["time_value"], "signal", ["value"], SIGNALS, template="{level}", agg="mean")
    return wide.select("time_value", *[quantize(s).alias(s) for s in SIGNALS])


# ---------------------------------------------------------------------------- S8
# fixed values: variable metadata of the estimate table
VAR_META = [("acctbal_mean", "Mean account balance"), ("n_customers", "Number of customers"),
            ("acctbal_sd", "SD of account balance")]


@reg("s8_survey_estimates", f"""
WITH g AS (SELECT c_nationkey AS geo, avg(c_acctbal) AS acctbal_mean, CAST(count(*) AS DOUBLE) AS n_customers,
                  stddev_samp(c_acctbal) AS acctbal_sd FROM customer GROUP BY 1),
 l AS (SELECT geo, 'acctbal_mean' AS variable, acctbal_mean AS estimate FROM g
       UNION ALL SELECT geo, 'n_customers', n_customers FROM g
       UNION ALL SELECT geo, 'acctbal_sd', acctbal_sd FROM g)
SELECT geo, variable, {QZ('estimate')} AS estimate,
  CASE variable WHEN 'acctbal_mean' THEN 'Mean account balance'
                WHEN 'n_customers' THEN 'Number of customers' END AS label
FROM l WHERE variable IN ('acctbal_mean', 'n_customers')""")
def s8_survey_estimates(spark, sf):
    g = T(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("geo")).agg(
        F.avg("c_acctbal").alias("acctbal_mean"), F.count(F.lit(1)).cast("double").alias("n_customers"),
        F.stddev_samp("c_acctbal").alias("acctbal_sd"))
    est = wide_to_long(g, ["geo"], ["acctbal_mean", "n_customers", "acctbal_sd"], "variable", "estimate")
    meta = spark.createDataFrame(VAR_META, "variable string, label string")
    out = survey_estimates(est, ["acctbal_mean", "n_customers"], meta)
    return out.select("geo", "variable", quantize("estimate").alias("estimate"), "label")


# ---------------------------------------------------------------------------- S9
@reg("s9_write_table", f"""
SELECT user_id, CAST(floor((dayofyear(CAST(ts AS DATE)) - 1) / 7) + 1 AS INTEGER) AS week,
       {QZ('avg(value)')} AS value_mean FROM events GROUP BY 1, 2""")
def s9_write_table(spark, sf):
    from panora.operators.aggregate import resample
    p = resample(T(spark, sf, "events"), "user_id", "ts", to="week", mean=["value"],
                 template="{col}_mean")
    path = write_table(p, scratch_path(spark, "s9"), partition_by=["week"])
    back = spark.read.parquet(path)
    return back.select("user_id", F.col("week").cast("int").alias("week"),
                       quantize("value_mean").alias("value_mean"))


QUERIES, SQL = Q, S
