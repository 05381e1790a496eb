"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule (host, path prefix) fits its host and all subdomains.  Written with the host's labels
reversed, ``org.example/`` + path, a rule is a prefix, that is an interval of
keys.  A url has one such key for every number of its last labels that some rule
uses.  Rules and keys are range-partitioned and sorted together; the sweep over
this order carries the stack of nested rules opened last, takes from it those
whose interval is still open (which are prefixes of the key) and keeps the longest.  What is
open at the start of a partition comes from the partitions before it, one row each.

The order includes the row, so a host or url of any weight is spread over partitions.

Defined results: a null url or one without ``://`` has empty host and path, and
no rule; the longest rule wins, by length of host and path, between rules of one length
the longer host; rules that say both of one prefix block; rules without host or verdict
are ignored and a null path is empty; a null page_id and repeated
rows are judged like any other row; empty tables give no rows (no rules:
``default`` everywhere); extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panora.llm.common import landed


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows of a short list."""
    if not rules:
        return spark.createDataFrame([], "host string, path string, verdict string")
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                     for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return _lower(raw), path


def _key(labels: Column, depth: Column, path: Column) -> Column:
    # a host has no "/", so the first one ends it
    return F.concat(F.array_join(F.slice(labels, F.lit(1), depth), "."), F.lit("/"), path)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def stacks(rules: DataFrame) -> DataFrame:
    """One row per rule prefix: ``key, depth, stack`` - the rules whose intervals hold it
    (itself included), longest first."""
    host, path = _lower(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    known = rules.filter(F.col("verdict").isNotNull() & (F.coalesce(F.length("host"), F.lit(0)) > 0)) \
        .select(_key(_labels(host), F.size(_labels(host)), path).alias("key"), F.size(_labels(host)).alias("depth"),
                F.length(host).alias("host_length"), F.concat(host, path).alias("rule"), F.col("verdict")) \
        .groupBy("key", "depth", "host_length", "rule").agg(F.max("verdict").alias("verdict"))
    inner = known.select(F.col("key").alias("of"), F.col("depth").alias("of_depth"),
                         F.explode(F.expr("transform(sequence(1, length(key)), i -> left(key, i))")).alias("key"))
    return inner.join(known, "key").groupBy(F.col("of").alias("key"), F.col("of_depth").alias("depth")).agg(
        F.sort_array(F.collect_list(F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict", "key")),
                     asc=False).alias("stack"))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row."""
    spark = pages.sparkSession
    opened = landed(stacks(rules), "rules")
    # label counts in use: a host name has 127 labels at most
    depths = sorted(r.depth for r in opened.select("depth").distinct().collect())
    host, path = split_url(F.col("url").cast("string"))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                        host.alias("host"), path.alias("path"))
    some = F.array(*[F.lit(d) for d in depths]).cast("array<int>")
    keys = F.transform(F.filter(some, lambda d: (d <= F.size(_labels(F.col("host")))) & (F.col("host") != "")),
                       lambda d: _key(_labels(F.col("host")), d, F.col("path")))
    keys = F.when(F.size(keys) > 0, keys).otherwise(F.array(F.lit("")))
    page = F.struct("page_id", "host", "path")
    urls = urls.select("row", page.alias("page"), F.posexplode(keys).alias("nth", "key"))
    events = urls.select("key", F.lit(1).alias("is_url"), "row", F.when(F.col("nth") == 0, F.col("page")).alias("page"),
                         F.lit(None).cast(opened.schema["stack"].dataType).alias("stack")) \
        .unionByName(opened.select("key", F.lit(0).alias("is_url"), F.lit(-1).cast("long").alias("row"),
                                   F.lit(None).cast("struct<page_id:long,host:string,path:string>").alias("page"),
                                   "stack"))
    order = ["key", "is_url", "row"]
    placed = landed(events.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "events")

    # one row per partition: the stack opened last before it
    last = placed.groupBy("part").agg(F.max_by("stack", F.when(F.col("is_url") == 0, F.col("key"))).alias("stack"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("part", F.last("stack", ignorenulls=True).over(before).alias("carried"))
    sweep = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = placed.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).filter("is_url = 1") \
        .join(F.broadcast(carried), "part", "left")  # a row per partition
    active = F.filter(F.coalesce("stack", "carried"), lambda s: F.startswith(F.col("key"), s["key"]))
    best = swept.groupBy("row").agg(F.first("page", ignorenulls=True).alias("page"),
                                    F.max(F.get(active, F.lit(0))).alias("hit"))
    return best.select("page.page_id", "page.host", "page.path", F.col("hit.rule").alias("rule"),
                       F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
