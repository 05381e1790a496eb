"""Mixing sources to target weights by hierarchical budgeting.

The token budget goes down the tree domain - language - source.  At every node the
children share its budget by weight; a child takes no more than its subtree
can give (``max_epochs`` times its tokens), and what it leaves goes to its siblings first (they
fill up in proportion to their weights), because a node's own budget is cut to
its subtree's capacity one level higher, where its siblings take over in turn.

A leaf with budget B and T tokens is taken B div T times whole; of the next
epoch it gives the first B mod T tokens in the epoch's seeded order.  That prefix
is found from token sums of hash buckets; only the one bucket in which it ends
is ordered row by row, so a source of any size is never sorted in one task.

Tokens are words (runs without ASCII white space).  Rows alike in doc_id,
language, source and text are one entry with a number of copies, counted one after another.

Defined results: null text is an empty text; null language or source is the
name ''; entries without words are never taken; a null doc_id takes part; ties
cannot occur (the order is by md5 of seed, epoch, doc_id and text); an empty table gives no
rows; extra columns are ignored by ``budgeted`` and carried by ``mixed``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panora.llm.common import WORD, landed

MAX_EPOCHS = 2
SEED = 7
GAP = r"[\x20\x09-\x0D]*"  # white space before a word
RUN = 10_000       # copies of one row that one task rebuilds
BUCKET_DIGITS = 3  # hexadecimal digits of the order's hash that name a bucket

# Target weights (whole numbers) and the grouping of sources: parameters of the
# registered query.  Names that are not listed weigh 1.
DOMAINS = ["web", "books", "forum", "news"]
SOURCES_PER_DOMAIN = 5
WEIGHTS = {
    "domain": {"web": 4, "books": 3, "forum": 1, "news": 2},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}


def domain_of(source: Column) -> Column:
    """Sources by number, SOURCES_PER_DOMAIN to a domain; others are web."""
    number = F.regexp_extract(source, "([0-9]{1,6})$", 1)
    at = F.when(number == "", 0).otherwise(number.cast("int")) / SOURCES_PER_DOMAIN
    return F.coalesce(F.get(F.array(*[F.lit(d) for d in DOMAINS]), F.floor(at).cast("int")), F.lit(DOMAINS[0]))


def _weight(level: str, name: Column, weights: dict) -> Column:
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(name == value, w).otherwise(out)
    return out.cast("long")


def share(rows: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``budget`` (of the parent, on every row) over children with ``w``
    and ``cap``: fill in proportion to the weights up to the capacities.  Whole
    tokens; what rounding leaves goes one by one to the first unfilled children."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = [F.col("cap").cast("double") / F.col("w"), F.col(name)]
    wide = lambda c: c.cast("decimal(38,0)")
    rows = rows.withColumns({
        "left": F.col("budget") - F.coalesce(
            F.sum("cap").over(by.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "weights": F.sum("w").over(by.orderBy(*order).rowsBetween(0, Window.unboundedFollowing))})
    rows = rows.withColumn("full", wide(F.col("cap")) * wide(F.col("weights")) <= wide(F.col("w")) * wide(F.col("left")))
    unfilled = (Window.partitionBy(*parent, "full") if parent else Window.partitionBy("full"))
    rows = rows.withColumns({
        "left": F.first("left").over(unfilled.orderBy(*order)),
        "weights": F.first("weights").over(unfilled.orderBy(*order))})
    rows = rows.withColumn("part", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("w * left div weights")))
    rows = rows.withColumns({
        "given": F.sum("part").over(unfilled.orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                         Window.unboundedFollowing)),
        "place": F.row_number().over(unfilled.orderBy(*order))})
    more = F.when(~F.col("full") & (F.col("place") <= F.col("left") - F.col("given")), 1).otherwise(0)
    return rows.withColumn("budget", (F.col("part") + more).cast("long")) \
        .drop("left", "weights", "full", "part", "given", "place")


def leaves(entries: DataFrame, weights: dict, budget: int | None, max_epochs: int) -> DataFrame:
    """One row per leaf: domain, lang, source, total tokens and budget."""
    levels = ["domain", "lang", "source"]
    tree = landed(entries.groupBy(*levels).agg(F.sum(F.col("tokens") * F.col("copies")).cast("long").alias("total"))
                  .withColumn("cap", F.col("total") * max_epochs), "leaves")
    total, cap = (x or 0 for x in tree.agg(F.sum("total"), F.sum("cap")).first())
    top = F.lit(min(total if budget is None else budget, cap)).cast("long")
    out = None
    for depth, name in enumerate(levels):
        parent, keys = levels[:depth], levels[:depth + 1]
        rows = tree.groupBy(*keys).agg(F.sum("cap").alias("cap"), F.sum("total").alias("total"))
        rows = rows.withColumn("w", _weight(name, F.col(name), weights))
        rows = rows.withColumn("budget", top) if out is None else rows.join(out.select(*parent, "budget"), parent)
        out = share(rows, parent, name)
    return out.select(*levels, "total", "budget")


def entries_of(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, domain, lang, source, text) with tokens and copies."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), name("lang"), name("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"), F.md5(text).alias("text_md5"))
    rows = rows.withColumn("domain", domain_of(F.col("source")))
    return rows.groupBy("doc_id", "domain", "lang", "source", "tokens", "text_md5") \
        .agg(F.count(F.lit(1)).alias("copies"))


def budgeted(docs: DataFrame, weights: dict | None = None, budget: int | None = None,
             max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Entries that are taken: ``doc_id, domain, lang, source, tokens, text_md5,
    copies, times, last_take`` - ``times`` counts all copies over all epochs, ``last_take``
    is the tokens of the last one (fewer than ``tokens`` where the prefix ends in it).
    ``budget`` defaults to the tokens there are."""
    entries = landed(entries_of(docs), "entries")
    levels = ["domain", "lang", "source"]
    plan = leaves(entries, WEIGHTS if weights is None else weights, budget, max_epochs)
    plan = landed(plan.filter("total > 0").select(
        *levels, F.expr("budget div total").alias("epochs"), F.expr("budget % total").alias("rest")), "plan")
    rows = entries.filter("tokens > 0").join(plan, levels)
    rows = rows.withColumn("h", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.col("epochs").cast("string"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_md5")))) \
        .withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    sums = rows.groupBy(*levels, "bucket", "rest").agg(F.sum(F.col("tokens") * F.col("copies")).alias("n"))
    before = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most 16 ** BUCKET_DIGITS rows per leaf: where each bucket starts, and whether the prefix ends in it
    sums = sums.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .select(*levels, "bucket", "begin", ((F.col("begin") < F.col("rest"))
                                             & (F.col("begin") + F.col("n") > F.col("rest"))).alias("ends"))
    rows = landed(rows.join(sums, [*levels, "bucket"]), "placed")
    plain = rows.filter(~F.col("ends")).withColumn(
        "more", F.when(F.col("begin") < F.col("rest"), F.col("copies")).otherwise(0).cast("long")) \
        .withColumn("last_take", F.col("tokens"))
    inner = Window.partitionBy(*levels).orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("begin") + F.coalesce(F.sum(F.col("tokens") * F.col("copies")).over(inner), F.lit(0))
    cut = rows.filter("ends").withColumn("open", F.greatest(F.col("rest") - at, F.lit(0))) \
        .withColumn("more", F.least(F.col("copies"), F.expr("(open + tokens - 1) div tokens"))) \
        .withColumn("last_take", F.when((F.col("more") > 0) & (F.col("more") * F.col("tokens") > F.col("open")),
                                        F.col("open") - (F.col("more") - 1) * F.col("tokens"))
                    .otherwise(F.col("tokens")))
    out = [x.select("doc_id", *levels, "tokens", "text_md5", "copies",
                    (F.col("epochs") * F.col("copies") + F.col("more")).alias("times"), "last_take")
           for x in (plain, cut)]
    return reduce(DataFrame.unionByName, out).filter("times > 0")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the budget takes, once per epoch that takes them
    (the last copy of a document in which a prefix ends is cut after ``last_take``
    words, ``n_chars`` follows if there is one).  Where the prefix ends among
    rows alike, one of them stands for those taken."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))

    def key(*parts) -> Column:      # one short column to join on, without collisions
        return F.md5(F.concat_ws("\x1f", F.coalesce(parts[0].cast("string"), F.lit("none")), *parts[1:]))
    keys = key(F.col("doc_id").cast("long"), same("lang"), same("source"), F.md5(text))
    taken = budgeted(docs, **options).select(
        key(F.col("doc_id"), F.col("lang"), F.col("source"), F.col("text_md5")).alias("__mix_key"),
        F.col("times").alias("__mix_times"), F.col("copies").alias("__mix_copies"),
        F.when(F.col("last_take") < F.col("tokens"), F.col("last_take")).alias("__mix_cut"))
    rows = docs.withColumn("__mix_key", keys).join(taken, "__mix_key")
    even = (F.col("__mix_times") % F.col("__mix_copies") == 0) & F.col("__mix_cut").isNull()
    whole = rows.filter(even).withColumn("__mix_n", F.expr("__mix_times div __mix_copies"))
    part = rows.filter(~even).dropDuplicates(["__mix_key"]).withColumn("__mix_n", F.col("__mix_times"))
    every = whole.unionByName(part)
    # one row that stands for very many copies is dealt out in runs first, each rebuilt by a task of its own
    runs = every.filter(F.col("__mix_n") > RUN).withColumn(
        "__mix_a", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_n"), F.lit(RUN).cast("long"))))
    runs = runs.repartition("__mix_key", "__mix_a").withColumn(
        "__mix_i", F.explode(F.sequence("__mix_a", F.least(F.col("__mix_a") + RUN - 1, F.col("__mix_n"))))).drop("__mix_a")
    few = every.filter(F.col("__mix_n") <= RUN).withColumn(
        "__mix_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_n"))))
    out = few.unionByName(runs)
    cut = F.col("__mix_cut").isNotNull() & (F.col("__mix_i") == F.col("__mix_n"))
    kinds = dict(docs.dtypes)
    short = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(GAP + WORD), F.lit(0)), 1,
                                 F.col("__mix_cut").cast("int")), "")
    new = {"text": F.when(cut, short).otherwise(F.col("text"))}
    if "n_chars" in kinds:
        new["n_chars"] = F.when(cut, F.length(short).cast(kinds["n_chars"])).otherwise(F.col("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
