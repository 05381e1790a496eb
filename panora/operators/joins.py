"""Joins and merges (inventory J1-J14).

Reference semantics: missing keys match each other in R and Stata merges,
while SQL equality does not.  Every operator takes ``null_keys``:
``"match"`` (default, null-safe equality) or ``"drop"`` (rows with a NULL key
are removed before the join, which also keeps NULL-key rows from piling up
in one shuffle partition).

Broadcasts are never forced on data whose size is unknown.  By default the
choice is left to AQE, which measures the shuffled output of each side at run
time and converts the join to a broadcast only when a side is really below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (sort-merge otherwise).  A
broadcast hint is given only for inputs that are small by construction
(literal tables, one-row aggregates, per-key tables of a bounded dimension),
and then only when the caller says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from panora.operators.nullsafe import attach

MATCH, DROP = "match", "drop"

#: A key with more than HEAVY pairs of rows is joined in blocks of about BLOCK x BLOCK rows, which are dealt out
#: to one task per TASK_PAIRS pairs (at most MAX_TASKS tasks, which then take more blocks each).
HEAVY, BLOCK, TASK_PAIRS, MAX_TASKS = 1 << 16, 2048, 1 << 23, 10_000
SMALL_TABLE = 10_000  # rows of heavy keys up to which their table is broadcast


def hinted(df: DataFrame, broadcast: bool | None) -> DataFrame:
    """``broadcast=True`` only for sides bounded by construction; ``None``
    leaves the decision to AQE's run-time size measurement."""
    return F.broadcast(df) if broadcast else df


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(cond)


def _cond(l: DataFrame, r: DataFrame, lk: Sequence[str], rk: Sequence[str],
          null_keys: str) -> Column:
    parts = [(l[a].eqNullSafe(r[b]) if null_keys == MATCH else l[a] == r[b])
             for a, b in zip(lk, rk)]
    return reduce(lambda a, b: a & b, parts)


def _check_clash(frames: Sequence[DataFrame], keys: Sequence[str]) -> None:
    seen: dict[str, int] = {}
    for i, f in enumerate(frames):
        for c in f.columns:
            if c in keys:
                continue
            if c in seen:
                raise ValueError(f"column {c!r} appears in inputs {seen[c]} and {i}; "
                                 "rename it or list it as a key")
            seen[c] = i


def join(left: DataFrame, right: DataFrame, on, how: str = "inner",
         right_on=None, null_keys: str = MATCH) -> DataFrame:
    """Equi-join that keeps one copy of each key (named as on the left).

    Covers J2 (full join, different key names), J4 (right), J5 (inner) and
    J9 (all pairs within key, unmatched dropped = inner).  Key columns of
    outer joins are coalesced from both sides.
    """
    lk = _keys(on)
    rk = _keys(right_on) if right_on is not None else lk
    if null_keys == DROP:
        left, right = _drop_null_keys(left, lk), _drop_null_keys(right, rk)
    r = right.select(*[F.col(b).alias(f"__rk{i}") for i, b in enumerate(rk)],
                     *[c for c in right.columns if c not in rk])
    rkn = [f"__rk{i}" for i in range(len(rk))]
    _check_clash([left.drop(*lk), r.drop(*rkn)], [])
    cond = _cond(left, r, lk, rkn, null_keys)
    j = left.join(r, cond, how)
    if how in ("inner", "left", "left_outer"):
        keys = [left[a].alias(a) for a in lk]
    elif how in ("right", "right_outer"):
        keys = [r[b].alias(a) for a, b in zip(lk, rkn)]
    else:
        keys = [F.coalesce(left[a], r[b]).alias(a) for a, b in zip(lk, rkn)]
    rest = [left[c] for c in left.columns if c not in lk] + \
           [r[c] for c in r.columns if c not in rkn]
    return j.select(*keys, *rest)


# --------------------------------------------------------------------------- J1
def align(*frames: DataFrame, keys: Sequence[str], null_keys: str = MATCH,
          unique: bool | None = None, check: bool = False, drop_null: str | None = None) -> DataFrame:
    """Natural full outer join chain of many tables on explicit ``keys``;
    ``drop_null`` names a period column whose missing rows are dropped afterwards (M7).

    When each input is unique on ``keys`` (the panel case) the chain is
    rewritten as a union + one aggregation: a single shuffle on the key
    instead of n-1 sort-merge joins, null-safe because grouping treats NULLs
    as equal, and partial aggregation runs before the shuffle.  Non-key
    columns must be disjoint (M17).  By default the uniqueness is verified
    inside that same aggregation (rows per source and key, the result is
    landed); inputs with repeated keys go through a null-safe full outer
    join chain instead (:func:`full_chain`), which keeps the many-to-many fan-out,
    so no row is lost.  ``check=True`` raises there instead, ``unique=False`` takes the chain
    at once, ``unique=True`` skips the check (the caller vouches for it).
    """
    keys = list(keys)
    if drop_null:
        return drop_null_period(align(*frames, keys=keys, null_keys=null_keys, unique=unique, check=check), drop_null)
    _check_clash(frames, keys)
    if null_keys == DROP:
        frames = [_drop_null_keys(f, keys) for f in frames]
    if unique is False:
        return full_chain(frames, keys, null_keys)
    stacked = _tagged(frames)
    values = [c for f in frames for c in f.columns if c not in keys]
    aggs = [F.first(c, ignorenulls=True).alias(c) for c in values]
    if unique and not check:
        return stacked.groupBy(*keys).agg(*aggs)
    from panora.sources.writers import cut_lineage, drop_scratch
    # landed: read by the check and by the caller, and no cached copy is left behind
    out = cut_lineage(stacked.groupBy(*keys).agg(*aggs, *_rows_per_frame(frames)), how="parquet")
    dup = out.filter(reduce(lambda a, b: a | b, [F.col(f"__n{i}") > 1 for i in range(len(frames))]))
    if dup.limit(1).count():
        chain = None if check else full_chain(frames, keys, null_keys, counts=out)
        drop_scratch(out)
        if not check:
            return chain
        raise ValueError(f"align: an input is not unique on {keys}; use unique=False")
    return out.drop(*[f"__n{i}" for i in range(len(frames))])


def _tagged(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames, with the frame's number."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [f.withColumn("__src", F.lit(i)) for i, f in enumerate(frames)])


def _rows_per_frame(frames: Sequence[DataFrame]) -> list[Column]:
    return [F.count_if(F.col("__src") == i).alias(f"__n{i}") for i in range(len(frames))]


def full_chain(frames: Sequence[DataFrame], keys: Sequence[str], null_keys: str = MATCH,
               counts: DataFrame | None = None) -> DataFrame:
    """Full outer joins of ``frames`` one after the other, keys repeated on any side.

    A full outer join makes all pairs of a key before it hands one on, so a key
    with many rows on both sides fills the executor's memory.  Each step is
    therefore a left join, which hands on the matches row by row, plus the rows
    whose key no earlier frame has (left anti against the distinct keys).

    A key can have far more pairs than rows, so the tasks that a step needs
    follow neither from the size of its inputs nor from the number of keys.
    Keys with many pairs are therefore joined in blocks (:func:`_block_join`);
    ``counts`` (rows per key and frame, ``__n0``, ``__n1``, ...) tells which
    these are, and is made here if not given.
    """
    from panora.sources.writers import cut_lineage, drop_scratch
    keys, out = list(keys), frames[0]
    names = [f"__k{i}" for i in range(len(keys))]
    if counts is None:
        counts = _tagged([f.select(*keys) for f in frames]).groupBy(*keys).agg(*_rows_per_frame(frames))
    heavy, total = _heavy_keys(counts, keys, names, len(frames))
    if total["n"]:  # rows are numbered and landed, so that a repeated task cuts them alike
        frames = [cut_lineage(f.withColumn("__slot", F.monotonically_increasing_id()), how="parquet") for f in frames]
        out = frames[0]
    else:
        drop_scratch(heavy)
    known = [f.select(*[F.col(k).alias(b) for k, b in zip(keys, names)]) for f in frames]
    for i, f in enumerate(frames[1:], 1):
        f = f.withColumnRenamed("__slot", "__slot_r")
        pairs, blocks = total[f"p{i}"], None
        if pairs:
            h = heavy.filter(F.col(f"__p{i}") > HEAVY).select(
                *names, "__key", F.col(f"__a{i}").alias("__a"), F.col(f"__b{i}").alias("__b"))
            h = hinted(h, total["n"] <= SMALL_TABLE)
            tasks = int(min(max(pairs // TASK_PAIRS, 1), MAX_TASKS))
            blocks = _block_join(out, f, h, keys, names, tasks, null_keys)
            out, f = (x.join(h, _cond(x, h, keys, names, null_keys), "left_anti") for x in (out, f))
        before = reduce(DataFrame.unionByName, known[:i]).distinct()
        only = f.join(before, _cond(f, before, keys, names, null_keys), "left_anti")
        out = join(out, f, keys, "left", null_keys=null_keys).unionByName(only, allowMissingColumns=True)
        if blocks is not None:
            out = out.unionByName(blocks)
        if total["n"]:
            out = out.withColumn("__slot", F.xxhash64("__slot", "__slot_r")).drop("__slot_r")
    return out.drop("__slot")


def _heavy_keys(counts: DataFrame, keys: Sequence[str], names: Sequence[str], k: int) -> tuple[DataFrame, Row]:
    """Keys with more than HEAVY pairs in step i of a chain of ``k`` frames (``__p{i}``), numbered, with the parts
    to cut their rows into (``__a{i}`` before the step, ``__b{i}`` in frame i), landed; the number of these keys
    and each step's pairs on them."""
    from panora.sources.writers import cut_lineage
    n = [F.col(f"__n{i}").cast("double") for i in range(k)]  # doubles: products of counts pass the range of a long
    steps, cols = range(1, k), {}
    for i in steps:
        # a frame without the key keeps the rows of the others
        rows = reduce(lambda a, b: a * b, [F.greatest(x, F.lit(1.0)) for x in n[:i]])
        cols |= {f"__p{i}": F.when(F.greatest(F.lit(0.0), *n[:i]) > 0, rows * n[i]).otherwise(0.0),
                 f"__a{i}": F.ceil(rows / BLOCK), f"__b{i}": F.ceil(n[i] / BLOCK)}
    per_key = counts.select(*[F.col(c).alias(b) for c, b in zip(keys, names)], *[c.alias(a) for a, c in cols.items()])
    some = reduce(lambda a, b: a | b, [F.col(f"__p{i}") > HEAVY for i in steps], F.lit(False))
    heavy = cut_lineage(per_key.filter(some).withColumn("__key", F.monotonically_increasing_id()), how="parquet")
    return heavy, heavy.agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.when(F.col(f"__p{i}") > HEAVY, F.col(f"__p{i}"))).alias(f"p{i}") for i in steps]).first()


def _block_join(left: DataFrame, right: DataFrame, heavy: DataFrame, keys: Sequence[str], names: Sequence[str],
                tasks: int, null_keys: str) -> DataFrame:
    """Inner join on the keys of ``heavy``, whose rows are cut into ``__a`` parts on the left and ``__b`` on the
    right; each pair of parts is a block of its own, so a key's pairs are spread over the tasks."""
    def dealt(df: DataFrame, slot: str, own: str, mine: str, other: str, theirs: str) -> DataFrame:
        return (df.join(heavy, _cond(df, heavy, keys, names, null_keys))
                .withColumn(mine, F.pmod(F.col(slot), F.col(own)))
                .withColumn(theirs, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))
                .drop(*names, "__a", "__b").repartition(tasks, "__key", "__i", "__j"))

    values = [c for c in right.columns if c not in keys]
    l = dealt(left, "__slot", "__a", "__i", "__b", "__j")
    r = dealt(right, "__slot_r", "__b", "__j", "__a", "__i").drop(*keys)
    return l.join(r.hint("merge"), ["__key", "__i", "__j"]).select(*left.columns, *values)


def drop_null_period(df: DataFrame, period: str) -> DataFrame:
    """M7: rows that a full join of entity attributes left without a period are dropped."""
    return df.filter(F.col(period).isNotNull())


# --------------------------------------------------------------------------- J3
def lookup(df: DataFrame, dim: DataFrame, on, right_on=None, cols: Sequence[str] | None = None,
           broadcast: bool | None = None, null_keys: str = MATCH) -> DataFrame:
    """Left lookup join against a dimension (see module notes on broadcasting)."""
    rk = _keys(right_on) if right_on is not None else _keys(on)
    if cols is not None:
        dim = dim.select(*rk, *[c for c in cols if c not in rk])
    return join(df, hinted(dim, broadcast), on, "left", right_on=right_on, null_keys=null_keys)


# --------------------------------------------------------------------------- J6
def crosswalk(df: DataFrame, xw: DataFrame, on: str, to: str, ratio: str | None = None,
              mode: str = "expand", threshold: float = 0.5,
              allocate: Sequence[str] = (), null_keys: str = MATCH) -> DataFrame:
    """Many-to-many crosswalk from key ``on`` to key ``to``.

    ``expand``: every row is repeated once per matched target (fan-out is the
    point; a site counts once per county).  ``majority``: keep only crosswalk
    cells with ratio > threshold, so each source key maps to at most one
    target.  ``allocate``: like expand, but ``allocate`` columns are weighted
    by the ratio.
    """
    cols = [on, to] + ([ratio] if ratio else [])
    x = xw.select(*cols)
    if mode == "majority":
        x = x.filter(F.col(ratio) > threshold)
    if null_keys == DROP:
        df, x = _drop_null_keys(df, [on]), _drop_null_keys(x, [on])
    out = attach(df, x, [on])
    if mode == "allocate":
        out = out.withColumns({c: F.col(c) * F.col(ratio) for c in allocate})
    return out


# --------------------------------------------------------------------------- J7
def merge_m1(master: DataFrame, using: DataFrame, keys, null_keys: str = MATCH,
             status: str = "_merge", check: bool = True) -> DataFrame:
    """m:1 merge with a match-status column: 1 master only, 2 using only, 3 both.

    Asserts ``using`` is unique on ``keys`` (a distributed ``groupBy``;
    only a bounded probe reaches the driver).  On a name clash the master
    value is kept (Stata's default).

    Because ``using`` is unique, the full outer join is written as
    master LEFT JOIN using plus the using rows whose key no master row has
    (LEFT ANTI against the distinct master keys).  Both joins can be split by
    AQE when one master key holds a large share of the rows, which a full
    outer join cannot.
    """
    keys = _keys(keys)
    if check:
        dup = using.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"m:1 merge: using side is not unique on {keys}")
    if null_keys == DROP:
        master, using = _drop_null_keys(master, keys), _drop_null_keys(using, keys)
    mcols = [c for c in master.columns if c not in keys]
    ucols = [c for c in using.columns if c not in keys]
    ukn = [f"__uk{i}" for i in range(len(keys))]
    u = using.select(*[F.col(k).alias(b) for k, b in zip(keys, ukn)],
                     *[F.col(c).alias(f"__u_{c}") for c in ucols], F.lit(2).alias("__in_u"))
    both = master.join(u, _cond(master, u, keys, ukn, null_keys), "left")
    code = F.when(F.col("__in_u").isNotNull(), F.lit(3)).otherwise(F.lit(1))
    part1 = both.select(*[master[k] for k in keys],
                        *[master[c] for c in mcols],
                        *[F.col(f"__u_{c}").alias(c) for c in ucols if c not in mcols],
                        code.alias(status))
    mk = master.select(*[F.col(k).alias(f"__mk{i}") for i, k in enumerate(keys)]).distinct()
    only = u.join(mk, _cond(u, mk, ukn, [f"__mk{i}" for i in range(len(keys))], null_keys),
                  "left_anti")
    vals = {c: (F.col(f"__u_{c}") if c in ucols else F.lit(None).cast(master.schema[c].dataType))
            for c in mcols}
    part2 = only.select(*[F.col(b).alias(k) for k, b in zip(keys, ukn)],
                        *[vals[c].alias(c) for c in mcols],
                        *[F.col(f"__u_{c}").alias(c) for c in ucols if c not in mcols],
                        F.lit(2).alias(status))
    return part1.unionByName(part2)


# --------------------------------------------------------------------------- J8
def merge_mm(left: DataFrame, right: DataFrame, key: str, order_left: Sequence,
             order_right: Sequence, null_keys: str = MATCH) -> DataFrame:
    """Stata-style m:m merge: rows are paired by position inside each key.

    Output has max(n_left, n_right) rows per key; the shorter side repeats its
    last row.  Implemented with equi-joins on (key, position), so no key ever
    expands into all pairs.  ``order_*`` make the positions deterministic
    (the reference relied on storage order).
    """
    if null_keys == DROP:
        left, right = _drop_null_keys(left, [key]), _drop_null_keys(right, [key])
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    _check_clash([left.drop(key), right.drop(key)], [])
    wl = _position(left, key, order_left, "__pl").withColumnRenamed(key, "__kl")
    wr = _position(right, key, order_right, "__pr").withColumnRenamed(key, "__kr")
    nl = wl.groupBy(F.col("__kl").alias("__knl")).agg(F.count(F.lit(1)).alias("__nl"))
    nr = wr.groupBy(F.col("__kr").alias("__knr")).agg(F.count(F.lit(1)).alias("__nr"))
    # every left row pairs with right row min(position, n_right)
    a = (wl.join(nr, F.col("__kl").eqNullSafe(F.col("__knr")), "left")
         .select("__kl", *lcols, F.least("__pl", "__nr").alias("__t")))
    ra = wr.select(F.col("__kr").alias("__ka"), F.col("__pr").alias("__ta"), *rcols)
    part_a = (a.join(ra, F.col("__kl").eqNullSafe(F.col("__ka")) & (F.col("__t") == F.col("__ta")), "left")
              .select(F.col("__kl").alias(key), *lcols, *rcols))
    # right rows beyond n_left pair with the last left row
    b = (wr.join(nl, F.col("__kr").eqNullSafe(F.col("__knl")), "left")
         .filter(F.col("__pr") > F.coalesce(F.col("__nl"), F.lit(0)))
         .select("__kr", *rcols, F.col("__nl").alias("__t")))
    lb = wl.select(F.col("__kl").alias("__kb"), F.col("__pl").alias("__tb"), *lcols)
    part_b = (b.join(lb, F.col("__kr").eqNullSafe(F.col("__kb")) & (F.col("__t") == F.col("__tb")), "left")
              .select(F.col("__kr").alias(key), *lcols, *rcols))
    return part_a.unionByName(part_b)


def _position(df: DataFrame, key: str, order: Sequence, pos: str) -> DataFrame:
    """Row position inside each key under an explicit order of any type, numbered over range
    parts: neither a huge key nor many rows of one order value are numbered in one task."""
    from panora.operators.ordering import number_rows
    rest = [c for c in df.columns if c != key and c not in order]
    return number_rows(df, [*order, *rest], [key], pos).withColumn(pos, F.col(pos).cast("int"))


# --------------------------------------------------------------------------- J10
def neighbor_sum(panel: DataFrame, edges: DataFrame, entity: str, period: str,
                 value: str, src: str = "entity", dst: str = "neighbor",
                 out: str | None = None, null_keys: str = MATCH) -> DataFrame:
    """Sum of neighbours' ``value`` per (entity, period) over an edge list.

    The edge list joins the panel on the neighbour, then one aggregation
    folds back to the entity; partial aggregation runs before the shuffle.
    """
    out = out or f"nbr_sum_{value}"
    e = edges.select(F.col(src).alias("__e"), F.col(dst).alias("__n"))
    p = panel.select(F.col(entity).alias("__n"), F.col(period).alias(period), F.col(value))
    if null_keys == DROP:
        e, p = _drop_null_keys(e, ["__n"]), _drop_null_keys(p, ["__n"])
    return (attach(e, p, ["__n"], "inner")
            .groupBy(F.col("__e").alias(entity), F.col(period))
            .agg(F.sum(value).alias(out)))


# --------------------------------------------------------------------------- J11
def membership_flag(df: DataFrame, members: DataFrame, keys, flag: str = "member",
                    null_keys: str = MATCH) -> DataFrame:
    """Add a 0/1 flag: is the row's key present in ``members``."""
    keys = _keys(keys)
    m = members.select(*keys).distinct().withColumn(flag, F.lit(1))
    return attach(df, m, keys, plain=keys if null_keys == DROP else ()).withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def restrict(df: DataFrame, members: DataFrame, keys, keep: bool = True,
             null_keys: str = MATCH) -> DataFrame:
    """Sample restriction by membership: semi join (``keep``) or anti join."""
    keys = _keys(keys)
    return attach(df, members.select(*keys), keys, "left_semi" if keep else "left_anti",
                  plain=keys if null_keys == DROP else ())


# --------------------------------------------------------------------------- J12
def coverage_flags(universe: DataFrame, sources: Mapping[str, DataFrame], key: str,
                   prefix: str = "in_", null_keys: str = MATCH) -> DataFrame:
    """One 0/1 column per source saying whether the universe key appears there.

    Distinct keys of every source are tagged and unioned, then one pivot on
    the (bounded) tag list gives the flags; a single left join attaches them.
    """
    tags = list(sources)
    tagged = reduce(lambda a, b: a.unionByName(b),
                    [s.select(F.col(key), F.lit(t).alias("__src")).distinct()
                     for t, s in sources.items()])
    flags = tagged.groupBy(key).pivot("__src", tags).agg(F.lit(1))
    flags = flags.withColumnsRenamed({t: f"{prefix}{t}" for t in tags})
    out = attach(universe, flags, [key], plain=[key] if null_keys == DROP else ())
    return out.fillna(0, subset=[f"{prefix}{t}" for t in tags])


# --------------------------------------------------------------------------- J13
DATES = ("date", "timestamp", "timestamp_ntz")
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def frequency(df: DataFrame, time: str) -> str:
    """The widest calendar step that holds every date of the column: year, quarter, month (dates alike in
    their day, or all month ends), week or day.  One aggregation."""
    day = F.to_date(time)
    month = F.year(day) * 12 + F.month(day)
    r = df.select(day.alias("d"), month.alias("m"), F.day(day).alias("k"), F.last_day(day).alias("l")).agg(
        (F.min("k") == F.max("k")).alias("same"), F.bool_and(F.col("d") == F.col("l")).alias("ends"),
        F.min("m").alias("m0"), F.max("m").alias("m1"), F.min(F.pmod("m", F.lit(12))) == F.max(F.pmod("m", F.lit(12))),
        F.min(F.pmod("m", F.lit(3))) == F.max(F.pmod("m", F.lit(3))),
        F.min(F.pmod(F.unix_date("d"), F.lit(7))) == F.max(F.pmod(F.unix_date("d"), F.lit(7)))).first()
    if r.m0 is not None and r.m0 < r.m1 and (r.same or r.ends):
        return "year" if r[4] else "quarter" if r[5] else "month"
    return "week" if r[6] else "day"


def _grid(lo: Column, hi: Column, step: int, freq: str | None) -> Column:
    """The periods from ``lo`` to ``hi``: numbers by ``step``, dates by ``step`` calendar units."""
    if freq is None:
        return F.sequence(lo, hi, F.lit(step))
    if freq in ("day", "week"):
        return F.sequence(lo, hi, F.expr(f"INTERVAL {step * (7 if freq == 'week' else 1)} DAYS"))
    by = step * MONTHS[freq]
    span = ((F.year(hi) * 12 + F.month(hi) - F.year(lo) * 12 - F.month(lo)) / F.lit(by)).cast("int")
    ends = (F.to_date(lo) == F.last_day(lo)) & (F.to_date(hi) == F.last_day(hi))

    def period(i: Column) -> Column:
        at = F.add_months(lo, i * by)
        return F.when(ends, F.last_day(at)).otherwise(at)
    return F.filter(F.transform(F.sequence(F.lit(0), span), period), lambda d: d <= F.to_date(hi))


def balance(df: DataFrame, entity: str, time: str, step: int = 1,
            span: str = "global", freq: str | None = None) -> DataFrame:
    """Balanced panel skeleton: every entity x every period of the time range.

    The time range is a scalar subquery (min, max over the panel); periods are
    generated per entity with ``sequence`` + ``explode``, so no join is
    needed.  ``span="entity"`` uses each entity's own first..last period.
    Dates step by ``freq`` (day, week, month, quarter, year; by default the widest that holds
    all of them, :func:`frequency`), numbers by ``step``.
    """
    kind = dict(df.dtypes)[time]
    if kind in DATES:
        freq = freq or frequency(df, time)
    if span == "entity":
        rng = df.groupBy(entity).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi")).filter(F.col("__lo").isNotNull())
        out = rng.select(entity, F.explode(_grid(F.col("__lo"), F.col("__hi"), step, freq)).alias(time))
    else:
        lo, hi = df.select(F.min(time)).scalar(), df.select(F.max(time)).scalar()
        out = df.select(entity).distinct().withColumns({"__lo": lo, "__hi": hi}).filter(F.col("__lo").isNotNull()).select(
            entity, F.explode(_grid(F.col("__lo"), F.col("__hi"), step, freq)).alias(time))
    return out.withColumn(time, F.col(time).cast(kind))


def fill_balanced(df: DataFrame, entity: str, time: str, fill: Mapping[str, object] | None = None,
                  step: int = 1, freq: str | None = None, status: str | None = None) -> DataFrame:
    """The panel on its balanced skeleton, optionally filling gaps.

    Rows off the grid (or without a period) are kept as they are, after the skeleton's.  ``status`` names a column
    that tells 1 a gap of the panel, 2 a row off the grid, 3 a row on it.
    """
    grid = balance(df, entity, time, step, freq=freq)
    own = df.withColumn("__there", F.lit(3))
    out = attach(grid, own, [entity, time])
    if fill:
        out = out.fillna(dict(fill))
    off = attach(df, grid, [entity, time], "left_anti").withColumn("__there", F.lit(2))
    out = out.unionByName(off.select(*out.columns)).withColumn("__there", F.coalesce("__there", F.lit(1)))
    out = out.select(*df.columns, "__there")
    return out.withColumnRenamed("__there", status) if status else out.drop("__there")


# --------------------------------------------------------------------------- J14
def link(df: DataFrame, other: DataFrame, keys, cols: Sequence[str],
         broadcast: bool | None = None) -> DataFrame:
    """Attach ``cols`` from a linked table m:1 (frame link + frame get)."""
    keys = _keys(keys)
    dup = other.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"link: linked table is not unique on {keys}")
    return lookup(df, other, keys, cols=cols, broadcast=broadcast)
