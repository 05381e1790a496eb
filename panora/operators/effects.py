"""Two absorbed effects (entity and period) without indicator columns.

Rows are reduced to cells, one per (sample, entity, period), with their number and the
sums of every design column.  One effect (``a``, the one with more levels) is swept out by
demeaning; what is left of the other one's indicators has the Gram matrix

    S = diag(n_b) - sum over a of n_a. n_a.' / n_a

which needs the counts of the cells only, and the cross products with the demeaned columns are one
sum per level of ``b``.  Solving S for these gives the effects that every column's fit
on both sets of indicators has, and a row's two-way residual is

    column - g[level of b] - h[level of a]

two lookups, however many levels there are.  With at most ``DENSE_LEVELS`` levels of ``b``
S is summed up as a matrix and solved on the driver; beyond that conjugate gradients solve it, one pass over the
cells a round, and nothing of the size of a factor leaves the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panora.sources.writers import cut_lineage, drop_scratch

MERGE_BUCKETS = 64      # partial sums meet in so many tasks before the last one
DENSE_LEVELS = 2_048    # levels of the smaller effect solved as a matrix
DENSE_CELLS = 1 << 25   # numbers of all samples' matrices summed up in one pass
CG_TOL = 1e-13          # of the residual, relative to the right-hand side
CG_ROUNDS = 1_000


def summed(df: DataFrame, part, size: int) -> np.ndarray:
    """Add up one vector of ``size`` numbers per partition: ``part(batches)``
    returns it.  A partition sends one row, bucket tasks add them, and one
    row reaches the driver."""
    import pandas as pd

    def emit(it):
        from pyspark import TaskContext
        flat = part(it)
        yield pd.DataFrame({"b": [TaskContext.get().partitionId() % MERGE_BUCKETS],
                            "v": [np.asarray(flat, dtype="<f8").tobytes()]})

    def add(it):
        total = np.zeros(size)
        for pdf in it:
            for v in pdf["v"]:
                total = total + np.frombuffer(v, dtype="<f8")
        yield pd.DataFrame({"v": [total.tobytes()]})

    buckets = min(MERGE_BUCKETS, df.sparkSession.sparkContext.defaultParallelism)
    rows = (df.mapInPandas(emit, "b int, v binary").repartition(buckets, "b")
            .mapInPandas(add, "v binary").repartition(1).mapInPandas(add, "v binary").collect())
    return np.frombuffer(rows[0][0], dtype="<f8") if rows else np.zeros(size)


@dataclass
class Solved:
    """The two effects of one sample, b's per level, for every column.

    The constant of a fit has the period effects measured from a base period
    (the lowest; of any further unconnected part of the panel its last).  It is ``means`` of the outcome
    less ``means`` of the regressors times their slopes, and a row's weight in it, the regressors aside, is
    that of ``weight`` less the two-way residual of the b level's ``rho``; ``squares`` is the
    sum of these weights' squares."""

    n: int
    groups: int
    periods: int
    components: int
    means: np.ndarray
    squares: float
    weight: list[tuple]                  # (period, or None for all rows, weight)
    between: np.ndarray                  # sums of squares of every column between entities
    table: DataFrame                     # (b, g0.., rho)
    matrix: np.ndarray | None = None     # dense: per level of all samples the effects, rho last


def sums(k: int) -> list[str]:
    return [f"z{i}" for i in range(k)]


def group_means(cells: DataFrame, k: int) -> DataFrame:
    """(s, a, na, m0..): the means of every column per level of ``a``."""
    return cells.groupBy("s", "a").agg(F.sum("n").alias("na"), *[F.expr(f"sum(z{i}) / sum(n)").alias(f"m{i}")
                                                                 for i in range(k)])


def _cross(cells: DataFrame, k: int) -> DataFrame:
    """(s, b, n, z0..): sums of the demeaned columns per level of ``b``."""
    d = cells.join(group_means(cells, k).drop("na"), ["s", "a"])
    return d.groupBy("s", "b").agg(F.sum("n").alias("n"), *[
        F.sum(F.col(f"z{i}") - F.col("n") * F.col(f"m{i}")).alias(f"z{i}") for i in range(k)])


def offsets(cells: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """(s, a, h0.., rbar): what is left to take off per level of ``a`` once b's effects are."""
    on = ["s", "b"] if "s" in table.columns else ["b"]
    return cells.join(table, on).groupBy("s", "a").agg(
        *[F.expr(f"sum(z{i} - n * g{i}) / sum(n)").alias(f"h{i}") for i in range(k)],
        F.expr("sum(n * rho) / sum(n)").alias("rbar"))


def _components(matrix: np.ndarray) -> np.ndarray:
    """Component number of every level; levels are linked where the matrix is not zero."""
    label = np.full(len(matrix), -1)
    for first in range(len(matrix)):
        if label[first] < 0:
            front = np.array([first])
            label[first] = first
            while len(front):
                front = np.flatnonzero((matrix[front] != 0).any(axis=0) & (label < 0))
                label[front] = first
    return label


def _cell_sums(cells: DataFrame, k: int, t: int, samples: int) -> list[tuple]:
    """Per sample over the levels 0..t-1 of ``b``: S, the cross products with the demeaned
    columns, counts, raw sums, the number of levels of ``a`` and the sums' squares between them."""
    out: list[tuple] = []
    per = max(1, DENSE_CELLS // (t * t))
    size = t * t + 2 * t * k + t + 1 + k
    for lo in range(0, samples, per):
        many = min(per, samples - lo)
        own = cells.filter(F.col("s").between(lo, lo + many - 1)) if many < samples else cells
        # at most t cells per level of a
        lists = own.groupBy((F.col("s") - lo).alias("s"), "a").agg(
            F.collect_list(F.struct("b", "n", F.array(*sums(k)).alias("z"))).alias("l"))
        lists = lists.select("s", F.col("l.b").alias("bs"), F.col("l.n").alias("ns"), F.flatten("l.z").alias("zs"))

        def part(it):
            total = [(np.zeros((t, t)), np.zeros((t, k)), np.zeros(t), np.zeros((t, k)), np.zeros(1), np.zeros(k))
                     for _ in range(many)]
            for pdf in it:
                for s, rows in pdf.groupby("s"):
                    matrix, cross, counts, raw, levels, squares = total[s]
                    for at in range(0, len(rows), 256):
                        some = rows.iloc[at:at + 256]
                        length = some["bs"].map(len).to_numpy()
                        row = np.repeat(np.arange(len(some)), length)
                        b, n = np.concatenate(some["bs"].to_numpy()), np.concatenate(some["ns"].to_numpy()).astype(float)
                        z = np.concatenate(some["zs"].to_numpy()).reshape(-1, k)
                        first = np.cumsum(length) - length
                        na, za = np.add.reduceat(n, first), np.add.reduceat(z, first, axis=0)
                        d = z - n[:, None] * (za / na[:, None])[row]
                        held = np.zeros((len(some), t))
                        held[row, b] = n / np.sqrt(na)[row]
                        matrix -= held.T @ held
                        here = np.bincount(b, n, t)
                        counts += here
                        matrix[np.diag_indices(t)] += here
                        for j in range(k):
                            cross[:, j] += np.bincount(b, d[:, j], t)
                            raw[:, j] += np.bincount(b, z[:, j], t)
                        levels += len(some)
                        squares += (za * za / na[:, None]).sum(axis=0)
            return np.concatenate([x.ravel() for sample in total for x in sample])
        for flat in summed(lists, part, many * size).reshape(many, size):
            cut = np.cumsum([t * t, t * k, t, t * k, 1])
            m, c, n, r, levels, squares = np.split(flat, cut)
            out.append((m.reshape(t, t), c.reshape(t, k), n, r.reshape(t, k), int(levels[0]), squares))
    return out


def _base_rows(cells: DataFrame, parts: list[tuple], k: int) -> dict[tuple, tuple]:
    """Swapped roles: per (sample, component) of the ``b`` levels its base period,
    its share of the rows, and that period's count, column sums and counts per level of ``b``."""
    spark = cells.sparkSession
    named = cells.join(F.broadcast(spark.createDataFrame(parts, "s int, b int, c int")), ["s", "b"])
    spans = named.groupBy("s", "c").agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.sum("n").alias("n")).collect()
    total: dict = {}
    first: dict = {}
    for r in spans:
        total[r.s] = total.get(r.s, 0) + r.n
        first[r.s] = r.lo if r.s not in first else min(first[r.s], r.lo)
    bases = [(r.s, r.c, r.lo if r.lo == first[r.s] else r.hi, r.n / total[r.s]) for r in spans]
    kind = cells.schema["a"].dataType.simpleString()
    chosen = spark.createDataFrame([x[:3] for x in bases], f"s int, c int, a {kind}")
    rows = cells.join(F.broadcast(chosen), ["s", "a"]).collect()     # a few periods' cells
    out = {}
    for s, c, period, mass in bases:
        own = [r for r in rows if r.s == s and r.a == period]
        size = sum(r.n for r in own)
        out[s, c] = (period, mass, size, np.array([sum(r[z] for r in own) for z in sums(k)], float),
                     {r.b: r.n for r in own})
    return out


def numbered(cells: DataFrame, levels: list) -> DataFrame:
    """(b, i): the levels (DENSE_LEVELS at most) with their numbers, to be broadcast."""
    kind = cells.schema["b"].dataType.simpleString()
    return F.broadcast(cells.sparkSession.createDataFrame(list(zip(levels, range(len(levels)))), f"b {kind}, i int"))


def solve(cells: DataFrame, k: int, samples: int, swapped: bool, levels: list) -> list[Solved]:
    """Effects of every sample; ``cells`` (s, a, b, n, z0..) hold the given sorted levels of ``b``,
    DENSE_LEVELS at most; ``a`` is the period if ``swapped``, else the entity."""
    spark = cells.sparkSession
    kind = cells.schema["b"].dataType.simpleString()
    t = len(levels)
    cells = cells.join(numbered(cells, levels), "b").withColumn("b", F.col("i")).drop("i")
    facts = _cell_sums(cells, k, t, samples)
    here = [np.flatnonzero(f[2]) for f in facts]
    labels = [_components(facts[s][0][np.ix_(here[s], here[s])]) for s in range(samples)]
    bases = _base_rows(cells, [(s, int(b), int(c)) for s in range(samples) for b, c in zip(here[s], labels[s])],
                       k) if swapped else {}
    out = []
    for s in range(samples):
        matrix, cross, counts, raw, a_levels, squares_a = facts[s]
        own, label = here[s], labels[s]
        n = int(round(counts.sum()))
        share = counts[own] / n
        free = np.ones(len(own), bool)
        target = -share if swapped else share.copy()
        means, weight, squares = np.zeros(k), [], 0.0
        for c in np.unique(label):
            inside = np.flatnonzero(label == c)
            left = inside[0] if inside[0] == 0 else inside[-1]
            free[left] = False
            if swapped:
                period, mass, size, total, held = bases[s, int(c)]
                means += mass * total / size
                weight.append((period, mass / size))
                squares += mass * mass / size
                for b, m in held.items():
                    target[np.searchsorted(own, b)] += mass * m / size
            else:
                target[left] -= share[inside].sum()
        if not swapped:
            means = raw.sum(axis=0) / n
            weight, squares = [(None, 1.0 / n)], 1.0 / n
        found = np.zeros((t, k + 1))
        if free.any():
            at = own[free]
            found[at] = np.linalg.solve(matrix[np.ix_(at, at)], np.column_stack([cross[at], target[free]]))
        rho = found[own, k]
        table = spark.createDataFrame([(levels[b], *map(float, found[b])) for b in own],
                                      f"b {kind}, " + ", ".join(f"g{i} double" for i in range(k)) + ", rho double")
        per_entity = (raw[own] ** 2 / counts[own][:, None]).sum(axis=0) if swapped else squares_a
        sizes = (a_levels, len(own))
        out.append(Solved(n, sizes[swapped], sizes[not swapped], len(np.unique(label)),
                          means - cross[own].T @ rho, squares + float(rho @ target), weight,
                          per_entity - raw.sum(axis=0) ** 2 / n, table, found))
    return out


# --------------------------------------------------------------------------- many levels on both sides
def _landed_components(cells: DataFrame) -> DataFrame:
    """(b, c): the component of every level of ``b``, named by its smallest level; labels
    spread over the cells until none changes."""
    pairs = cells.select("a", "b").distinct()
    now = cut_lineage(pairs.select("b", F.col("b").alias("c")).distinct(), how="parquet")
    while True:
        at_a = pairs.join(now, "b").groupBy("a").agg(F.min("c").alias("c"))
        then = pairs.join(at_a, "a").groupBy("b").agg(F.min("c").alias("c"))
        then = cut_lineage(then.join(now.withColumnRenamed("c", "was"), "b"), how="parquet")
        changed = then.filter(F.col("c") != F.col("was")).limit(1).count()
        drop_scratch(now)
        now = then.drop("was")
        if not changed:
            return now


def _gradients(cells: DataFrame, right: DataFrame, q: int) -> DataFrame:
    """(b, x0..): S x = r for the columns r0.. of ``right`` (b, n, r0..), by conjugate
    gradients with S's diagonal counts as preconditioner.  Each right-hand side must add up to 0
    in every component."""
    cols = range(q)
    state = right.select("b", "n", *[F.lit(0.0).alias(f"x{j}") for j in cols], *[F.col(f"r{j}") for j in cols],
                         *[(F.col(f"r{j}") / F.col("n")).alias(f"p{j}") for j in cols])
    state = cut_lineage(state, how="parquet")
    rz = [v or 0.0 for v in state.agg(*[F.sum(F.col(f"r{j}") * F.col(f"p{j}")) for j in cols]).first()]
    goal = [v * CG_TOL ** 2 for v in rz]
    for _ in range(CG_ROUNDS):
        if all(v <= g for v, g in zip(rz, goal)):
            break
        p = state.select("b", *[f"p{j}" for j in cols])
        mean = cells.join(p, "b").groupBy("a").agg(*[(F.sum(F.col("n") * F.col(f"p{j}")) / F.sum("n")).alias(f"m{j}")
                                                     for j in cols])
        moved = cells.join(mean, "a").groupBy("b").agg(*[F.sum(F.col("n") * F.col(f"m{j}")).alias(f"m{j}") for j in cols])
        step = state.join(moved, "b").withColumns({f"m{j}": F.col("n") * F.col(f"p{j}") - F.col(f"m{j}") for j in cols})
        step = cut_lineage(step, how="parquet")
        got = step.agg(*[F.sum(F.col(f"p{j}") * F.col(f"m{j}")).alias(f"a{j}") for j in cols]).first()
        alpha = [rz[j] / got[f"a{j}"] if rz[j] > goal[j] and got[f"a{j}"] else 0.0 for j in cols]
        moved_on = step.withColumns({f"x{j}": F.col(f"x{j}") + alpha[j] * F.col(f"p{j}") for j in cols}) \
            .withColumns({f"r{j}": F.col(f"r{j}") - alpha[j] * F.col(f"m{j}") for j in cols})
        new = moved_on.agg(*[F.sum(F.col(f"r{j}") * F.col(f"r{j}") / F.col("n")) for j in cols]).first()
        beta = [new[j] / rz[j] if rz[j] > goal[j] else 0.0 for j in cols]
        after = moved_on.withColumns({f"p{j}": F.col(f"r{j}") / F.col("n") + beta[j] * F.col(f"p{j}") for j in cols})
        after = cut_lineage(after.drop(*[f"m{j}" for j in cols]), how="parquet")
        drop_scratch(step)
        drop_scratch(state)
        state, rz = after, [new[j] if rz[j] > goal[j] else 0.0 for j in cols]
    else:
        raise RuntimeError("two-way effects: conjugate gradients did not converge")
    return state.select("b", *[f"x{j}" for j in cols])


def solve_large(cells: DataFrame, k: int) -> Solved:
    """Effects of one sample with ``a`` the entity and ``b`` the period, however many of
    both: everything of a factor's size is a table."""
    parts = _landed_components(cells)
    cross = _cross(cells, k).drop("s")
    levels = cross.join(parts, "b")
    lowest = levels.select(F.min("b")).first()[0]
    span = levels.groupBy("c").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.sum("n").alias("mass"))
    span = span.withColumn("base", F.when(F.col("lo") == F.lit(lowest), F.col("lo")).otherwise(F.col("hi")))
    raw = cells.agg(F.sum("n").alias("n"), F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"),
                    *[F.sum(z).alias(z) for z in sums(k)]).first()
    n = raw.n
    target = (F.col("n") - F.when(F.col("b") == F.col("base"), F.col("mass")).otherwise(0)) / F.lit(float(n))
    right = cut_lineage(levels.join(span.drop("lo", "hi"), "c").select(
        "b", "n", *[F.col(f"z{i}").alias(f"r{i}") for i in range(k)], target.alias(f"r{k}")), how="parquet")
    found = _gradients(cells, right, k + 1)
    table = cut_lineage(found.select("b", *[F.col(f"x{i}").alias(f"g{i}") for i in range(k)],
                                     F.col(f"x{k}").alias("rho")), how="parquet")
    row = table.join(right, "b").agg(*[F.sum(F.col("rho") * F.col(f"r{i}")) for i in range(k + 1)]).first()
    total = np.array([raw[z] for z in sums(k)], float)
    squares = group_means(cells, k).agg(*[F.sum(F.col("na") * F.col(f"m{i}") * F.col(f"m{i}")) for i in range(k)]).first()
    return Solved(n, raw.a, raw.b, span.count(), total / n - np.array(row[:k], float), 1.0 / n + row[k],
                  [(None, 1.0 / n)], np.array(squares, float) - total ** 2 / n, table)
