"""Estimators (inventory E1-E11): OLS, absorbed fixed effects, within, event
studies, model grids, Wald tests, predictive margins and coefficient tables.

Data never reaches the driver.  A fit is:

1. listwise-complete sample on all model variables (M13), landed once;
2. design columns as JVM expressions (products, indicators of listed factors);
3. absorbed effects: entity means from one ``groupBy(entity)``, joined back (AQE
   broadcasts them when small, splits skewed partitions otherwise).  With a second
   effect (``time``) both are taken off by lookups of
   :mod:`panora.operators.effects`: no indicator column exists, so the row width does not
   depend on the number of periods, and the fit on an unbalanced panel is exact;
4. one moment pass: X'X, X'y, y'y, n and column sums (one ``agg`` of sum
   expressions for small designs, a ``mapInPandas`` partial Gram per
   partition summed by index for large ones);
5. k x k solve on the driver with term-order collinearity detection
   (omitted terms are reported, E11);
6. one more pass for the robust (HC1) meat, shared by every model of a grid.

A grid whose models have different listwise samples (missing values, NaN included) makes the
same passes once for all samples: every row carries a bit per sample.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.functions.dist import f_sf, stars, t_ppf, t_sf2
from panora.operators import effects as two_way
from panora.operators.effects import summed as _summed
from panora.sources.writers import cut_lineage, drop_scratch

AGG_MAX_COLS = 24          # up to this many design columns: one codegen'd agg
LISTED_LEVELS = 256        # a main-effect factor with more levels is an absorbed effect, not a list of terms
SAMPLE_BITS = 62           # samples told apart in one set of passes
COLLINEAR_TOL = 1e-9
NOISE_TOL = 1e-13          # within / total sum of squares that counts as rounding noise


class EmptySampleError(ValueError):
    """No row is complete on a model's variables."""


# --------------------------------------------------------------------------- formula
@dataclass(frozen=True)
class Term:
    name: str
    factors: tuple  # of ("v", col) or ("i", col, level)

    def expr(self, overrides: Mapping[str, object] | None = None) -> Column:
        out = None
        for f in self.factors:
            if overrides and f[1] in overrides:
                v = overrides[f[1]]
                c = F.lit(float(v == f[2]) if f[0] == "i" else float(v))
            elif f[0] == "i":
                c = (F.col(f[1]) == F.lit(f[2])).cast("double")
            else:
                c = F.col(f[1]).cast("double")
            out = c if out is None else out * c
        return out

    def sql(self) -> str:
        """The same product as a SQL expression (one JVM parse, not one call per operator)."""
        parts = []
        for f in self.factors:
            if f[0] == "i":
                parts.append(f"CAST((`{f[1]}` = {_sql_literal(f[2])}) AS DOUBLE)")
            else:
                parts.append(f"CAST(`{f[1]}` AS DOUBLE)")
        return " * ".join(parts)

    @property
    def variables(self) -> list[str]:
        return [f[1] for f in self.factors]


def _sql_literal(v) -> str:
    """A factor level as a SQL literal."""
    import datetime as _dt
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _strip(v: str) -> str:
    return v.split(".", 1)[1] if v[:2] in ("c.", "i.") else v


def parse_terms(terms: Sequence[str], levels: Mapping[str, Sequence] | None = None) -> list[Term]:
    """Expand Stata-like factor notation into design terms.

    ``x`` / ``c.x``: the column; ``i.g``: one indicator per level of g except
    the lowest (base) level, which needs ``levels[g]``; ``a#b``: products of
    the parts (an ``i.`` part expands into its non-base levels); ``a##b``: all
    main effects and interactions.  Duplicates keep their first position.
    """
    from itertools import product
    levels = levels or {}

    def alternatives(part: str) -> list[tuple]:
        if part.startswith("i."):
            g = part[2:]
            return [("i", g, lv) for lv in list(levels[g])[1:]]
        return [("v", _strip(part))]

    def fname(f: tuple) -> str:
        return f"{f[2]}.{f[1]}" if f[0] == "i" else f[1]

    out: dict[str, Term] = {}
    for t in terms:
        if "##" in t:
            parts = t.split("##")
            groups = [c for r in range(1, len(parts) + 1) for c in combinations(parts, r)]
        else:
            groups = [tuple(t.split("#"))]
        for g in groups:
            for combo in product(*[alternatives(p) for p in g]):
                nm = "#".join(fname(f) for f in combo)
                out.setdefault(nm, Term(nm, tuple(combo)))
    return list(out.values())


def factor_levels(df: DataFrame, var: str) -> list:
    """The sorted levels of a factor (one number of the driver per listed level)."""
    return [r[0] for r in df.select(var).where(F.col(var).isNotNull()).distinct().orderBy(var).collect()]


def _factor_vars(terms: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(p[2:] for t in terms for p in t.replace("##", "#").split("#")
                              if p.startswith("i.")))


def _raw_vars(terms: Sequence[str]) -> list[str]:
    out = []
    for t in terms:
        for p in t.replace("##", "#").split("#"):
            v = _strip(p)
            if v not in out:
                out.append(v)
    return out


# --------------------------------------------------------------------------- moments
def moments(df: DataFrame, cols: Sequence[str], sums: Sequence[str] = (),
            use_pandas: bool | None = None, squares: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray, int]:
    """(Z'Z over ``cols``, column sums over ``sums`` then sums of squares over
    ``squares``, n) computed on executors.

    Only the (p*(p+1)/2 + len(sums) + len(squares) + 1) numbers reach the driver.
    """
    cols, sums, squares = list(cols), list(sums), list(squares)
    p = len(cols)
    if use_pandas is None:
        use_pandas = p > AGG_MAX_COLS
    iu = np.triu_indices(p)
    if not use_pandas:
        ex = [F.count(F.lit(1)).alias("n")]
        ex += [F.expr(f"sum(`{cols[i]}` * `{cols[j]}`)") for i, j in zip(*iu)]
        ex += [F.expr(f"sum(`{c}`)") for c in sums] + [F.expr(f"sum(`{c}` * `{c}`)") for c in squares]
        row = df.agg(*ex).first()
        n = int(row[0])
        flat = np.array([v or 0.0 for v in row[1:]], dtype=float)
    else:
        names = list(dict.fromkeys(cols + sums + squares))
        si, qi = [names.index(c) for c in sums], [names.index(c) for c in squares]

        def part(it):
            g = np.zeros((p, p))
            sv, qv = np.zeros(len(si)), np.zeros(len(qi))
            n_ = 0
            for pdf in it:
                z = pdf[names].to_numpy(dtype=float)
                x = z[:, :p]
                g += x.T @ x
                sv += z[:, si].sum(axis=0)
                qv += np.einsum("ij,ij->j", z[:, qi], z[:, qi])
                n_ += len(pdf)
            return np.concatenate([[float(n_)], g[iu], sv, qv])

        flat = _summed(df.select(*names), part, 1 + len(iu[0]) + len(sums) + len(squares))
        n = int(round(flat[0]))
        flat = flat[1:]
    g = np.zeros((p, p))
    g[iu] = flat[:len(iu[0])]
    g = g + np.triu(g, 1).T
    return g, flat[len(iu[0]):], n


def block_grams(df: DataFrame, groups: Sequence[Sequence[str]], weights: Sequence[str | None] | None = None,
                max_agg_exprs: int = 300) -> list[np.ndarray]:
    """(w_g Z_g)'(w_g Z_g) for several column groups in one pass over ``df``.

    ``weights[g]`` names a column multiplying every column of group g (the
    residual for a robust meat), or is None.  One ``agg`` of sum-of-product
    expressions while the expression count is small (pure JVM codegen);
    otherwise one ``mapInPandas`` pass: one row of flattened blocks per
    partition, added up in two levels.
    """
    groups = [list(g) for g in groups]
    weights = list(weights) if weights is not None else [None] * len(groups)
    tri = [np.triu_indices(len(g)) for g in groups]
    sizes = [len(t[0]) for t in tri]
    if sum(sizes) <= max_agg_exprs:
        ex = []
        for k, (g, t, w) in enumerate(zip(groups, tri, weights)):
            ww = f" * `{w}` * `{w}`" if w else ""
            ex += [F.expr(f"sum(`{g[i]}` * `{g[j]}`{ww})").alias(f"b{k}_{i}_{j}") for i, j in zip(*t)]
        row = df.agg(*ex).first()
        flat = [np.array([row[f"b{k}_{i}_{j}"] or 0.0 for i, j in zip(*t)])
                for k, t in enumerate(tri)]
    else:
        names = list(dict.fromkeys([c for g in groups for c in g] + [w for w in weights if w]))
        pos = [[names.index(c) for c in g] for g in groups]
        wpos = [names.index(w) if w else None for w in weights]
        total = sum(sizes)

        def part(it):
            acc = [np.zeros((len(g), len(g))) for g in groups]
            for pdf in it:
                z = pdf[names].to_numpy(dtype=float)
                for k, idx in enumerate(pos):
                    x = z[:, idx]
                    if wpos[k] is not None:
                        x = x * z[:, [wpos[k]]]
                    acc[k] += x.T @ x
            return np.concatenate([a[t] for a, t in zip(acc, tri)])

        allv = _summed(df.select(*names), part, total)
        flat, o = [], 0
        for sz in sizes:
            flat.append(allv[o:o + sz])
            o += sz
    out = []
    for g, t, f in zip(groups, tri, flat):
        M = np.zeros((len(g), len(g)))
        M[t] = f
        out.append(M + np.triu(M, 1).T)
    return out


# --------------------------------------------------------------------------- algebra
def select_columns(g: np.ndarray, order: Sequence[int], tol: float = COLLINEAR_TOL,
                   raw: np.ndarray | None = None) -> list[int]:
    """Incremental Cholesky in ``order``; a column whose residual variance is
    below ``tol`` times its own sum of squares is dropped (later terms first).
    ``raw``: sums of squares about the grand mean, before demeaning; a column
    left with rounding noise of that size only (absorbed) is dropped as well."""
    kept: list[int] = []
    L = np.zeros((0, 0))
    for j in order:
        d = g[j, j]
        floor = 0.0 if raw is None else NOISE_TOL * float(raw[j])
        if d <= floor:
            continue
        if kept:
            c = g[np.ix_(kept, [j])].ravel()
            w = np.linalg.solve(L, c) if L.size else c
            r = d - float(w @ w)
        else:
            w = np.zeros(0)
            r = d
        if r <= max(tol * d, floor):
            continue
        k = len(kept)
        L2 = np.zeros((k + 1, k + 1))
        L2[:k, :k] = L
        L2[k, :k] = w
        L2[k, k] = math.sqrt(r)
        L = L2
        kept.append(j)
    return sorted(kept)


@dataclass
class Fit:
    model_id: str
    depvar: str
    terms: list[str]
    coef: np.ndarray           # slopes (0 for omitted), then _cons when present
    vcov: np.ndarray
    omitted: list[bool]
    n: int
    n_groups: int | None
    df_r: int
    k: int
    r2: float
    r2_adj: float
    r2_within: float | None
    rmse: float
    f: float | None
    f_p: float | None
    vce: str
    absorb: str | None
    has_cons: bool
    tests: list[dict] = field(default_factory=list)
    xbar: np.ndarray | None = None
    term_objs: list = field(default_factory=list)
    time: str | None = None
    effects: list | None = None  # (period, effect against the base period) of an absorbed second effect

    @property
    def names(self) -> list[str]:
        return self.terms + (["_cons"] if self.has_cons else [])

    def table_rows(self, level: float = 0.95) -> list[tuple]:
        crit = t_ppf(0.5 + level / 2.0, self.df_r) if self.df_r > 0 else float("nan")
        rows = []
        for i, nm in enumerate(self.names):
            om = self.omitted[i]
            b = float(self.coef[i])
            se = float(math.sqrt(self.vcov[i, i])) if not om and self.vcov[i, i] >= 0 else None
            if om or not se:
                rows.append((self.model_id, self.depvar, nm, 0.0 if om else b, None, None, None,
                             None, None, "", bool(om)))
                continue
            t = b / se
            p = t_sf2(t, self.df_r)
            rows.append((self.model_id, self.depvar, nm, b, se, t, p, b - crit * se, b + crit * se,
                         stars(p), False))
        return rows

    def stats_row(self) -> tuple:
        def num(v):
            return None if v is None else float(v)
        return (self.model_id, self.depvar, int(self.n),
                None if self.n_groups is None else int(self.n_groups),
                None if self.n_groups is None else int(self.n_groups) - 1, int(self.df_r),
                int(self.k), num(self.r2), num(self.r2_adj), num(self.r2_within), num(self.rmse),
                num(self.f), num(self.f_p), self.vce, self.absorb)


COEF_SCHEMA = ("model_id string, depvar string, term string, coef double, se double, t double, "
               "p double, ci_lo double, ci_hi double, stars string, omitted boolean")
STATS_SCHEMA = ("model_id string, depvar string, n long, n_groups long, df_a long, df_r long, "
                "k int, r2 double, r2_adj double, r2_within double, rmse double, f double, "
                "f_p double, vce string, absorb string")
TEST_SCHEMA = "model_id string, test string, q int, df_r long, f double, p double"


# --------------------------------------------------------------------------- core
@dataclass
class _Design:
    """What the moment and the meat pass read: columns __x{j}, __y{i} about the
    centres, __d__x{j}, __d__y{i} with the absorbed effects taken off, and __u, a row's
    weight in the constant (regressors aside)."""

    rows: DataFrame
    held: list = field(default_factory=list)     # persisted tables
    solved: two_way.Solved | None = None
    periods: list | None = None                  # (period, its effects on every column)


def _z_columns(terms: Sequence[Term], ys: Sequence[str], centres: Sequence[float]) -> list[str]:
    """Design columns, x then y, as SQL expressions about provisional centres, so that
    no later sum cancels."""
    return [f"({e}) - ({float(c)!r}D)"
            for e, c in zip([*[t.sql() for t in terms], *[f"CAST(`{y}` AS DOUBLE)" for y in ys]], centres)]


def _named(p_x: int, n_y: int, prefix: str = "__") -> list[str]:
    return [f"{prefix}x{j}" for j in range(p_x)] + [f"{prefix}y{i}" for i in range(n_y)]


def _centres(base: DataFrame, terms: Sequence[Term], ys: Sequence[str], keys: Sequence[str | None] = ()) -> tuple:
    """Means of the design columns over their numbers, the row count, and about how many levels the keys have."""
    row = base.selectExpr(*[f"avg(nanvl({t.sql()}, NULL))" for t in terms],
                          *[f"avg(nanvl(CAST(`{y}` AS DOUBLE), NULL))" for y in ys], "count(1)",
                          *[f"approx_count_distinct(`{c}`)" if c else "1" for c in keys]).first()
    k = len(terms) + len(ys)
    return np.array([0.0 if v is None or not math.isfinite(v) else float(v) for v in row[:k]]), row[k], row[k + 1:]


def _one_way(base: DataFrame, ys: Sequence[str], terms: Sequence[Term], absorb: str | None,
             materialize: bool, centres: Sequence[float]) -> _Design:
    """Demeaned by entity, or by the grand mean when nothing is absorbed.

    The per-entity means (one row per entity) are the only thing kept; the demeaned
    design is a join of two plain scans that both passes stream again, so no N x p
    copy is ever stored.
    """
    names = _named(len(terms), len(ys))
    key = f"`{absorb}`" if absorb else "0"
    z = base.selectExpr(f"{key} AS __g", *[f"{e} AS {n}" for n, e in zip(names, _z_columns(terms, ys, centres))])
    means = z.groupBy("__g").agg(*[F.expr(f"avg({n})").alias(f"__m{n}") for n in names],
                                 F.expr("1.0D / count(1)").alias("__inv"))
    if materialize:
        # kept after the first pass computes it (its lineage is a scan of the landed
        # sample, so a lost partition is cheap to recompute)
        means = means.persist(StorageLevel.MEMORY_AND_DISK)
    other = F.broadcast(means) if not absorb else means  # one row by construction
    d = z.join(other, "__g").selectExpr("__inv", "1.0D AS __u", *names, *[f"{n} - __m{n} AS __d{n}" for n in names])
    return _Design(d, [means])


def _two_way(base: DataFrame, ys: Sequence[str], terms: Sequence[Term], absorb: str | None, time: str,
             centres: Sequence[float], levels: Sequence[int]) -> _Design:
    """Both effects taken off by lookups: one per period, one per entity; ``levels``
    are about the numbers of entities and of periods."""
    names = _named(len(terms), len(ys))
    k = len(names)
    key = f"`{absorb}`" if absorb else "0"
    z = base.selectExpr(f"{key} AS e", f"`{time}` AS t",
                        *[f"{x} AS z{i}" for i, x in enumerate(_z_columns(terms, ys, centres))])
    cells = z.groupBy("e", "t").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in two_way.sums(k)])
    cells = cells.withColumn("s", F.lit(0)).persist(StorageLevel.MEMORY_AND_DISK)
    # the effect with fewer levels, about, is solved for; as a matrix where they are few enough
    most = two_way.DENSE_LEVELS
    swapped = levels[0] < levels[1]
    a, b = ("t", "e") if swapped else ("e", "t")
    values = [r.b for r in cells.select(F.col(b).alias("b")).distinct().limit(most + 1).collect()]
    large = len(values) > most
    if large:
        swapped, a, b = False, "e", "t"
    cells_ab = cells.withColumnsRenamed({a: "a", b: "b"})
    solved = two_way.solve_large(cells_ab, k) if large else two_way.solve(cells_ab, k, 1, swapped, sorted(values))[0]
    off = two_way.offsets(cells_ab, solved.table, k).drop("s").persist(StorageLevel.MEMORY_AND_DISK)
    table = solved.table if large else F.broadcast(solved.table)     # at most DENSE_LEVELS rows
    d = z.withColumnsRenamed({a: "a", b: "b"}).join(table, "b").join(off, "a")
    weight = F.lit(solved.weight[0][1]) if solved.weight[0][0] is None else \
        sum((F.when(F.col("a") == F.lit(p), w).otherwise(0.0) for p, w in solved.weight), F.lit(0.0))
    d = d.withColumn("w", weight).selectExpr("w - rho + rbar AS __u", *[f"z{i} AS {n}" for i, n in enumerate(names)],
                                             *[f"z{i} - g{i} - h{i} AS __d{n}" for i, n in enumerate(names)])
    listed = None
    if solved.components == 1 and solved.periods <= most and not large:
        if swapped:
            listed = sorted((r[0], np.array(r[1:], float)) for r in off.select("a", *[f"h{i}" for i in range(k)]).collect())
        else:
            listed = list(zip(sorted(values), solved.matrix[:, :k]))
        listed = [(v, x - listed[0][1]) for v, x in listed]
    return _Design(d, [cells, off], solved, listed)


def _solved_model(tidx: list[int], yj: int, g: np.ndarray, means: np.ndarray, kept: list[int], n: int, df_r: int,
                  vce: str, meat: np.ndarray | None, unit: float, squares: float) -> tuple:
    """Coefficients and variances of one model from the shared moment matrix ``g`` over [x of all models, y].

    Slopes and u'e have the bread diag(G^-1, unit); the constant, means[y] - means[x]'b, follows by
    the delta formula.  ``squares`` is the sum of the squared weights of the constant."""
    gxx, gxy = g[np.ix_(tidx, tidx)], g[tidx, yj]
    k = len(kept)
    b = np.zeros(len(tidx))
    D = np.zeros((k + 1, k + 1))
    if k:
        D[:k, :k] = np.linalg.inv(gxx[np.ix_(kept, kept)])
        b[kept] = np.linalg.solve(gxx[np.ix_(kept, kept)], gxy[kept])
    rss = max(float(g[yj, yj] - b @ gxy), 0.0)
    T = np.eye(k + 1)
    T[k, :k] = -means[tidx][kept]
    if vce == "robust":
        if meat is None:
            raise ValueError("robust VCE needs the meat matrix")
        D[k, k] = unit
        V = (n / df_r) * T @ D @ meat @ D @ T.T if df_r > 0 else np.full_like(D, np.nan)
    else:
        D[k, k] = squares
        V = (rss / df_r if df_r > 0 else float("nan")) * T @ D @ T.T
    full = np.zeros((len(tidx) + 1, len(tidx) + 1))
    at = kept + [len(tidx)]
    full[np.ix_(at, at)] = V
    omitted = [j not in kept for j in range(len(tidx))] + [False]
    return np.append(b, means[yj] - float(means[tidx] @ b)), full, omitted, rss


def _wald(b: np.ndarray, V: np.ndarray, idx: Sequence[int], df_r: int) -> tuple[float, float, int]:
    if not idx:
        return float("nan"), float("nan"), 0
    Rb = b[list(idx)]
    RVR = V[np.ix_(idx, idx)]
    try:
        stat = float(Rb @ np.linalg.solve(RVR, Rb)) / len(idx)
    except np.linalg.LinAlgError:
        stat = float(Rb @ np.linalg.pinv(RVR) @ Rb) / len(idx)
    return stat, f_sf(stat, len(idx), df_r), len(idx)


def robust_meats(d: DataFrame, p_x: int, n_y: int, prelim: Sequence[tuple],
                 max_agg_exprs: int = 300) -> list[np.ndarray]:
    """HC meat sum_i e_i^2 z_i z_i' with z = [x~_kept, u] for every model, one pass.

    ``prelim`` = [(outcome index, term indices, kept positions, slopes)].
    Small single-model designs use one JVM ``agg`` with the residual as a
    column expression; otherwise a ``mapInPandas`` pass computes all models'
    residuals and weighted Grams per batch with numpy (the slopes travel in
    the task closure) and emits only the flattened blocks.
    """
    layout = [[tidx[jl] for jl in kept] for (_, tidx, kept, _) in prelim]
    sizes = [(len(k) + 1) * (len(k) + 2) // 2 for k in layout]
    if sum(sizes) <= max_agg_exprs and len(prelim) <= 2:
        resid = [" - ".join([f"__d__y{yi}", *(f"({float(b[jl])!r}D) * __d__x{tidx[jl]}" for jl in kept)])
                 + f" AS __e{m}" for m, (yi, tidx, kept, b) in enumerate(prelim)]
        xcols = sorted({j for k in layout for j in k})
        w = d.selectExpr(*[f"__d__x{j}" for j in xcols], "__u", *resid)
        groups = [[f"__d__x{j}" for j in k] + ["__u"] for k in layout]
        return block_grams(w, groups, [f"__e{m}" for m in range(len(prelim))], max_agg_exprs)
    xnames = [f"__d__x{j}" for j in range(p_x)]
    ynames = [f"__d__y{i}" for i in range(n_y)]
    plan = [(yi, np.array([tidx[jl] for jl in kept], dtype=int),
             np.array([b[jl] for jl in kept], dtype=float)) for (yi, tidx, kept, b) in prelim]
    tris = [np.triu_indices(len(ix) + 1) for _, ix, _ in plan]
    total = sum(len(t[0]) for t in tris)

    def part(it):
        acc = [np.zeros((len(ix) + 1, len(ix) + 1)) for _, ix, _ in plan]
        for pdf in it:
            x = pdf[xnames].to_numpy(dtype=float)
            y = pdf[ynames].to_numpy(dtype=float)
            u = pdf[["__u"]].to_numpy(dtype=float)
            for k, (yi, ix, bk) in enumerate(plan):
                xm = x[:, ix]
                e = y[:, yi] - xm @ bk
                z = np.hstack([xm, u]) * e[:, None]
                acc[k] += z.T @ z
        return np.concatenate([a[t] for a, t in zip(acc, tris)])

    allv = _summed(d.select(*xnames, *ynames, "__u"), part, total)
    out, o = [], 0
    for (_, ix, _), t in zip(plan, tris):
        q = len(ix) + 1
        M = np.zeros((q, q))
        M[t] = allv[o:o + len(t[0])]
        o += len(t[0])
        out.append(M + np.triu(M, 1).T)
    return out


def _with_time(df: DataFrame, specs: Sequence[tuple], absorb: str | None, time: str | None) -> tuple[list, str | None, dict]:
    """(specs, time, levels): a factor with more than LISTED_LEVELS levels that every model has as a main effect
    only becomes the second absorbed effect."""
    specs = [(m, y, list(ts)) for m, y, ts in specs]
    levels = {}
    for g in _factor_vars([t for _, _, ts in specs for t in ts]):
        plain = all(f"i.{g}" in ts and not any(g in _raw_vars([t]) for t in ts if t != f"i.{g}") for _, _, ts in specs)
        if absorb and time is None and plain and \
                df.select(g).distinct().limit(LISTED_LEVELS + 1).count() > LISTED_LEVELS:
            time = g
            specs = [(m, y, [t for t in ts if t != f"i.{g}"]) for m, y, ts in specs]
        else:
            levels[g] = factor_levels(df, g)
    return specs, time, levels


def fit_many(df: DataFrame, specs: Sequence[tuple[str, str, Sequence[str]]], absorb: str | None = None,
             vce: str = "robust", tests: Mapping[str, Sequence[Sequence[str]]] | None = None,
             report_cons: bool = True, materialize: bool = True, time: str | None = None) -> list[Fit]:
    """Fit several linear models that share one estimation sample.

    ``specs`` = [(model_id, y, terms)]; the sample is listwise-complete on the
    union of all variables (as when models are estimated on a common sample).
    ``time``: a second effect beside ``absorb``, taken off without indicators; its levels
    are no terms (``Fit.effects`` holds them), count in k and df_r, and the constant belongs to the
    lowest level.  One design, one Gram over the union of terms and outcomes, one
    meat pass holding every model's robust sums.  Specs whose samples should
    differ (different missingness) go through :func:`grid`.
    """
    raw = _raw_vars([t for _, _, ts in specs for t in ts])
    ys = list(dict.fromkeys(y for _, y, _ in specs))
    keys = [c for c in (absorb, time) if c]
    base = df.select(*dict.fromkeys(ys + raw + keys)).dropna(how="any")
    if materialize:
        # the sample is read by the level scan, the moment pass and the meat
        # pass: write it once to the shared checkpoint folder, which also cuts
        # the lineage so every later plan is analysed against a plain scan
        base = cut_lineage(base, how="parquet")
    fits = _fit_sample(base, specs, absorb, vce, tests, report_cons, materialize, time)
    if materialize:
        drop_scratch(base)
    return fits


def _last_pivots(rows: np.ndarray) -> list[int]:
    """The last places with a part in the rows, one per independent row: an echelon form from the right."""
    pivots: list[int] = []
    done: list[np.ndarray] = []
    for row in rows:
        size = np.abs(row).max(initial=0.0)
        for r, p in zip(done, pivots):
            row = row - row[p] * r
        some = np.flatnonzero(np.abs(row) > 1e-9 * size)
        if len(some):
            row = row / row[some[-1]]
            done = [r - r[some[-1]] * row for r in done]
            pivots.append(int(some[-1]))
            done.append(row)
    return sorted(pivots)


def _union(specs: Sequence[tuple], levels: dict) -> tuple[list[Term], list[list[int]]]:
    """Distinct terms of all models, and every model's places among them."""
    union: dict[Term, int] = {}
    return union, [[union.setdefault(t, len(union)) for t in parse_terms(ts, levels)] for _, _, ts in specs]


def _fit_sample(base: DataFrame, specs, absorb, vce, tests, report_cons, materialize, time) -> list[Fit]:
    """All models on the complete rows of ``base``."""
    specs, time, levels = _with_time(base, specs, absorb, time)
    places, per_model = _union(specs, levels)
    union, ys = list(places), list(dict.fromkeys(y for _, y, _ in specs))
    p_x, n_y = len(union), len(ys)
    centres, rows, sizes = _centres(base, union, ys, (absorb, time) if time else ())
    if not rows:
        raise EmptySampleError(f"no complete rows for {sorted({m for m, _, _ in specs})}")
    design = _two_way(base, ys, union, absorb, time, centres, sizes) if time is not None else \
        _one_way(base, ys, union, absorb, materialize, centres)
    extra = [] if design.solved else ["__inv"]
    cols = _named(p_x, n_y)
    g, sums, n = moments(design.rows, _named(p_x, n_y, "__d__"), cols + extra, squares=cols)
    width = p_x + n_y
    mean = sums[:width] / n
    total_ss = sums[width + len(extra):] - sums[:width] ** 2 / n     # about the grand mean
    if design.solved:
        s = design.solved
        groups, more, unit, squares = s.groups, s.periods - s.components, 1.0, s.squares
        means, within = centres + s.means, total_ss - s.between
    else:
        # each group contributes n_i * (1 / n_i) = 1 to the sum of __inv
        groups, more, unit, squares = int(round(sums[width])) if absorb else 1, 0, 1.0 / n, 1.0 / n
        means, within = centres + mean, np.diag(g)
    held = [j for j in range(p_x) if design.solved and design.periods and g[j, j] <= NOISE_TOL * total_ss[j]
            and within[j] > COLLINEAR_TOL * total_ss[j] and np.ptp([v[j] for _, v in design.periods]) > 0]
    if held:
        # terms that the period effects hold come before them: they stay, and for each a period has no
        # effect of its own (joins the base period), in the models that have the term
        for table in design.held:
            table.unpersist()
        fits: list = [None] * len(specs)
        for own_held in dict.fromkeys(tuple(j for j in held if j in tidx) for tidx in per_model):
            own = [i for i, tidx in enumerate(per_model) if tuple(j for j in held if j in tidx) == own_held]
            joining = _last_pivots(np.array([[v[j] for _, v in design.periods] for j in own_held]))
            values = [design.periods[i][0] for i in joining]
            at = time if not values else f"__{time}"
            here = base if not values else base.withColumn(at, F.when(
                F.col(time).isin(values), F.lit(design.periods[0][0])).otherwise(F.col(time)))
            for i, fit in zip(own, _fit_sample(here, [specs[i] for i in own], absorb, vce, tests, report_cons,
                                               materialize, at)):
                fit.time = time
                if fit.effects is not None:
                    fit.effects = sorted([*fit.effects, *((v, fit.effects[0][1]) for v in values)])
                fits[i] = fit
        return fits
    prelim = []
    for (_, y, _), tidx in zip(specs, per_model):
        gxx = g[np.ix_(tidx, tidx)]
        kept = select_columns(gxx, list(range(len(tidx))), raw=total_ss[tidx])
        b = np.zeros(len(tidx))
        if kept:
            b[kept] = np.linalg.solve(gxx[np.ix_(kept, kept)], g[tidx, p_x + ys.index(y)][kept])
        prelim.append((ys.index(y), tidx, kept, b))
    meats = robust_meats(design.rows, p_x, n_y, prelim) if vce == "robust" else [None] * len(specs)
    fits = []
    for spec, (yi, tidx, kept, b), meat in zip(specs, prelim, meats):
        fits.append(_fitted(spec, tidx, p_x + yi, union, g, means, kept, n, groups, more, vce, meat, unit, squares,
                            total_ss, within, absorb, time, tests, report_cons, design.periods))
    for table in design.held:
        table.unpersist()
    return fits


def _fitted(spec, tidx, yj, union, g, means, kept, n, groups, more, vce, meat, unit, squares, total_ss, within,
            absorb, time, tests, report_cons, periods) -> Fit:
    """One model's Fit; ``more`` counts the levels of a second absorbed effect."""
    mid, y, _ = spec
    k = len(kept) + more
    df_r = n - groups - k
    coef, V, omitted, rss = _solved_model(tidx, yj, g, means, kept, n, df_r, vce, meat, unit, squares)
    tss = float(total_ss[yj])
    r2 = 1.0 - rss / tss if tss > 0 else float("nan")
    names = [union[j].name for j in tidx]
    f, fp, _ = _wald(coef, V, [j for j in range(len(tidx)) if not omitted[j]], df_r)
    fit = Fit(mid, y, names, coef, V, omitted, n, groups if absorb else None, df_r, k, r2,
              1.0 - (1.0 - r2) * (n - 1) / df_r if df_r > 0 else float("nan"),
              1.0 - rss / within[yj] if absorb and within[yj] > 0 else None,
              math.sqrt(rss / df_r) if df_r > 0 else float("nan"), f, fp, vce, absorb, True,
              xbar=means[tidx], term_objs=[union[j] for j in tidx], time=time)
    if periods is not None:
        slopes = coef[:-1]
        fit.effects = [(p, float(v[yj] - v[tidx] @ slopes)) for p, v in periods]
    for name, of in (tests or {}).get(mid) or []:
        ids = [names.index(t) for t in of if t in names and not omitted[names.index(t)]]
        st, pv, q = _wald(coef, V, ids, df_r)
        fit.tests.append({"test": name, "q": q, "f": st, "p": pv})
    if not report_cons:
        fit.has_cons = False
        fit.coef, fit.vcov, fit.omitted = coef[:-1], V[:-1, :-1], omitted[:-1]
    return fit


# --------------------------------------------------------------------------- public API
def ols(df: DataFrame, y: str, terms: Sequence[str], vce: str = "classic",
        model_id: str = "ols") -> Fit:
    """OLS with intercept; ``vce`` = "classic" or "robust" (HC1)."""
    return fit_many(df, [(model_id, y, terms)], absorb=None, vce=vce)[0]


def areg(df: DataFrame, y: str, terms: Sequence[str], absorb: str, vce: str = "robust",
         model_id: str = "areg", tests: Sequence[tuple[str, Sequence[str]]] | None = None,
         time: str | None = None) -> Fit:
    """Absorbed one-way FE, with ``time`` the two-way model.

    df_r = N - G - k, HC1 factor N / df_r, R2 overall, ``_cons`` = ybar - xbar'b.
    ``time`` takes period effects off without indicator columns, for any number of
    periods; a short ``i.period`` term lists them with standard errors instead (above
    LISTED_LEVELS levels it is taken as ``time``).
    """
    return fit_many(df, [(model_id, y, terms)], absorb=absorb, vce=vce,
                    tests={model_id: tests or []}, time=time)[0]


def within(df: DataFrame, y: str, xs: Sequence[str], entity: str, time: str | None = None,
           effect: str = "individual", model_id: str = "within") -> Fit:
    """``plm`` within estimator, classical SE; no intercept reported."""
    return fit_many(df, [(model_id, y, list(xs))], absorb=entity, vce="classic", report_cons=False,
                    time=time if effect == "twoways" else None)[0]


def grid(df: DataFrame, outcomes: Sequence[str], moderators: Sequence[str],
         make_terms, absorb: str | None, vce: str = "robust", tests=None, time: str | None = None) -> list[Fit]:
    """Outcomes x moderators (x specifications) grid, each model on its own
    listwise sample.

    ``make_terms(outcome, moderator) -> terms``, or a mapping of
    specification name -> such a function (model ids then start with the
    name).  A row carries one bit per distinct set of model variables that is complete
    on it (neither NULL nor NaN); sets complete on the same rows are one sample.  All samples
    share one landed base and the same passes over it: cells with their bits, one Gram and one meat pass
    that add up every sample's sums.  Models with listed factors (``i.``) on differing samples
    are fitted sample by sample, since their terms depend on it.
    """
    makers = make_terms if isinstance(make_terms, Mapping) else {None: make_terms}
    specs = [((f"{nm}|" if nm else "") + f"{o}|{m}", o, list(mk(o, m)))
             for nm, mk in makers.items() for o in outcomes for m in moderators]
    tmap = {s[0]: (tests(s) if callable(tests) else (tests or [])) for s in specs}
    keys = [c for c in (absorb, time) if c]
    fits = {}
    needs = {s[0]: frozenset([s[1], *_raw_vars(s[2])]) for s in specs}
    distinct = list(dict.fromkeys(needs.values()))
    for lo in range(0, len(distinct), SAMPLE_BITS):
        some = distinct[lo:lo + SAMPLE_BITS]
        own = [s for s in specs if needs[s[0]] in some]
        for f in _grid_block(df, own, [some.index(needs[s[0]]) for s in own], some, keys, absorb, vce, tmap, time):
            fits[f.model_id] = f
    return [fits[s[0]] for s in specs]


def _complete(df: DataFrame, names) -> str:
    """SQL condition: none of the columns is missing (NULL or NaN)."""
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    return " AND ".join(f"`{v}` IS NOT NULL" + (f" AND NOT isnan(`{v}`)" if v in floats else "")
                        for v in sorted(names)) or "TRUE"


def _grid_block(df, specs, bits, needs, keys, absorb, vce, tests, time) -> list[Fit]:
    """Models whose variable sets are ``needs`` (one bit each)."""
    sig = " | ".join(f"(CASE WHEN {_complete(df, need)} THEN shiftleft(1L, {i}) ELSE 0L END)" for i, need in enumerate(needs))
    allv = list(dict.fromkeys([*keys, *(v for need in needs for v in sorted(need))]))
    base = df.selectExpr(*[f"`{v}`" for v in allv], f"{sig} AS __sig").filter(F.expr(f"__sig <> 0 AND {_complete(df, keys)}"))
    base = cut_lineage(base, how="parquet")
    has = [F.col("__sig").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(needs))]
    n, *counts = base.agg(F.count(F.lit(1)), *[F.count_if(h) for h in has]).first()
    for i, c in enumerate(counts):
        if not c:
            raise EmptySampleError(f"no complete rows for {[s[0] for s, b in zip(specs, bits) if b == i]}")
    # sets of variables that are complete on the same rows make one sample
    same = [(i, j) for i in range(len(needs)) for j in range(i) if counts[i] == counts[j] and counts[i] < n]
    apart = base.agg(*[F.count_if(has[i] != has[j]) for i, j in same]).first() if same else []
    sample = list(range(len(needs)))
    for i in range(len(needs)):
        sample[i] = next((sample[j] for j in range(i) if counts[i] == counts[j] == n), i)
    for (i, j), d in zip(same, apart):
        if not d:
            sample[i] = min(sample[i], sample[j])
    kinds = sorted(set(sample))
    groups = {k: [s for s, b in zip(specs, bits) if sample[b] == k] for k in kinds}
    fits = None
    if len(kinds) > 1 and not _factor_vars([t for s in specs for t in s[2]]):
        fits = _fit_samples(base, groups, kinds, absorb, vce, tests, time)
    if fits is None:
        fits = []
        for k, own in groups.items():
            use = list(dict.fromkeys([*keys, *(v for s in own for v in [s[1], *_raw_vars(s[2])])]))
            fits += _fit_sample(base.filter(has[k]).select(*use), own, absorb, vce, tests, True, True, time)
    drop_scratch(base)
    return fits


def _fit_samples(base: DataFrame, groups: dict, kinds: list[int], absorb, vce, tests, time) -> list[Fit] | None:
    """The models of several samples, told apart by their bits, in the passes of one: cells,
    Gram, meat.  None where both effects have too many levels for a matrix."""
    specs = [s for k in kinds for s in groups[k]]
    at = [i for i, k in enumerate(kinds) for _ in groups[k]]
    places, per_model = _union(specs, {})
    union, ys = list(places), list(dict.fromkeys(y for _, y, _ in specs))
    p_x, n_y, S = len(union), len(ys), len(kinds)
    K = p_x + n_y
    z_names = two_way.sums(K)
    centres, _, sizes = _centres(base, union, ys, (absorb, time) if time else ())
    use = [sorted({j for m, i in zip(range(len(specs)), at) if i == s for j in [*per_model[m], p_x + ys.index(specs[m][1])]})
           for s in range(S)]
    bit = " | ".join(f"(CASE WHEN __sig & {1 << k}L <> 0 THEN shiftleft(1L, {i}) ELSE 0L END)" for i, k in enumerate(kinds))
    z = base.selectExpr(f"`{absorb}` AS e" if absorb else "0 AS e", f"`{time}` AS t" if time else "0 AS t", f"{bit} AS sig",
                        *[f"nanvl({x}, NULL) AS {c}" for x, c in zip(_z_columns(union, ys, centres), z_names)])
    cells = z.groupBy("e", "t", "sig").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in z_names])
    own = F.filter(F.sequence(F.lit(0), F.lit(S - 1)), lambda i: F.expr("sig").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
    cells = cells.select(F.explode(own).alias("s"), "e", "t", "n", *z_names).groupBy("s", "e", "t").agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in z_names])
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    solved = None
    if time:
        swapped = sizes[0] < sizes[1]
        a, b = ("t", "e") if swapped else ("e", "t")
        ab = cells.withColumnsRenamed({a: "a", b: "b"})
        levels = sorted(r.b for r in ab.select("b").distinct().limit(two_way.DENSE_LEVELS + 1).collect())
        if len(levels) > two_way.DENSE_LEVELS:
            cells.unpersist()
            return None
        solved = two_way.solve(ab, K, S, swapped, levels)
        tables = solved[0].table.withColumn("s", F.lit(0))
        for i in range(1, S):
            tables = tables.unionByName(solved[i].table.withColumn("s", F.lit(i)))
        off = two_way.offsets(ab, F.broadcast(tables), K)           # S x DENSE_LEVELS rows at most
        found = np.array([x.matrix for x in solved])
        z = z.withColumnsRenamed({a: "a", b: "b"})
        rows = z.join(two_way.numbered(z, levels), "b")
        ns, between = [x.n for x in solved], [x.between for x in solved]
    else:
        means = two_way.group_means(cells.withColumnRenamed("e", "a"), K)
        off = means.select("s", "a", *[F.col(f"m{i}").alias(f"h{i}") for i in range(K)], F.lit(0.0).alias("rbar"))
        found = np.zeros((S, 1, K + 1))
        rows = z.withColumnRenamed("e", "a").withColumn("i", F.lit(0))
        facts = {r.s: r for r in means.groupBy("s").agg(
            F.count(F.lit(1)).alias("levels"), F.sum("na").alias("n"), *[F.sum(F.col("na") * F.col(f"m{i}")) for i in range(K)],
            *[F.sum(F.col("na") * F.col(f"m{i}") * F.col(f"m{i}")) for i in range(K)]).collect()}
        ns = [int(facts[s].n) for s in range(S)]
        mean = [np.array(facts[s][3:3 + K], float) / ns[s] for s in range(S)]
        between = [np.array(facts[s][3 + K:], float) - ns[s] * mean[s] ** 2 for s in range(S)]

    def weight(s: int) -> Column:
        if not solved:
            return F.lit(1.0 / ns[s])
        w = solved[s].weight
        return F.lit(w[0][1]) if w[0][0] is None else \
            sum((F.when(F.col("a") == F.lit(p), x).otherwise(0.0) for p, x in w), F.lit(0.0))

    # per level of a, every sample's offsets of the columns it uses, then u's part
    wide = off.groupBy("a").agg(*[
        F.first(F.when(F.col("s") == s, F.array(*[f"h{i}" for i in use[s]], (F.col("rbar") + weight(s)).alias("w"))),
                ignorenulls=True).alias(f"o{s}") for s in range(S)])
    wide = wide.select("a", *[F.coalesce(f"o{s}", F.array_repeat(F.lit(0.0), len(use[s]) + 1)).alias(f"o{s}")
                              for s in range(S)]).persist(StorageLevel.MEMORY_AND_DISK)
    rows = rows.join(wide, "a").select("sig", "i", *z_names, *[f"o{s}" for s in range(S)])

    def residuals(pdf, s):
        """Two-way residuals of the columns sample s uses, and u, of its rows; the raw columns."""
        ok = (pdf["sig"].to_numpy() >> s) & 1 == 1
        raw = pdf[[z_names[j] for j in use[s]]].to_numpy(dtype=float)[ok]
        if not len(raw):
            return raw, raw, np.zeros(0)
        i = pdf["i"].to_numpy()[ok]
        o = np.stack(pdf[f"o{s}"].to_numpy()[ok])
        return raw, raw - found[s][i][:, use[s]] - o[:, :-1], o[:, -1] - found[s][i, K]

    tri = [np.triu_indices(len(u)) for u in use]

    def gram(it):
        acc = [np.zeros((len(u), len(u))) for u in use]
        first = [np.zeros((2, len(u))) for u in use]
        for pdf in it:
            for s in range(S):
                raw, d, _ = residuals(pdf, s)
                acc[s] += d.T @ d
                first[s] += [raw.sum(axis=0), (raw * raw).sum(axis=0)]
        return np.concatenate([np.concatenate([x[t], f.ravel()]) for x, t, f in zip(acc, tri, first)])

    flat = _summed(rows, gram, sum(len(t[0]) + 2 * len(u) for t, u in zip(tri, use)))
    grams, totals, o = [], [], 0
    for t, u in zip(tri, use):
        m = np.zeros((K, K))
        own_ = np.zeros((len(u), len(u)))
        own_[t] = flat[o:o + len(t[0])]
        m[np.ix_(u, u)] = own_ + np.triu(own_, 1).T
        o += len(t[0])
        tot = np.zeros((2, K))
        tot[:, u] = flat[o:o + 2 * len(u)].reshape(2, -1)
        o += 2 * len(u)
        grams.append(m)
        totals.append(tot)
    total_ss = [t[1] - t[0] ** 2 / ns[s] for s, t in enumerate(totals)]
    # models with a term that the period effects hold are fitted on their own (see _fit_sample)
    apart = [bool(solved) and any(grams[s][j, j] <= NOISE_TOL * total_ss[s][j] and total_ss[s][j] - between[s][j] >
                                  COLLINEAR_TOL * total_ss[s][j] for j in tidx) for tidx, s in zip(per_model, at)]
    singles: list[Fit] = []
    for s in sorted({s for s, x in zip(at, apart) if x}):
        own = [m for m, i, x in zip(specs, at, apart) if x and i == s]
        here = base.filter(F.col("__sig").bitwiseAND(F.lit(1 << kinds[s])) != 0)
        singles += _fit_sample(here, own, absorb, vce, tests, True, True, time)
    specs, per_model, at = ([v for v, x in zip(vs, apart) if not x] for vs in (specs, per_model, at))
    plan, prelim = [], []
    for (_, y, _), tidx, s in zip(specs, per_model, at):
        yj = p_x + ys.index(y)
        gxx = grams[s][np.ix_(tidx, tidx)]
        kept = select_columns(gxx, list(range(len(tidx))), raw=total_ss[s][tidx])
        b_ = np.linalg.solve(gxx[np.ix_(kept, kept)], grams[s][tidx, yj][kept]) if kept else np.zeros(0)
        prelim.append((kept, yj))
        plan.append((s, use[s].index(yj), [use[s].index(tidx[j]) for j in kept], b_))
    meats: list = [None] * len(specs)
    if vce == "robust" and plan:
        mtri = [np.triu_indices(len(p[2]) + 1) for p in plan]

        def meat(it):
            acc = [np.zeros((len(p[2]) + 1, len(p[2]) + 1)) for p in plan]
            for pdf in it:
                seen: dict = {}
                for m, (s, y_, xs, b_) in enumerate(plan):
                    if s not in seen:
                        seen[s] = residuals(pdf, s)
                    _, d, u = seen[s]
                    x = d[:, xs]
                    w = np.hstack([x, u[:, None]]) * (d[:, y_] - x @ b_)[:, None]
                    acc[m] += w.T @ w
            return np.concatenate([x[t] for x, t in zip(acc, mtri)])

        flat, o = _summed(rows, meat, sum(len(t[0]) for t in mtri)), 0
        for m, t in enumerate(mtri):
            q = np.zeros((len(plan[m][2]) + 1,) * 2)
            q[t] = flat[o:o + len(t[0])]
            o += len(t[0])
            meats[m] = q + np.triu(q, 1).T
    fits = []
    for spec, tidx, s, (kept, yj), meat_ in zip(specs, per_model, at, prelim, meats):
        if solved:
            x = solved[s]
            groups_, more, squares, means = x.groups, x.periods - x.components, x.squares, centres + x.means
        else:
            groups_, more, squares, means = int(facts[s].levels), 0, 1.0 / ns[s], centres + mean[s]
        fits.append(_fitted(spec, tidx, yj, union, grams[s], means, kept, ns[s], groups_, more, vce, meat_, 1.0, squares,
                            total_ss[s], total_ss[s] - between[s], absorb, time, tests, True, None))
    cells.unpersist()
    wide.unpersist()
    return fits + singles


def event_study(df: DataFrame, y: str, dummies: Sequence[str], absorb: str,
                period: str | None = None, extra: Sequence[str] = (), vce: str = "robust",
                event_times: Sequence[int] | None = None, level: float = 0.95,
                model_id: str = "event", group: str | None = None) -> tuple[Fit, list[tuple]]:
    """E5: regression on lead/lag dummies; returns the fit and the coefficient
    path [(series, event_time, term, coef, se, lo, hi)].

    With ``group`` every dummy is also interacted with the group indicator
    (``(b5-a5)##g``): series "base" is the path of the reference group and
    series "diff" the difference of the group's path.
    """
    inter = [f"{d}#{group}" for d in dummies] if group else []
    fit = areg(df, y, list(dummies) + inter + list(extra), absorb, vce, model_id, time=period)
    rows = {r[2]: r for r in fit.table_rows(level)}
    path = []
    for series, names in (("base", list(dummies)), ("diff", inter)):
        for i, d in enumerate(names):
            r = rows[d]
            et = event_times[i] if event_times is not None else i
            path.append((series, et, d, r[3], r[4], r[7], r[8]))
    return fit, path


def margins(df: DataFrame, fit: Fit, at: Mapping[str, Sequence], level: float = 0.95) -> list[tuple]:
    """Predictive margins at fixed values (``margins g, at(t=(1 2 3))``).

    ``at`` maps each overwritten variable to its values; every combination is
    evaluated.  The design row is averaged over the estimation sample with
    those variables overwritten (one aggregation for all combinations);
    margin = a'b, SE = sqrt(a'Va) (delta method, covariates held as observed).
    """
    from itertools import product
    terms = fit.term_objs
    raw = list(dict.fromkeys([fit.depvar] + [v for t in terms for v in t.variables]
                             + ([fit.absorb] if fit.absorb else [])))
    sample = df.select(*raw).dropna(how="any")
    keys = list(at)
    combos = list(product(*[at[k] for k in keys]))
    ex = [F.avg(t.expr(dict(zip(keys, combo)))).alias(f"a{ci}_{j}")
          for ci, combo in enumerate(combos) for j, t in enumerate(terms)]
    row = sample.agg(*ex).first()
    crit = t_ppf(0.5 + level / 2.0, fit.df_r)
    b = fit.coef
    out = []
    for ci, combo in enumerate(combos):
        a = np.array([row[f"a{ci}_{j}"] for j in range(len(terms))] + ([1.0] if fit.has_cons else []))
        mval = float(a @ b)
        se = float(math.sqrt(max(a @ fit.vcov @ a, 0.0)))
        out.append((*combo, mval, se, mval - crit * se, mval + crit * se))
    return out


# --------------------------------------------------------------------------- E10
def coef_table(spark, fits: Sequence[Fit], level: float = 0.95) -> DataFrame:
    """Long coefficient table: one row per (model, term)."""
    rows = [r for f in fits for r in f.table_rows(level)]
    return spark.createDataFrame(rows, COEF_SCHEMA)


def stats_table(spark, fits: Sequence[Fit]) -> DataFrame:
    return spark.createDataFrame([f.stats_row() for f in fits], STATS_SCHEMA)


def tests_table(spark, fits: Sequence[Fit]) -> DataFrame:
    rows = [(f.model_id, t["test"], int(t["q"]), int(f.df_r), float(t["f"]), float(t["p"]))
            for f in fits for t in f.tests]
    return spark.createDataFrame(rows, TEST_SCHEMA)


def wide_table(coefs: DataFrame, models: Sequence[str] | None = None, digits: int = 3) -> DataFrame:
    """Wide layout: one row per term, one ``coef (se) stars`` cell per model."""
    cell = F.when(F.col("omitted"), F.lit("(omitted)")).otherwise(
        F.concat(F.format_number("coef", digits), F.col("stars"), F.lit(" ("),
                 F.format_number("se", digits), F.lit(")")))
    c = coefs.withColumn("__cell", cell)
    models = models or [r[0] for r in coefs.select("model_id").distinct().orderBy("model_id").collect()]
    return c.groupBy("term").pivot("model_id", list(models)).agg(F.first("__cell"))
