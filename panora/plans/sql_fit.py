"""SQL twins of linear fits: absorbed (or plain) least squares with HC1 or
classical standard errors, for any list of regressors.

Rows carry their regressors (terms, then indicators of all but the lowest
period) and the outcome as one list.  The list is demeaned by entity, its Gram
matrix is swept pivot by pivot (a recursive query; pivots without variation are left out, which is the
omission rule), and a last pass over the rows adds up the robust sums.
"""

from __future__ import annotations

from collections.abc import Sequence


def chain(tag: str, rows: str, terms: Sequence[str], y: str, entity: str | None, period: str | None = None) -> str:
    """CTEs ``{tag}_*`` of one fit over the relation ``rows``; the last one,
    ``{tag}_u``, has one row per observation and target (number i, 0 the constant)."""
    g = entity or "0"
    need = " AND ".join(f"{v} IS NOT NULL" for v in dict.fromkeys([*terms, y, *([entity] if entity else [])]))
    dummies = (f"list_transform((SELECT list(DISTINCT {period} ORDER BY {period})[2:] FROM {rows} WHERE {need}), "
               f"lambda v: CAST({period} = v AS DOUBLE))") if period else "[]::DOUBLE[]"
    t = tag
    return f"""{t}_r AS MATERIALIZED (SELECT {g} AS g, list_concat(list_concat([{', '.join(f'CAST({x} AS DOUBLE)' for x in terms)}]::DOUBLE[],
    {dummies}), [CAST({y} AS DOUBLE)]) AS z FROM {rows} WHERE {need}),
  {t}_p AS (SELECT max(len(z)) AS w, count(*) AS n, count(DISTINCT g) AS groups FROM {t}_r),
  {t}_i AS (SELECT CAST(unnest(range(1, w + 1)) AS INTEGER) AS i FROM {t}_p),
  {t}_m AS MATERIALIZED (SELECT g, list(a ORDER BY i) AS m FROM (SELECT g, i, avg(z[i]) AS a FROM {t}_r, {t}_i GROUP BY g, i) GROUP BY g),
  {t}_d AS MATERIALIZED (SELECT row_number() OVER () AS o, z, list_transform(range(1, len(z) + 1), lambda k: z[k] - m[k]) AS d
    FROM {t}_r JOIN {t}_m USING (g)),
  {t}_a AS MATERIALIZED (SELECT list(a ORDER BY i) AS mean, list(s ORDER BY i) AS total FROM
    (SELECT i, avg(z[i]) AS a, var_pop(z[i]) * count(*) AS s FROM {t}_r, {t}_i GROUP BY i)),
  {t}_g AS MATERIALIZED (SELECT list(row_ ORDER BY i) AS gm FROM (SELECT i, list(v ORDER BY j) AS row_ FROM
    (SELECT a.i, b.i AS j, sum(d[a.i] * d[b.i]) AS v FROM {t}_d, {t}_i a, {t}_i b GROUP BY a.i, b.i) GROUP BY i)),
  {t}_s(k, s, kept) AS (SELECT 0, gm, []::BOOLEAN[] FROM {t}_g
    UNION ALL SELECT k + 1, CASE WHEN ok THEN list_transform(range(1, len(s) + 1), lambda i: list_transform(range(1, len(s) + 1),
        lambda j: CASE WHEN i = k + 1 AND j = k + 1 THEN -1 / s[k + 1][k + 1] WHEN i = k + 1 OR j = k + 1 THEN s[i][j] / s[k + 1][k + 1]
          ELSE s[i][j] - s[i][k + 1] * s[k + 1][j] / s[k + 1][k + 1] END)) ELSE s END, list_append(kept, ok)
    FROM (SELECT *, s[k + 1][k + 1] > greatest(1e-9 * (SELECT gm[k + 1][k + 1] FROM {t}_g),
        1e-13 * (SELECT total[k + 1] FROM {t}_a)) AS ok FROM {t}_s) WHERE k + 1 < len(s)),
  {t}_f AS MATERIALIZED (SELECT s, kept, w, n, groups, len(list_filter(kept, lambda x: x)) AS k,
      n - {'groups' if entity else '1'} - len(list_filter(kept, lambda x: x)) AS df_r, s[w][w] AS rss, total[w] AS tss, gm[w][w] AS within_ss, mean
    FROM {t}_s, {t}_p, {t}_a, {t}_g WHERE {t}_s.k = w - 1),
  {t}_e AS MATERIALIZED (SELECT o, d, d[w] - list_sum(list_transform(range(1, w), lambda i: CASE WHEN kept[i] THEN s[i][w] * d[i] ELSE 0 END)) AS e
    FROM {t}_d, {t}_f),
  {t}_t AS MATERIALIZED (SELECT o, e, i, list_sum(list_transform(range(1, w), lambda j: CASE WHEN kept[i] AND kept[j] THEN -s[i][j] * d[j] ELSE 0 END)) AS u
    FROM {t}_e, {t}_f, {t}_i WHERE i < w),
  {t}_u AS MATERIALIZED (SELECT o, e, i, u FROM {t}_t UNION ALL SELECT o, any_value(e), 0, 1.0 / any_value(n) - sum(mean[i] * u)
    FROM {t}_t, {t}_f GROUP BY o)"""


def coefficients(tag: str, terms: Sequence[str], robust: bool = True, cons: bool = True) -> str:
    """``i, term, coef, se, omitted`` of the first terms (and the constant)."""
    names = "[" + ", ".join(f"'{x}'" for x in ["_cons", *terms]) + "]"
    if robust:
        var = "n * 1.0 / df_r * sum(e * e * u * u)"
    else:   # u'u is the diagonal of the inverse, for the constant 1/n + its quadratic form
        var = "rss / df_r * sum(u * u)"
    return f"""SELECT i, ({names})[i + 1] AS term, CASE WHEN i = 0 THEN mean[w] - list_sum(list_transform(range(1, w),
      lambda j: CASE WHEN kept[j] THEN mean[j] * s[j][w] ELSE 0 END)) WHEN kept[i] THEN s[i][w] ELSE 0.0 END AS coef,
    CASE WHEN i = 0 OR kept[i] THEN sqrt({var}) END AS se, i > 0 AND NOT kept[greatest(i, 1)] AS omitted
  FROM {tag}_u, {tag}_f WHERE i <= {len(terms)}{'' if cons else ' AND i > 0'} GROUP BY i, s, kept, w, n, df_r, rss, mean"""


def wald2(tag: str) -> str:
    """Joint F of the first two terms (both kept), HC1."""
    return f"""SELECT CAST(df_r AS BIGINT) AS df_r, (b1 * b1 * v22 - 2 * b1 * b2 * v12 + b2 * b2 * v11) / (v11 * v22 - v12 * v12) / 2 AS f
  FROM (SELECT df_r, s[1][w] AS b1, s[2][w] AS b2, n * 1.0 / df_r * sum(a.e * a.e * a.u * a.u) AS v11,
      n * 1.0 / df_r * sum(a.e * a.e * a.u * b.u) AS v12, n * 1.0 / df_r * sum(a.e * a.e * b.u * b.u) AS v22
    FROM {tag}_u a JOIN {tag}_u b ON a.o = b.o AND a.i = 1 AND b.i = 2, {tag}_f GROUP BY s, w, n, df_r)"""


def statistics(tag: str) -> str:
    return f"""SELECT n, groups AS n_groups, groups - 1 AS df_a, CAST(df_r AS BIGINT) AS df_r, CAST(k AS INTEGER) AS k, 1 - rss / tss AS r2,
  1 - (rss / tss) * (n - 1) / df_r AS r2_adj, 1 - rss / within_ss AS r2_within, sqrt(rss / df_r) AS rmse FROM {tag}_f"""
