"""Tails of the Student t distribution as column expressions, with the same arithmetic as SQL text.

The regularised incomplete beta I_x(a, b) is a continued fraction evaluated from its far end inside
``aggregate`` over a sequence: a small loop per row in the JVM, no driver pass.  The fraction is taken on the side
x < (a + 1) / (a + b + 2), where about the square root of the larger parameter in steps is enough; degrees of freedom
above MAX_DF count as MAX_DF (the tail then differs from the normal one by less than 1e-7).

Degrees of freedom that are null or not positive, and statistics that are null or NaN, give NULL; an infinite
statistic has tail 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DF = 1e7
#: quantiles are sums of halved steps from here down, so they reach twice this value
FIRST_STEP, HALVINGS = 5000.0, 60
LEVELS = (0.10, 0.05, 0.01)


def _log_gamma(z: Column) -> Column:
    """Stirling's series eight places up, brought back by the recurrence (z > 0)."""
    s = z + 8
    series = (s - 0.5) * F.ln(s) - s + 0.5 * math.log(2 * math.pi) \
        + 1 / (12 * s) - 1 / (360 * s ** 3) + 1 / (1260 * s ** 5) - 1 / (1680 * s ** 7)
    down = z
    for i in range(1, 8):
        down = down * (z + i)
    return series - F.ln(down)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """x^a (1 - x)^b / (a B(a, b)) over the continued fraction."""
    steps = (60 + F.ceil(3 * F.sqrt(F.greatest(a, b)))).cast("int")

    def back(f, m):
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return 1 + even / (1 + odd / f)
    inner = F.aggregate(F.sequence(steps, F.lit(1), F.lit(-1)), F.lit(1.0), back)
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.ln(x) + b * F.log1p(-x))
    return front / (a * (1 - (a + b) * x / (a + 1) / inner))


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|)."""
    n, t = F.when(df > MAX_DF, MAX_DF).otherwise(df.cast("double")), t.cast("double")
    half, one = n / 2, F.lit(0.5)
    x, y = n / (n + t * t), t * t / (n + t * t)
    tail = F.when(t == 0, 1.0).when(F.abs(t) == float("inf"), 0.0) \
        .when(x < (half + 1) / (half + 2.5), _fraction(half, one, x)).otherwise(1 - _fraction(one, half, y))
    return F.when((n > 0) & ~F.isnan(t), tail)


def t_quantile(p: float, df: Column) -> Column:
    """The value that T exceeds with probability 1 - ``p`` (p over 0.5)."""
    steps = F.array(*[F.lit(FIRST_STEP / 2 ** i) for i in range(HALVINGS)])
    return F.when(df > 0, F.aggregate(steps, F.lit(0.0), lambda v, s: F.when(
        t_two_sided(v + s, df) > 2 * (1 - p), v + s).otherwise(v)))


def stars(p: Column) -> Column:
    """One star for each of the levels 10, 5 and 1 percent that ``p`` is below."""
    return F.repeat(F.lit("*"), sum((F.coalesce((p < v).cast("int"), F.lit(0)) for v in LEVELS), F.lit(0)))


# the same in SQL ----------------------------------------------------------------------------
def _sql_fraction(a: str, b: str, x: str) -> str:
    inner = (f"list_reduce(list_transform(range(60 + CAST(ceil(3 * sqrt(greatest({a}, {b}))) AS BIGINT), 0, -1), "
             f"lambda k: CAST(k AS DOUBLE)), lambda f, m: 1 + m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m)) "
             f"/ (1 - ({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1)) / f), CAST(1 AS DOUBLE))")
    return (f"exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln({x}) + {b} * ln(1 - {x})) "
            f"/ ({a} * (1 - ({a} + {b}) * {x} / ({a} + 1) / {inner}))")


def sql_t_two_sided(t: str, df: str) -> str:
    n, s = f"CAST({df} AS DOUBLE)", f"({t}) * ({t})"
    half, x, y = f"({n} / 2)", f"({n} / ({n} + {s}))", f"({s} / ({n} + {s}))"
    return (f"CASE WHEN {t} = 0 THEN 1.0 WHEN {x} < ({half} + 1) / ({half} + 2.5) THEN {_sql_fraction(half, '0.5', x)} "
            f"ELSE 1 - ({_sql_fraction('0.5', half, y)}) END")


def sql_t_quantile(p: float, df: str) -> str:
    steps = ", ".join(repr(FIRST_STEP / 2 ** i) for i in range(HALVINGS))
    return (f"list_reduce([{steps}]::DOUBLE[], lambda v, s: CASE WHEN {sql_t_two_sided('(v + s)', df)} > {2 * (1 - p)!r} "
            f"THEN v + s ELSE v END, CAST(0 AS DOUBLE))")


def sql_stars(p: str) -> str:
    return f"repeat('*', coalesce({' + '.join(f'CAST({p} < {v} AS BIGINT)' for v in LEVELS)}, 0))"
