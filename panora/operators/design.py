"""Treatment and panel-design operators (inventory T1-T7) and the Panel wrapper."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.operators.nullsafe import attach


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Panel:
    """A DataFrame with a declared entity and (integer or date) time key."""

    df: DataFrame
    entity: str
    time: str
    freq: str = "week"

    def with_df(self, df: DataFrame) -> "Panel":
        return Panel(df, self.entity, self.time, self.freq)

    def sample(self, cols: Sequence[str]) -> DataFrame:
        return estimation_sample(self.df, [self.entity, self.time, *cols])

    # operators bound to the declared keys (xtset-style) -----------------------
    def lag(self, cols: Sequence[str], k: int = 1) -> "Panel":
        from panora.operators.window import time_lag
        return self.with_df(time_lag(self.df, self.entity, self.time, cols, k))

    def lead(self, cols: Sequence[str], k: int = 1) -> "Panel":
        from panora.operators.window import time_lead
        return self.with_df(time_lead(self.df, self.entity, self.time, cols, k))

    def locf(self, cols: Sequence[str], chunk: int | None = None) -> "Panel":
        from panora.operators.window import locf
        return self.with_df(locf(self.df, self.entity, self.time, cols, chunk))

    def balance(self, fill: Mapping[str, object] | None = None) -> "Panel":
        from panora.operators.joins import fill_balanced
        return self.with_df(fill_balanced(self.df, self.entity, self.time, fill))

    def structure(self) -> DataFrame:
        from panora.operators.profile import panel_structure
        return panel_structure(self.df, self.entity, self.time)

    def patterns(self) -> DataFrame:
        from panora.operators.profile import participation_patterns
        return participation_patterns(self.df, self.entity, self.time)

    def xtsum(self, cols: Sequence[str]) -> DataFrame:
        from panora.operators.profile import xtsum
        return xtsum(self.df, self.entity, cols)

    def areg(self, y: str, terms: Sequence[str], time_effects: bool = True, **kw):
        """Absorbed entity effects, plus period indicators when ``time_effects``."""
        from panora.operators.estimate import areg
        t = list(terms) + ([f"i.{self.time}"] if time_effects else [])
        return areg(self.df, y, t, absorb=self.entity, **kw)


# --------------------------------------------------------------------------- T1
def treatment_time(*dates) -> Column:
    """Effective treatment time = earliest of several policy times, NULLs ignored."""
    cols = [_c(d) for d in dates]
    return cols[0] if len(cols) == 1 else F.least(*cols)


# --------------------------------------------------------------------------- T2
def post(time, t0, inclusive: bool = False) -> Column:
    """1 after treatment (``>`` or ``>=``), 0 before and for never-treated (M3)."""
    t, s = _c(time), _c(t0)
    cond = (t >= s) if inclusive else (t > s)
    return F.coalesce(cond.cast("int"), F.lit(0))


# --------------------------------------------------------------------------- T3
def ever_treated(df: DataFrame, entity: str, flag: str, out: str = "ever_treated") -> DataFrame:
    """Max of a 0/1 flag within entity, attached to each row (aggregate + join)."""
    agg = df.groupBy(entity).agg(F.max(F.coalesce(_c(flag), F.lit(0))).alias(out))
    return attach(df, agg, [entity])


# --------------------------------------------------------------------------- T4
def event_time(time, t0) -> Column:
    return (_c(time) - _c(t0)).cast("int")


def event_dummies(df: DataFrame, time: str, t0: str, leads: int, lags: int,
                  lead_prefix: str = "b", lag_prefix: str = "a",
                  group: str | None = None) -> DataFrame:
    """Lead/lag dummies b{leads}..b1, a0..a{lags} of event time ``time - t0``.

    Outside the window and for never-treated rows all dummies are 0.  With
    ``group`` each dummy is multiplied by the group indicator.
    """
    e = event_time(time, t0)
    g = _c(group) if group else F.lit(1)
    new = {}
    for k in range(leads, 0, -1):
        new[f"{lead_prefix}{k}"] = F.coalesce((e == -k).cast("int") * g, F.lit(0))
    for k in range(0, lags + 1):
        new[f"{lag_prefix}{k}"] = F.coalesce((e == k).cast("int") * g, F.lit(0))
    return df.withColumns(new)


# --------------------------------------------------------------------------- T5
def expand_formula(terms: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Expand factor notation into named product terms.

    ``a##b`` -> a, b, a#b ; ``a##b##c`` -> all main effects and interactions;
    ``a#b`` -> the product only.  ``c.`` / ``i.`` prefixes are accepted and
    dropped (0/1 indicators and continuous variables enter the same way).
    Returns ``[(name, [factor columns])]`` in first-seen order.
    """
    from itertools import combinations

    def clean(v: str) -> str:
        return v.split(".", 1)[1] if v[:2] in ("c.", "i.") else v

    out: dict[str, list[str]] = {}
    for t in terms:
        if "##" in t:
            parts = [clean(p) for p in t.split("##")]
            for r in range(1, len(parts) + 1):
                for combo in combinations(parts, r):
                    out.setdefault("#".join(combo), list(combo))
        elif "#" in t:
            parts = [clean(p) for p in t.split("#")]
            out.setdefault("#".join(parts), parts)
        else:
            out.setdefault(clean(t), [clean(t)])
    return list(out.items())


def interact(df: DataFrame, terms: Sequence[str], sep: str = "_x_") -> tuple[DataFrame, list[str]]:
    """Add product columns for every interaction in ``terms``; return (df, names).

    Interaction columns are named ``a{sep}b``; main effects keep their names.
    """
    names, new = [], {}
    for name, factors in expand_formula(terms):
        col_name = sep.join(factors)
        names.append(col_name)
        if len(factors) > 1 and col_name not in df.columns:
            prod = _c(factors[0])
            for f in factors[1:]:
                prod = prod * _c(f)
            new[col_name] = prod
    return (df.withColumns(new) if new else df), names


# --------------------------------------------------------------------------- T6
def group_2x2(a, b, labels: Mapping[tuple[int, int], str] | None = None) -> Column:
    """Label of a 2x2 design cell from two 0/1 indicators."""
    labels = labels or {(1, 1): "treated_high", (1, 0): "treated_low",
                        (0, 1): "control_high", (0, 0): "control_low"}
    expr = None
    for (x, y), lab in labels.items():
        cond = (_c(a) == x) & (_c(b) == y)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


# --------------------------------------------------------------------------- T7
def estimation_sample(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listwise-complete rows on the model variables."""
    cols = list(dict.fromkeys(cols))
    return df.select(*cols).dropna(how="any")
