"""Cleaning and scalar column functions (inventory C1-C19).

All helpers build JVM-side expressions; none of them registers a Python UDF.
Functions that touch several columns return one ``select`` so the plan stays
a single projection instead of a deep stack of ``withColumn`` nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


# --------------------------------------------------------------------------- C1
def to_number(col, ignore: Sequence[str] = (), dtype: str = "double") -> Column:
    """String -> number; text that does not parse becomes NULL.

    ``ignore`` lists characters removed before parsing (thousand separators,
    currency signs).  Uses ``try_cast`` because a plain cast raises under ANSI.
    """
    c = _c(col).cast("string")
    if ignore:
        c = F.translate(c, "".join(ignore), "")
    c = F.trim(c)
    # text such as "12d", "NaN" or "Infinity" would pass a cast
    number = F.when(c.rlike(NUMBER), c).try_cast(dtype)
    # digits beyond the type's range become infinity in a cast: no number either
    return F.when(F.abs(number) < F.lit(float("inf")), number) if dtype in ("double", "float") else number


def coerce_numeric(df: DataFrame, cols: Iterable[str] | None = None,
                   ignore: Sequence[str] = (), dtype: str = "double") -> DataFrame:
    """Coerce every string column (or ``cols``) to a number in one projection."""
    if cols is None:
        cols = [n for n, t in df.dtypes if t == "string"]
    cols = set(cols)
    return df.select([to_number(n, ignore, dtype).alias(n) if n in cols else F.col(n)
                      for n in df.columns])


# --------------------------------------------------------------------------- C2
def recode(df: DataFrame, cols: Iterable[str], mapping: Mapping, default=None,
           keep_unmapped: bool = False) -> DataFrame:
    """Replace values across many columns (e.g. {"Yes": 1, "": 0})."""
    cols = set(cols)

    def one(n):
        expr = None
        for k, v in mapping.items():
            cond = F.col(n).isNull() if k is None else (F.col(n) == F.lit(k))
            expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
        other = F.col(n) if keep_unmapped else F.lit(default)
        return expr.otherwise(other).alias(n)

    return df.select([one(n) if n in cols else F.col(n) for n in df.columns])


# --------------------------------------------------------------------------- C3
def strip_pattern(col, pattern: str, replacement: str = "") -> Column:
    """Regex replace in values (``*`` marks, ``/2020`` suffixes, blanks)."""
    return F.regexp_replace(_c(col), pattern, replacement)


def strip_leading_zeros(col) -> Column:
    return F.ltrim(_c(col), F.lit("0"))


def rename_regex(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Regex replace in column names (``rename_at(..., gsub)``)."""
    rx = re.compile(pattern)
    return df.toDF(*[rx.sub(replacement, n) for n in df.columns])


# --------------------------------------------------------------------------- C4
def normalize_key(col, length: int = 5, dtype: str = "int") -> Column:
    """Leading ``length`` characters of a code as an integer key (ZIP+4 -> ZIP)."""
    return F.substring(F.trim(_c(col).cast("string")), 1, length).try_cast(dtype)


# --------------------------------------------------------------------------- C5
def split_parts(df: DataFrame, col: str, into: Sequence[str],
                pattern: str = "[^A-Za-z0-9]+", dtype: str | None = None,
                drop: bool = True) -> DataFrame:
    """Split one column into several on a separator pattern (``separate``)."""
    parts = F.split(F.col(col), pattern)
    new = []
    for i, name in enumerate(into):
        piece = F.get(parts, i)
        new.append((piece.try_cast(dtype) if dtype else piece).alias(name))
    keep = [F.col(n) for n in df.columns if not (drop and n == col)]
    return df.select(*keep, *new)


# --------------------------------------------------------------------------- C6
def map_codes(col, mapping: Mapping, default=None) -> Column:
    """Code -> label as a literal map lookup (codegen'd, no join)."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, _c(col))
    return v if default is None else F.coalesce(v, F.lit(default))


def case_when(cases: Sequence[tuple[Column, object]], default=None) -> Column:
    """Multi-way case: ``[(condition, value), ...]``; first match wins."""
    expr = None
    for cond, val in cases:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


# --------------------------------------------------------------------------- C7
def select_like(df: DataFrame, prefix: str | None = None, suffix: str | None = None,
                contains: str | None = None, regex: str | None = None,
                between: tuple[str, str] | None = None, exclude: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Select columns by name rules; ``exclude=True`` takes the complement."""
    cols = df.columns
    rng = set()
    if between:
        a, b = cols.index(between[0]), cols.index(between[1])
        rng = set(cols[min(a, b): max(a, b) + 1])

    def hit(n):
        rules = []
        if prefix is not None:
            rules.append(n.startswith(prefix))
        if suffix is not None:
            rules.append(n.endswith(suffix))
        if contains is not None:
            rules.append(contains in n)
        if regex is not None:
            rules.append(re.search(regex, n) is not None)
        if between:
            rules.append(n in rng)
        return all(rules) if rules else True

    chosen = [n for n in cols if (n in keep) or (hit(n) != exclude)]
    return df.select(*chosen)


# --------------------------------------------------------------------------- C8
def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def add_affix(df: DataFrame, cols: Iterable[str] | None = None, prefix: str = "",
              suffix: str = "") -> DataFrame:
    """Bulk rename with a prefix and/or suffix (``_mean``, ``state_``)."""
    cols = df.columns if cols is None else list(cols)
    return df.withColumnsRenamed({n: f"{prefix}{n}{suffix}" for n in cols})


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError("positional rename needs one name per column")
    return df.toDF(*names)


# --------------------------------------------------------------------------- C9
def relocate(df: DataFrame, cols: Sequence[str], before: str | None = None,
             after: str | None = None) -> DataFrame:
    """Move ``cols`` to the front, or before/after an anchor column."""
    cols = list(cols)
    rest = [n for n in df.columns if n not in cols]
    if before is None and after is None:
        order = cols + rest
    else:
        anchor = before or after
        i = rest.index(anchor) + (0 if before else 1)
        order = rest[:i] + cols + rest[i:]
    return df.select(*order)


# --------------------------------------------------------------------------- C11
def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Listwise deletion on ``cols`` (the estimation sample)."""
    return df.dropna(how="any", subset=list(cols))


# --------------------------------------------------------------------------- C12
def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """Deterministic first row per key under an explicit order.

    Expressed as ``min`` over a struct of (order columns, remaining columns):
    a partial (map-side) aggregate, so a key holding a large share of the
    rows is reduced before the shuffle instead of being sorted in one task,
    and rows tied on the order columns are resolved by the remaining columns
    (the result never depends on input order).
    """
    keys = list(keys)
    order = [_c(o) for o in order_by]
    rest = [n for n in df.columns if n not in keys]
    # a missing order value stands last, as in a sort
    packed = F.struct(*[x for i, o in enumerate(order) for x in (o.isNull().alias(f"__m{i}"), o.alias(f"__o{i}"))],
                      *[F.col(n).alias(f"__v_{n}") for n in rest])
    out = df.groupBy(*keys).agg(F.min(packed).alias("__row"))
    return out.select(*keys, *[F.col(f"__row.__v_{n}").alias(n) for n in rest]).select(*df.columns)


# --------------------------------------------------------------------------- C16
def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (plain ``/`` raises under ANSI)."""
    return F.try_divide(_c(a), _c(b))


def log1p(col) -> Column:
    """ln(x + 1); NULL for x <= -1 instead of an error or -inf."""
    x = _c(col)
    return F.when(x > -1, F.log1p(x))


def safe_ln(col) -> Column:
    x = _c(col)
    return F.when(x > 0, F.ln(x))


def percent(a, b) -> Column:
    return F.try_divide(_c(a) * 100.0, _c(b))


def quantize(col, digits: int = 4) -> Column:
    """Round half up at ``digits`` decimals, then +0.0 (turns -0.0 into 0.0).

    Used on float outputs that are compared across engines: ``round`` on
    doubles breaks ties differently in different engines.
    """
    s = float(10 ** digits)
    return (F.floor(_c(col) * s + 0.5) / s).cast("double") + F.lit(0.0)


# --------------------------------------------------------------------------- C18
def blank_flag(col) -> Column:
    """1 when the string is non-blank, 0 when blank or NULL."""
    c = F.trim(_c(col))
    return F.when(c.isNull() | (c == ""), 0).otherwise(1)


def null_flag(col) -> Column:
    """1 when present, 0 when NULL."""
    return F.when(_c(col).isNull(), 0).otherwise(1)


# --------------------------------------------------------------------------- C19
def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType,
                  extra_rows: Sequence[tuple] = ()) -> DataFrame:
    """A small literal dimension plus appended rows (bounded by construction)."""
    base = spark.createDataFrame(list(rows), schema)
    if extra_rows:
        base = base.unionByName(spark.createDataFrame(list(extra_rows), schema))
    return base
