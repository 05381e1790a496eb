"""Readers (inventory S1-S8).

Every reader takes an explicit schema (no inference pass over the data) and
returns a lazy DataFrame, so column pruning and filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA_TEXT = "NA"  # fixed value: literal text the source files use for missing


# --------------------------------------------------------------------------- S1
def read_table(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType,
               sep: str = ",", header: bool = True, na: str = NA_TEXT) -> DataFrame:
    """Headered delimited text; ``na`` text and empty fields become NULL.

    Malformed numeric fields also become NULL (PERMISSIVE mode), like a
    coercion of dirty values on load.
    """
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("nullValue", na).option("mode", "PERMISSIVE").csv(path))


# --------------------------------------------------------------------------- S2/S3
def read_dir(spark: SparkSession, path: str, schema: str | T.StructType,
             cols: Sequence[str] | None = None, sep: str = ",", header: bool = True,
             na: str = NA_TEXT, source_col: str | None = None) -> DataFrame:
    """All same-shape files of a directory (or glob) as one stacked table.

    One scan over all files (no per-file loop and union); ``cols`` prunes the
    columns actually parsed; ``source_col`` records the file of each row.
    """
    df = read_table(spark, path, schema, sep=sep, header=header, na=na)
    if source_col:
        df = df.withColumn(source_col, F.input_file_name())
    if cols is not None:
        df = df.select(*cols, *([source_col] if source_col else []))
    return df


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType,
                   cols: Sequence[str] | None = None, sep: str = "\t") -> DataFrame:
    """Delimited ``.TXT`` extracts with a column subset."""
    return read_dir(spark, path, schema, cols=cols, sep=sep)


# --------------------------------------------------------------------------- S4
def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON-lines file with an explicit schema."""
    return spark.read.schema(schema).json(path)


def parse_json_column(df: DataFrame, col: str, schema: str | T.StructType,
                      prefix: str = "", keep: bool = False) -> DataFrame:
    """Parse a JSON text column into top-level columns (``from_json``)."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(F.col(col), st)
    new = [parsed.getField(f.name).alias(f"{prefix}{f.name}") for f in st.fields]
    base = [F.col(c) for c in df.columns if keep or c != col]
    return df.select(*base, *new)


# --------------------------------------------------------------------------- S5
def read_fixed_width(spark: SparkSession, path: str,
                     layout: Sequence[tuple[str, int, int, str]]) -> DataFrame:
    """Fixed-width records; ``layout`` = [(name, start (1-based), width, type)]."""
    return parse_fixed_width(spark.read.text(path), layout, "value")


def parse_fixed_width(df: DataFrame, layout: Sequence[tuple[str, int, int, str]],
                      col: str = "value") -> DataFrame:
    """Cut a text column into typed fields; unparsable fields become NULL."""
    out = []
    for name, start, width, dtype in layout:
        piece = F.trim(F.substring(F.col(col), start, width))
        piece = F.when(piece == "", None).otherwise(piece)
        out.append((piece if dtype == "string" else piece.try_cast(dtype)).alias(name))
    return df.select(*out)


# --------------------------------------------------------------------------- S6
def stack_parts(parts: Sequence[DataFrame], cols: Sequence[str],
                part_col: str | None = None) -> DataFrame:
    """Project the same columns of each part of a multi-part file and append."""
    sel = []
    for i, p in enumerate(parts):
        s = p.select(*cols)
        if part_col:
            s = s.withColumn(part_col, F.lit(i + 1))
        sel.append(s)
    return reduce(lambda a, b: a.unionByName(b), sel)


# --------------------------------------------------------------------------- S7
def signal_window(feed: DataFrame, start: str | None = None, end: str | None = None,
                  signals: Sequence[str] | None = None, geo_level: str | None = None,
                  time_col: str = "time_value", signal_col: str = "signal",
                  geo_col: str = "geo_type") -> DataFrame:
    """Restrict a long (signal, geo, time, value) feed in one scan.

    All signals are read together; the filters are plain predicates, so they
    are pushed into the Parquet scan (and prune partitions when the feed is
    partitioned by signal or date).
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(time_col) >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(time_col) <= F.lit(end).cast("date"))
    if signals is not None:
        cond = cond & F.col(signal_col).isin(list(signals))
    if geo_level is not None:
        cond = cond & (F.col(geo_col) == F.lit(geo_level))
    return feed.filter(cond)


# --------------------------------------------------------------------------- S8
def survey_estimates(est: DataFrame, variables: Sequence[str] | DataFrame,
                     meta: DataFrame | None = None, var_col: str = "variable") -> DataFrame:
    """Survey-estimate table restricted to a variable list, with variable metadata.

    The variable list is a literal ``isin`` (pushed to the scan) or, when it
    is itself a table, a semi join; metadata is a left lookup.
    """
    from panora.operators.joins import lookup
    if isinstance(variables, DataFrame):
        out = est.join(variables.select(var_col).distinct(), var_col, "left_semi")
    else:
        out = est.filter(F.col(var_col).isin(list(variables)))
    if meta is not None:
        out = lookup(out, meta, var_col)
    return out


def read_tables(spark: SparkSession, root: str, names: Sequence[str],
                fmt: str = "parquet") -> Mapping[str, DataFrame]:
    """Landed tables by name under one root (``{root}/{name}.{fmt}``)."""
    return {n: spark.read.format(fmt).load(f"{root}/{n}.{fmt}") for n in names}
