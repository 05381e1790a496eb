"""Column labels and notes (inventory C20).

Labels live in the column metadata (``{"comment": ...}``), so they travel
with the schema through projections and into Parquet files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def label_columns(df: DataFrame, labels: Mapping[str, str],
                  notes: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Attach a label (and optional notes) to each named column in one projection."""
    notes = notes or {}
    out = []
    for f in df.schema.fields:
        if f.name in labels or f.name in notes:
            meta = dict(f.metadata)
            if f.name in labels:
                meta["comment"] = labels[f.name]
            if f.name in notes:
                meta["notes"] = list(notes[f.name])
            out.append(F.col(f.name).alias(f.name, metadata=meta))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def label_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Paired bulk labelling (``labvars a b c "A" "B" "C"`` style)."""
    return label_columns(df, dict(pairs))


def describe_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Listing of (position, name, type, label) built from the schema only."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, label string")
