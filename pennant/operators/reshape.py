"""Set / reshape operations (ST1-ST5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames) -> DataFrame:
    """ST1 / ST2 — concatenate outputs by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def wide_to_long(df: DataFrame, ids, columns, name="variable", value="value") -> DataFrame:
    """ST3 — unpivot."""
    return df.unpivot(list(ids), list(columns), name, value)


def long_to_wide(df: DataFrame, ids, pivot_col: str, values, value: str) -> DataFrame:
    """ST4 — pivot with an explicit value list (no discovery job)."""
    return df.groupBy(*ids).pivot(pivot_col, list(values)).agg(F.first(value))


def label_matrix(df: DataFrame, definitions: dict) -> DataFrame:
    """ST5 — multi-label 0/1 target columns from definitions: name -> column
    condition (threshold or custom rule)."""
    return df.withColumns({k: F.coalesce(v.cast("int"), F.lit(0)) for k, v in definitions.items()})
