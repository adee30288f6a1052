"""Sums of vectors: every task adds up one vector of fixed length and emits it once, instead of a row per element."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_sums(df: DataFrame, add: Callable[[pd.DataFrame], np.ndarray], width: int, out: str = "sums") -> DataFrame:
    """One row: ``out``, the sum over all rows of a vector of ``width`` numbers.

    ``add`` gives the sum of a batch's vectors.  A task holds one vector and emits one row, so the shuffle carries
    tasks x width numbers whatever the number of rows.  Without rows every sum is 0.
    """
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if len(batch):
                total += add(batch)
        yield pd.DataFrame({"v": [total.tolist()]})

    parts = df.mapInPandas(run, "v array<double>").select(F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy("i").agg(F.sum("x").alias("x"))
    got = sums.agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("s")).select(F.transform("s", lambda s: s["x"]).alias(out))
    return got.select(F.when(F.size(out) == 0, F.array_repeat(F.lit(0.0), width)).otherwise(F.col(out)).alias(out))
