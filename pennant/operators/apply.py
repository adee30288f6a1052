"""``parallel_apply`` (UD5): a Python function over batches of rows, for work that no built-in expresses."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def parallel_apply(df: DataFrame, func: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``func`` of every Arrow batch of rows, in the tasks that hold them: no shuffle, no grouping, memory of one batch.
    ``func`` must treat each row by itself, because batches are cut anywhere; an empty batch is not handed on."""
    def run(batches):
        for batch in batches:
            if len(batch):
                yield func(batch)
    return df.mapInPandas(run, schema)


def bisect_rows(value: Callable[[np.ndarray], np.ndarray], low: np.ndarray, high: np.ndarray, steps: int = 200) -> np.ndarray:
    """For every row the place between ``low`` and ``high`` where an ascending function crosses 0."""
    for _ in range(steps):
        mid = (low + high) / 2
        above = value(mid) > 0
        low, high = np.where(above, low, mid), np.where(above, mid, high)
    return (low + high) / 2


def implied_exponents(batch: pd.DataFrame) -> pd.DataFrame:
    """The exponent at which a season's Pythagorean wins equal its wins, by bisection; null where there is none in
    [-60, 60] (no wins or no losses, equal or missing runs)."""
    rs, ra, w, l = (batch[c].to_numpy(float) for c in ("runs_scored", "runs_allowed", "wins", "losses"))  # noqa: E741
    with np.errstate(all="ignore"):
        ratio = np.log(rs / ra)
        share = w / (w + l)
        sign = np.sign(ratio)
        found = bisect_rows(lambda e: sign * (1 / (1 + np.exp(-e * ratio)) - share), np.full(len(batch), -60.0), np.full(len(batch), 60.0))
        good = (rs > 0) & (ra > 0) & (ratio != 0) & (share > 0) & (share < 1) & (np.abs(found) < 59.999)
    out = batch[["team_name", "year"]].copy()
    out["exponent"] = np.where(good, found, np.nan)
    out["exponent"] = out["exponent"].astype(object).where(good, None)
    return out
