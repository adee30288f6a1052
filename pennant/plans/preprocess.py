"""CL16 — the cleaning pipeline: clean -> fill -> cast -> parse -> filter.

No global sort: ordering is declared per window where it matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pennant.config import DEFAULT, PanelConfig
from pennant.operators import clean


def preprocess(df: DataFrame, cfg: PanelConfig = DEFAULT, era_strategy: str = "all",
               aliases: DataFrame | None = None, dedupe: bool = True) -> DataFrame:
    if dedupe:
        df = clean.drop_duplicate_rows(df)
    df = clean.strip_strings(df)
    df = clean.rename_values(df, cfg.entity)
    if aliases is not None:
        df = clean.normalize_names(df, aliases, cfg.entity)
    df = clean.fill_defaults(df)
    df = clean.coerce_types(df)
    df = clean.parse_text_columns(df)
    return clean.filter_era_strategy(df, era_strategy, cfg.modern_strategy_years, cfg.period)
