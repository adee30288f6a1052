"""Cleaning, parsing, projection and filters (CL1-CL22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.config import TEAM_RENAMES
from pennant.functions import parse
from pennant.functions.safe import div
from pennant.sources.dims import era_case

INT_COLUMNS = ("year", "wins", "losses", "runs_scored", "runs_allowed", "run_differential")
FLOAT_COLUMNS = ("winning_percentage", "games_behind", "wild_card_games_behind")
RECORD_COLUMNS = ("record_at_home", "record_when_away", "record_against_top_50_percent",
                  "expected_win_loss_record")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """CL1 — exact whole-row dedup (one shuffle on all columns)."""
    return df.dropDuplicates()


def strip_strings(df: DataFrame) -> DataFrame:
    """CL2 — trim string columns; '' becomes NULL (NULL stays NULL)."""
    return df.select(*[F.nullif(F.trim(F.col(f.name)), F.lit("")).alias(f.name)
                       if f.dataType.typeName() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def rename_values(df: DataFrame, column: str = "team_name", mapping: dict | None = None) -> DataFrame:
    """CL3 — literal value replacement (a CASE over the column; no join)."""
    mapping = TEAM_RENAMES if mapping is None else mapping
    if column not in df.columns or not mapping:
        return df
    return df.replace(dict(mapping), subset=[column])


def normalize_names(df: DataFrame, aliases: DataFrame, column: str = "team_name") -> DataFrame:
    """CL4 — historical -> current names via a left join to an alias dimension.

    The alias dimension is made unique on ``historical`` first (the highest
    ``priority`` wins, i.e. the last stated mapping), so the join never
    multiplies rows.  No broadcast hint: AQE broadcasts it when its measured
    size is below the threshold and falls back to a sort-merge join otherwise.
    """
    if "priority" in aliases.columns:
        aliases = (aliases.groupBy("historical")
                   .agg(F.max_by("current", "priority").alias("current")))
    a = aliases.select(F.col("historical").alias("__hist"), F.col("current").alias("__cur"))
    out = df.join(a, F.col(column) == F.col("__hist"), "left")
    return out.withColumn(column, F.coalesce(F.col("__cur"), F.col(column))).drop("__hist", "__cur")


def fill_defaults(df: DataFrame) -> DataFrame:
    """CL5 — last-10 record '5-5' and streak 'W0' when missing."""
    fills = {k: v for k, v in {"record_in_the_last_10_games": "5-5", "current_streak": "W0"}.items()
             if k in df.columns}
    return df.na.fill(fills) if fills else df


def coerce_types(df: DataFrame) -> DataFrame:
    """CL6 — numeric coercion; bad text -> NULL."""
    ex = {c: parse.to_int(c) for c in INT_COLUMNS if c in df.columns}
    ex.update({c: parse.to_double(c) for c in FLOAT_COLUMNS if c in df.columns})
    return df.withColumns(ex)


def parse_text_columns(df: DataFrame) -> DataFrame:
    """CL7-CL9 — record, last-10 and streak parsing (presence-gated)."""
    cols = [F.col(c) for c in df.columns]
    for c in RECORD_COLUMNS:
        if c in df.columns:
            cols += parse.parse_record(c)
    if "record_in_the_last_10_games" in df.columns:
        cols += parse.parse_last_10()
    if "current_streak" in df.columns:
        cols += parse.parse_streak()
    return df.select(*cols)


def filter_period_range(df: DataFrame, lo: int, hi: int, period: str = "year") -> DataFrame:
    """CL10 — inclusive period range (pushed into the parquet scan when possible)."""
    return df.where(F.col(period).between(lo, hi))


def filter_era_strategy(df: DataFrame, strategy: str, years: tuple, period: str = "year") -> DataFrame:
    """CL11 — 'modern' keeps the modern year range; any other value keeps everything."""
    return filter_period_range(df, years[0], years[1], period) if strategy == "modern" else df


def add_era(df: DataFrame, ranges, period: str = "year", name: str = "era") -> DataFrame:
    """CL13 — closed-range era label (CASE generated from the dimension)."""
    return df.withColumn(name, era_case(F.col(period), ranges))


def write_era_splits(df: DataFrame, ranges, path: str, period: str = "year") -> str:
    """CL12 — the era splits themselves: one ``era=<name>`` folder of rows per non-empty era."""
    add_era(df, ranges, period).where(F.col("era") != "unknown").write.partitionBy("era").mode("overwrite").parquet(path)
    return path


def era_counts(df: DataFrame, ranges, period: str = "year") -> DataFrame:
    """CL12 — era splits as one labelled DataFrame: row count per non-empty era."""
    return (add_era(df, ranges, period).where(F.col("era") != "unknown")
            .groupBy("era").agg(F.count(F.lit(1)).alias("n_rows")))


def keep_members(df: DataFrame, column: str, values) -> DataFrame:
    """CL17 — membership filter."""
    return df.where(F.col(column).isin(list(values)))


def drop_incomplete(df: DataFrame, columns) -> DataFrame:
    """CL18 — drop rows with NULL in any required column."""
    return df.na.drop(subset=list(columns))


def display_projection(df: DataFrame, columns: dict, round_digits: dict | None = None,
                       percent: dict | None = None) -> DataFrame:
    """CL19 — project + rename + round + percent text."""
    round_digits = round_digits or {}
    percent = percent or {}
    out = []
    for src, dst in columns.items():
        c = F.col(src)
        if src in round_digits:
            c = F.round(c, round_digits[src])
        out.append(c.alias(dst))
    for src, dst in percent.items():
        out.append(F.concat(F.round(F.col(src) * 100, 1).cast("string"), F.lit("%")).alias(dst))
    return df.select(*out)


def add_calculated_fields(df: DataFrame) -> DataFrame:
    """CL21 — winning_percentage and run_differential from counts."""
    return df.withColumns({
        "winning_percentage": div("wins", F.col("wins") + F.col("losses")),
        "run_differential": F.col("runs_scored") - F.col("runs_allowed"),
    })


def standard_scale(df: DataFrame, columns, ddof: int = 0, suffix: str = "_scaled") -> DataFrame:
    """CL22 / ML1 (SQL form) — (x - mean) / std with std ddof 0 (population, as
    in the original scaler) or 1; statistics from one aggregate joined back."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = df.agg(*[a for c in columns for a in (F.avg(c).alias(f"__m_{c}"), std(c).alias(f"__s_{c}"))])
    # one-row aggregate: broadcast is size-proven; equi-join on a constant key
    out = df.withColumn("__k", F.lit(1)).join(F.broadcast(stats.withColumn("__k", F.lit(1))), "__k", "left")
    out = out.withColumns({f"{c}{suffix}": div(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}")) for c in columns})
    return out.drop("__k", *[f"__{k}_{c}" for c in columns for k in ("m", "s")])
