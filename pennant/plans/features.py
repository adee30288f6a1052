"""Feature engineering over an entity x period panel (SC1-SC24, WN1-WN15).

Physical shape of the plan:

* per-row expressions (SC*) are plain projections inside whole-stage codegen;
* per-period and per-era statistics (WN7-WN13) are ``groupBy`` aggregates
  (partial + final, tiny output) joined back on the low-cardinality key —
  never a window over raw rows partitioned by a handful of keys;
* percentile ranks use the histogram + two-level prefix helper;
* the per-period top-k (WN14) uses ``row_number <= k`` which Spark plans with a
  partial ``WindowGroupLimit`` before the shuffle, then a flag join;
* every entity-history column (lags, rolling means, slopes, volatility, leads)
  shares ONE ``Window.partitionBy(entity).orderBy(period)`` spec: one shuffle,
  one sort.  An entity holds at most one row per period, so these partitions
  are bounded by the number of periods and cannot be skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.config import DEFAULT, PanelConfig
from pennant.functions.safe import broadcast_all_if_small, div, persist_and_count
from pennant.operators.ranking import attach_ranks, rank_table, ranked_histogram, value_histogram
from pennant.session import materialize  # noqa: F401  (re-exported)
from pennant.sources.dims import era_open_case, playoff_spots_case


def c(name: str) -> Column:
    return F.col(name)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with pandas semantics (a comparison with NULL is 0)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def entity_window(cfg: PanelConfig) -> Window:
    return Window.partitionBy(cfg.entity).orderBy(cfg.period)


# ---------------------------------------------------------------- per row ---

def performance_features(df: DataFrame) -> DataFrame:
    """SC1-SC4."""
    cols = df.columns
    ex = {"total_games": c("wins") + c("losses")}
    df = df.withColumns(ex)
    ex = {}
    if "at_home_wins" in cols and "at_home_losses" in cols:
        df = df.withColumn("home_games", c("at_home_wins") + c("at_home_losses"))
        df = df.withColumn("home_win_pct", F.coalesce(div("at_home_wins", "home_games"), F.lit(0.5)))
    if "when_away_wins" in cols and "when_away_losses" in cols:
        df = df.withColumn("away_games", c("when_away_wins") + c("when_away_losses"))
        df = df.withColumn("away_win_pct", F.coalesce(div("when_away_wins", "away_games"), F.lit(0.5)))
        df = df.withColumn("home_away_diff", c("home_win_pct") - c("away_win_pct"))
    if "against_top_50_percent_wins" in cols:
        tot = c("against_top_50_percent_wins") + c("against_top_50_percent_losses")
        df = df.withColumn("win_pct_vs_top_teams",
                           F.coalesce(div("against_top_50_percent_wins", tot), F.lit(0.5)))
    return df


def efficiency_features(df: DataFrame) -> DataFrame:
    """SC5-SC7 (row part; the per-period ratings are attached by ``period_statistics``)."""
    return df.withColumns({
        "runs_per_game": div("runs_scored", "total_games"),
        "runs_allowed_per_game": div("runs_allowed", "total_games"),
        "run_efficiency": F.coalesce(div("runs_scored", "runs_allowed"), F.lit(1.0)),
        "close_game_factor": div(F.lit(1.0), 1 + F.abs(div("run_differential", "total_games"))),
    })


def pythagorean_features(df: DataFrame) -> DataFrame:
    """SC8-SC9."""
    rs2 = F.pow(c("runs_scored").cast("double"), 2)
    ra2 = F.pow(c("runs_allowed").cast("double"), 2)
    df = df.withColumn("pythagorean_wins", div(c("total_games") * rs2, rs2 + ra2))
    df = df.withColumn("pythagorean_win_pct", div("pythagorean_wins", "total_games"))
    df = df.withColumns({"luck_factor": c("wins") - c("pythagorean_wins"),
                         "luck_pct": c("winning_percentage") - c("pythagorean_win_pct")})
    return df.withColumn("performance_above_talent", div("luck_factor", "total_games"))


def momentum_features(df: DataFrame) -> DataFrame:
    """SC10-SC11."""
    ex = {}
    if "last_10_pct" in df.columns:
        ex["momentum"] = c("last_10_pct") - c("winning_percentage")
        ex["hot_team"] = flag(c("last_10_pct") >= 0.7)
        ex["cold_team"] = flag(c("last_10_pct") <= 0.3)
    if "streak_length" in df.columns and "on_winning_streak" in df.columns:
        ex["streak_score"] = c("streak_length") * (2 * c("on_winning_streak") - 1)
        ex["long_winning_streak"] = flag((c("on_winning_streak") == 1) & (c("streak_length") >= 5))
    return df.withColumns(ex) if ex else df


# ---------------------------------------------------- per period / per era ---

def period_statistics(base: DataFrame, cfg: PanelConfig) -> DataFrame:
    """WN7-WN9 per-period aggregates (one row per period)."""
    return base.groupBy(cfg.period).agg(
        F.avg("runs_per_game").alias("__m_rpg"), F.avg("runs_allowed_per_game").alias("__m_rapg"),
        F.avg("wins").alias("__m_w"), F.stddev_samp("wins").alias("__sd_w"))


def apply_period_statistics(df: DataFrame, stats: DataFrame, cfg: PanelConfig) -> DataFrame:
    df = df.join(stats, cfg.period, "left")
    df = df.withColumns({
        "offensive_rating": div("runs_per_game", "__m_rpg"),
        "defensive_rating": div("__m_rapg", "runs_allowed_per_game"),
        "league_strength": div("__m_w", "total_games"),
        "competitive_balance": c("__sd_w"),
        "normalized_competitive_balance": div("__sd_w", "total_games"),
    })
    return df.withColumn("relative_strength", div("winning_percentage", "league_strength")) \
             .drop("__m_rpg", "__m_rapg", "__m_w", "__sd_w")


def era_statistics(base: DataFrame, cfg: PanelConfig) -> tuple[DataFrame, DataFrame]:
    """WN11 / WN13 aggregates: per era, and per (era, period)."""
    aggs = []
    for col in cfg.era_columns:
        aggs += [F.avg(col).alias(f"__m_{col}"), F.stddev_samp(col).alias(f"__sd_{col}")]
    era = base.groupBy("era").agg(*aggs)
    env = base.groupBy("era", cfg.period).agg(F.avg("runs_per_game").alias("era_run_environment"))
    return era, env


def apply_era_statistics(df: DataFrame, era: DataFrame, env: DataFrame, cfg: PanelConfig) -> DataFrame:
    df = df.join(era, "era", "left").join(env, ["era", cfg.period], "left")
    ex = {f"{col}_era_zscore": div(c(col) - c(f"__m_{col}"), c(f"__sd_{col}")) for col in cfg.era_columns}
    return df.withColumns(ex).drop(*[f"__{k}_{col}" for col in cfg.era_columns for k in ("m", "sd")])


def rank_specs(cfg: PanelConfig) -> list:
    """WN10 and WN12 percentiles, computed together from one histogram pass."""
    specs = [([cfg.period], "wins", "wins_percentile"),
             ([cfg.period], "run_differential", "run_diff_percentile")]
    specs += [(["era"], col, f"{col}_era_percentile") for col in cfg.era_columns]
    return specs


def era_derived(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """SC16-SC19."""
    thr = None
    for era, t in cfg.era_elite_wins.items():
        thr = F.when(c("era") == era, F.lit(t)) if thr is None else thr.when(c("era") == era, F.lit(t))
    thr = thr.otherwise(F.lit(cfg.era_elite_default)) if thr is not None else F.lit(cfg.era_elite_default)
    return df.withColumns({
        "elite_team": flag(c("wins_percentile") >= 0.9),
        "above_average_team": flag(c("winning_percentage") > 0.5),
        "era_adjusted_elite_wins": flag(c("wins") >= thr),
        "offense_vs_era": div("runs_per_game", "era_run_environment"),
        "defense_vs_era": div("era_run_environment", "runs_allowed_per_game"),
        "historical_dominance": (c("wins_era_percentile") * 0.4 + c("run_differential_era_percentile") * 0.3
                                 + c("winning_percentage_era_percentile") * 0.3),
    })


def playoff_keys(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """WN14: keys of the top ``playoff_spots`` entities by wins per period (ties by entity)."""
    w = Window.partitionBy(cfg.period).orderBy(F.desc("wins"), F.asc(cfg.entity))
    top = (df.where(c("wins").isNotNull()).select(cfg.entity, cfg.period, "wins", "playoff_spots")
           .withColumn("__rn", F.row_number().over(w))
           .where(c("__rn") <= cfg.max_playoff_spots)       # literal bound -> WindowGroupLimit
           .where(c("__rn") <= c("playoff_spots"))
           .select(cfg.entity, cfg.period, F.lit(1).alias("made_playoffs")))
    return top


def apply_playoff_keys(df: DataFrame, top: DataFrame, cfg: PanelConfig) -> DataFrame:
    """JN4 — membership as a left join to the (bounded: periods x spots) key set."""
    df = df.join(top, [cfg.entity, cfg.period], "left")
    return df.withColumn("made_playoffs", F.coalesce(c("made_playoffs"), F.lit(0)))


def target_flags(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """SC20-SC23."""
    gb = c("games_behind")
    leader = gb.isNull() if cfg.leader_rule == "null" else (gb.isNull() | (gb == 0))
    ex = {"is_division_winner": leader.cast("int"),
          "playoff_spots": playoff_spots_case(c(cfg.period), cfg.playoff_steps)}
    for t in cfg.win_milestones:
        ex[f"achieved_{t}_wins"] = flag(c("wins") >= t)
    ex[f"scored_{cfg.runs_scored_milestone}_runs"] = flag(c("runs_scored") >= cfg.runs_scored_milestone)
    ex[f"allowed_under_{cfg.runs_allowed_milestone}_runs"] = flag(c("runs_allowed") < cfg.runs_allowed_milestone)
    ex["terrible_season"] = flag(c("wins") < cfg.terrible_wins)
    ex["historic_season"] = flag(c("wins") >= cfg.historic_wins)
    return df.withColumns(ex)


# ------------------------------------------------------------ entity history ---

def entity_history(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """WN1-WN6, WN15, WN24 on one shared window spec (one shuffle + one sort)."""
    w = entity_window(cfg)
    cols = [c(x) for x in df.columns]
    first = []
    for col in cfg.prev_columns:
        if col in df.columns:
            first.append(F.lag(col, 1).over(w).alias(f"prev_{col}"))
            for n in cfg.lag_years:
                if n != 1:
                    first.append(F.lag(col, n).over(w).alias(f"prev{n}_{col}"))
    for k in cfg.rolling_windows:
        for col in cfg.rolling_columns:
            if col in df.columns:
                first.append(F.avg(col).over(w.rowsBetween(-k, -1)).alias(f"{col}_{k}yr_avg"))
    for col in cfg.trend_columns:
        if col in df.columns:   # running non-null count = compacted x position (WN4)
            first.append(F.count(col).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__pos_{col}"))
    vol = w.rowsBetween(-9, 0)
    first.append(F.when(F.count("winning_percentage").over(vol) >= 3,
                        F.stddev_samp("winning_percentage").over(vol)).alias("performance_volatility"))
    rdg = div("run_differential", "total_games")
    first.append(rdg.alias("run_diff_per_game"))
    first.append(F.lead("made_playoffs", 1).over(w).alias("next_year_playoffs"))
    first.append(F.lead("wins", 1).over(w).alias("next_year_wins"))
    df = df.select(*cols, *first)

    k = cfg.trend_window
    tw = w.rowsBetween(-k, -1)
    second = {}
    for col in cfg.change_columns:
        if f"prev_{col}" in df.columns:
            second[f"{col}_change"] = c(col) - c(f"prev_{col}")
    for col in cfg.trend_columns:
        if col in df.columns:
            second[f"{col}_trend"] = F.when(F.count(col).over(tw) >= 2,
                                            F.regr_slope(c(col).cast("double"), c(f"__pos_{col}").cast("double"))
                                            .over(tw))
    rw = w.rowsBetween(-4, 0)
    second["run_diff_consistency"] = div(F.lit(1.0), 1 + F.stddev_samp("run_diff_per_game").over(rw))
    df = df.withColumns(second).drop(*[f"__pos_{col}" for col in cfg.trend_columns])
    return df


def consistency_features(df: DataFrame) -> DataFrame:
    """SC12-SC15."""
    ex = {"consistency_score": div(F.lit(1.0), 1 + c("performance_volatility"))}
    if "home_away_diff" in df.columns:
        ex["location_consistency"] = 1 - F.abs(c("home_away_diff"))
    ex["performance_reliability"] = 1 - F.abs(c("luck_pct"))
    return df.withColumns(ex)


def row_features(df: DataFrame, cfg: PanelConfig = DEFAULT) -> DataFrame:
    """All per-row (narrow) features and flags: SC1-SC11, SC20-SC24 and the era label."""
    df = performance_features(df)
    df = efficiency_features(df)
    df = pythagorean_features(df)
    df = momentum_features(df)
    if "era" not in df.columns:
        df = df.withColumn("era", era_open_case(c(cfg.period), cfg.era_starts))
    return target_flags(df, cfg)


RANK_BROADCAST_MAX_ROWS = 1_000_000
SMALL_TABLE_MAX_ROWS = 1_000_000


PERIOD_COLUMNS = ("offensive_rating", "defensive_rating", "league_strength", "competitive_balance", "relative_strength")
PLAYOFF_COLUMNS = ("made_playoffs", "next_year_playoffs")


def wanted_blocks(columns, cfg: PanelConfig) -> dict:
    """Which joined blocks some wanted column comes from, directly or through a lag, trend or derived column (these
    carry their source's name); everything, if ``columns`` is None.  Columns of windows and rows need no block: what
    nobody reads there Catalyst prunes."""
    def reads(*names):
        return columns is None or any(n in c for c in columns for n in names)
    return {"period": reads(*PERIOD_COLUMNS), "era": reads("_era_zscore", "era_run_environment", "offense_vs_era", "defense_vs_era"),
            "rank": reads("_percentile", "elite_team", "historical_dominance"), "playoff": reads(*PLAYOFF_COLUMNS)}


def engineer_features(df: DataFrame, cfg: PanelConfig = DEFAULT, materialize_base: str | None = "checkpoint", columns=None
                      ) -> DataFrame:
    """Full feature + target table from a preprocessed panel.

    Shape of the plan (the wide panel is shuffled once in the normal case):

    * ``base`` (all per-row features) is materialised once — every statistic
      reads it;
    * per-period / per-era / per-era-period statistics and the playoff keys are
      tiny aggregates joined with a checked broadcast (no shuffle of the panel);
    * percentile ranks come from one value histogram; when its checked size is
      small (the normal case: ranked columns have bounded value domains) the
      lookups are broadcast into the panel before the window, otherwise they run
      on a narrow projection joined back after the window;
    * the entity window (lags, rolling means, slopes, volatility, leads) is the
      shuffle of the wide panel, hash-partitioned on the entity.

    With ``columns`` only those are returned, and blocks that none of them reads are left out of the plan: no
    aggregation, rank histogram, counting job or join is made for them, and the base is materialised only if a block
    branches off it.
    """
    need = wanted_blocks(columns, cfg)
    if columns is not None:
        return _some_features(row_features(df, cfg), cfg, materialize_base, list(columns), need)
    base = materialize(row_features(df, cfg), materialize_base)
    stats = period_statistics(base, cfg)
    era, env = era_statistics(base, cfg)
    top = playoff_keys(base, cfg)
    specs = rank_specs(cfg)
    hist = value_histogram(base, specs)
    # size checks of the four small lookup tables and of the value histogram: one counting job
    (stats, era, env, top, hist), counts = persist_and_count([stats, era, env, top, hist])
    stats, era, env, top = [F.broadcast(t) if n <= SMALL_TABLE_MAX_ROWS else t
                            for t, n in zip((stats, era, env, top), counts[:4])]
    small = counts[4] <= RANK_BROADCAST_MAX_ROWS
    ranked = ranked_histogram(base, specs, hist=hist)
    out = apply_period_statistics(base, stats, cfg)
    out = apply_era_statistics(out, era, env, cfg)
    out = apply_playoff_keys(out, top, cfg)
    if small:
        out = entity_history(attach_ranks(out, ranked, specs, broadcast=True), cfg)
    else:
        out = entity_history(out, cfg)
        ranks = rank_table(base, [cfg.entity, cfg.period], specs, ranked=ranked, partition_by=[cfg.entity])
        out = out.join(ranks, [cfg.entity, cfg.period], "left")
    out = era_derived(out, cfg)
    return consistency_features(out)


def _some_features(base: DataFrame, cfg: PanelConfig, materialize_base, columns: list, need: dict) -> DataFrame:
    """The wanted columns from the wanted blocks; typed nulls stand in for the columns of blocks that nobody reads."""
    if any(need.values()):
        base = materialize(base, materialize_base)
    blank = lambda frame, names, kind: frame.withColumns({n: F.lit(None).cast(kind) for n in names})
    out, specs, tables = base, rank_specs(cfg), []
    if need["period"]:
        tables.append(period_statistics(base, cfg))
    if need["era"]:
        tables += era_statistics(base, cfg)
    if need["playoff"]:
        tables.append(playoff_keys(base, cfg))
    tables = broadcast_all_if_small(tables, SMALL_TABLE_MAX_ROWS) if tables else []      # one counting job
    if need["period"]:
        out = apply_period_statistics(out, tables.pop(0), cfg)
    else:
        out = blank(out, [*PERIOD_COLUMNS, "normalized_competitive_balance"], "double")
    if need["era"]:
        out = apply_era_statistics(out, tables.pop(0), tables.pop(0), cfg)
    else:
        out = blank(out, [*[f"{c_}_era_zscore" for c_ in cfg.era_columns], "era_run_environment"], "double")
    if need["playoff"]:
        out = apply_playoff_keys(out, tables.pop(0), cfg)
    else:
        out = blank(out, ["made_playoffs"], "int")
    if need["rank"]:
        specs = [s for s in specs if any(s[2] in c_ for c_ in columns) or any(k in c_ for c_ in columns for k in ("elite_team", "historical_dominance"))]
        out = out.join(rank_table(base, [cfg.entity, cfg.period], specs), [cfg.entity, cfg.period], "left")
    out = blank(out, [o for _, _, o in rank_specs(cfg) if o not in out.columns], "double")
    return consistency_features(era_derived(entity_history(out, cfg), cfg)).select(*columns)
