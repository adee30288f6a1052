"""Derived panels over the driver tables.

``raw_team_season`` builds the raw entity x period table the feature pipeline
expects (one row per team and season, counts plus "W-L" text columns) from
``lineitem`` and ``supplier``:

* entity = supplier (``team_id`` = ``l_suppkey``), period = ship year;
* a line is a win unless its return flag is ``R``; runs scored/allowed are the
  quantities of open/finished lines; odd line numbers are home games; lines
  with discount >= 0.05 are games against top teams;
* the division is the supplier's nation; ``games_behind`` is measured against
  the division's best (wins - losses), ``wild_card_games_behind`` against the
  season's best, with ``'-'`` for the leader, as in published standings.

Work: one partial+final hash aggregation of ``lineitem`` (map-side combine, so
a hot supplier costs nothing extra), materialised once (the lead aggregates
re-read it; without the cut each branch would re-scan ``lineitem`` because
column pruning makes the branches' exchanges differ), one join with
``supplier`` and two tiny aggregates (season x division, season) joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.session import materialize
from pennant.sources.tables import read_table


def _gb_text(diff: F.Column) -> F.Column:
    """Half-game difference (an int count of half games) as standings text."""
    return (F.when(diff == 0, F.lit("-"))
            .otherwise(F.concat((diff / 2).cast("int").cast("string"),
                                F.when(diff % 2 == 1, F.lit(".5")).otherwise(F.lit("")))))


def _record(w: F.Column, l: F.Column) -> F.Column:
    return F.concat(w.cast("string"), F.lit("-"), l.cast("string"))


def season_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(team_id, year) counts from ``lineitem`` — the only pass over the fact table."""
    return season_counts_from(read_table(spark, sf_dir, "lineitem"))


def season_counts_from(li: DataFrame) -> DataFrame:
    """Partial + final hash aggregation: each task pre-aggregates its lines per
    (supplier, year) before the shuffle, so a supplier holding a third of all
    lines sends one row per task, not a third of the data."""
    won = F.col("l_returnflag") != "R"
    lost = F.col("l_returnflag") == "R"
    home = (F.col("l_linenumber") % 2) == 1
    top = F.col("l_discount") >= 0.05

    def n(c):
        return F.count_if(c).cast("int")

    return (li.groupBy(F.col("l_suppkey").alias("team_id"),
                       F.year("l_shipdate").cast("int").alias("year"))
            .agg(n(won).alias("wins"), n(lost).alias("losses"),
                 F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0))
                  .cast("int").alias("runs_scored"),
                 F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0))
                  .cast("int").alias("runs_allowed"),
                 n(won & home).alias("hw"), n(lost & home).alias("hl"),
                 n(won & ~home).alias("aw"), n(lost & ~home).alias("al"),
                 n(won & top).alias("tw"), n(lost & top).alias("tl")))


def quarter_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``team_name``, ``quarter`` (4 * year + quarter - 1), ``wins``, ``run_differential``: a longer series per team
    (about 28 quarters) for forecasts that need at least ten periods.  One partially aggregated pass."""
    li = read_table(spark, sf_dir, "lineitem")
    runs = F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity"))
    return (li.groupBy(F.concat(F.lit("Team "), F.col("l_suppkey").cast("string")).alias("team_name"),
                       (F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1).cast("int").alias("quarter"))
            .agg(F.count_if(F.col("l_returnflag") != "R").cast("int").alias("wins"), F.sum(runs).cast("int").alias("run_differential")))


def raw_team_season(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """Raw team-season table with the original application's column set."""
    c = materialize(season_counts(spark, sf_dir), "checkpoint")
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("team_id"), F.col("s_nationkey").alias("division_id"))
    p = c.join(sup, "team_id", "left").withColumn("wl", F.col("wins") - F.col("losses"))
    div_lead = p.groupBy("year", "division_id").agg(F.max("wl").alias("div_lead"))
    season_lead = p.groupBy("year").agg(F.max("wl").alias("season_lead"))
    p = p.join(div_lead, ["year", "division_id"], "left").join(season_lead, "year", "left")

    tid = F.col("team_id")
    yr = F.col("year")
    w, l = F.col("wins"), F.col("losses")
    rs, ra = F.col("runs_scored").cast("long"), F.col("runs_allowed").cast("long")
    games = (w + l).cast("long")
    ew = (games * rs * rs).cast("long") / (rs * rs + ra * ra)
    ew = F.floor(ew).cast("int")
    last10 = F.pmod(w, F.lit(11))
    cols = [
        F.when((yr <= 1996) & (F.pmod(tid, F.lit(7)) == 3),
               F.concat(F.lit("Old Team "), tid.cast("string")))
         .otherwise(F.concat(F.lit("Team "), tid.cast("string"))).alias("team_name"),
        yr.alias("year"),
        w.alias("wins"), l.alias("losses"),
        F.round(w / (w + l), 3).alias("winning_percentage"),
        _gb_text(F.col("div_lead") - F.col("wl")).alias("games_behind"),
        _gb_text(F.col("season_lead") - F.col("wl")).alias("wild_card_games_behind"),
        F.col("runs_scored"), F.col("runs_allowed"),
        (F.col("runs_scored") - F.col("runs_allowed")).alias("run_differential"),
        F.when(F.pmod(tid * yr, F.lit(29)) == 0, F.lit(""))
         .otherwise(_record(F.col("hw"), F.col("hl"))).alias("record_at_home"),
        _record(F.col("aw"), F.col("al")).alias("record_when_away"),
        _record(F.col("tw"), F.col("tl")).alias("record_against_top_50_percent"),
        F.when(F.pmod(tid + yr, F.lit(13)) == 0, F.lit(None).cast("string"))
         .otherwise(_record(last10, 10 - last10)).alias("record_in_the_last_10_games"),
        F.when(F.pmod(F.col("runs_scored"), F.lit(17)) == 0, F.lit(None).cast("string"))
         .when(F.pmod(F.col("runs_scored"), F.lit(17)) == 1, F.lit(" "))
         .otherwise(F.concat(F.when(F.col("hw") >= F.col("aw"), F.lit("W")).otherwise(F.lit("L")),
                             F.pmod(w, F.lit(9)).cast("string"))).alias("current_streak"),
        _record(ew, games.cast("int") - ew).alias("expected_win_loss_record"),
    ]
    if keep_keys:
        cols += [tid, F.col("division_id")]
    return p.select(*cols)


def team_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity dimension: team name -> division (nation) -> league (region)."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey, "left")
            .join(reg, F.col("n_regionkey") == reg.r_regionkey, "left")
            .select(F.concat(F.lit("Team "), F.col("s_suppkey").cast("string")).alias("team_name"),
                    F.col("n_name").alias("division"), F.col("r_name").alias("league")))


def team_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical -> current name dimension (one historical name per 7th supplier)."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    return (sup.where(F.pmod(F.col("s_suppkey"), F.lit(7)) == 3)
            .select(F.concat(F.lit("Old Team "), F.col("s_suppkey").cast("string")).alias("historical"),
                    F.concat(F.lit("Team "), F.col("s_suppkey").cast("string")).alias("current"),
                    F.lit(0).alias("priority")))
