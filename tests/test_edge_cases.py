"""Hand-computed fixtures for the semantic decisions."""


from pyspark.sql import functions as F

from pennant.config import DEFAULT, SYNTHETIC
from pennant.functions import scalar as S
from pennant.functions.safe import div, safe_divide
from pennant.operators import clean as C
from pennant.operators import metrics_cls as MC
from pennant.operators.ranking import average_rank_pct, group_rank
from pennant.plans import features as FE
from pennant.plans.preprocess import preprocess
from pennant.sources.dims import era_case, era_open_case


def panel(spark, rows):
    return spark.createDataFrame(rows, "team_name string, year int, wins int, losses int, runs_scored int, "
                                       "runs_allowed int, winning_percentage double, run_differential int, "
                                       "games_behind double")


def _row(t, y, w, l=None, rs=700, ra=700, gb=1.0):
    l = 162 - w if l is None else l
    return (t, y, w, l, rs, ra, w / (w + l) if w + l else None, rs - ra, gb)


def test_lag_does_not_leak_across_entities(spark):
    # Q1: first row of every entity has no previous value
    rows = [_row("A", 2000 + i, 80 + i) for i in range(3)] + [_row("B", 2000 + i, 60 + i) for i in range(3)]
    f = FE.engineer_features(panel(spark, rows), DEFAULT, materialize_base=None)
    r = {(x.team_name, x.year): x for x in f.select("team_name", "year", "prev_wins", "wins_3yr_avg").collect()}
    assert r[("B", 2000)].prev_wins is None and r[("B", 2000)].wins_3yr_avg is None
    assert r[("B", 2001)].prev_wins == 60
    assert r[("A", 2002)].wins_3yr_avg == 80.5


def test_record_and_streak_parsing(spark):
    # Q2 / CL6-CL9: nulls stay null, blanks become defaults, '-' games behind is a leader
    raw = spark.createDataFrame(
        [("T", 2000, "50", "31", " 40-41 ", None, " ", "-"), ("U", 2000, "x", "31", "abc", "7-3", "L12", "2.5"),
         ("V", 2000, "5", "5", "", "", "Wx", None)],
        "team_name string, year int, wins string, losses string, record_at_home string, "
        "record_in_the_last_10_games string, current_streak string, games_behind string")
    p = {r.team_name: r for r in preprocess(raw, DEFAULT).collect()}
    assert p["T"].at_home_wins == 40 and p["T"].last_10_wins == 5 and p["T"].streak_type == "W"
    assert p["T"].streak_length == 0 and p["T"].games_behind is None
    assert p["U"].wins is None and p["U"].at_home_wins is None and p["U"].last_10_pct == 0.7
    assert p["U"].streak_type == "L" and p["U"].streak_length == 12 and p["U"].games_behind == 2.5
    assert p["V"].at_home_wins is None and p["V"].streak_length == 0 and p["V"].on_winning_streak == 1


def test_playoff_ties_broken_by_entity(spark):
    # Q15: 8 spots in 1995+, ties at the cut go to the smaller entity name
    rows = [_row(f"T{i:02d}", 2000, 90 - (i // 2)) for i in range(12)]
    f = FE.engineer_features(panel(spark, rows), DEFAULT, materialize_base=None)
    made = sorted(r.team_name for r in f.where("made_playoffs = 1").collect())
    assert made == [f"T{i:02d}" for i in range(8)]


def test_average_rank_with_ties_and_null(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 20.0), ("c", 1, 20.0), ("d", 1, None), ("e", 1, 30.0)],
                               "k string, g int, v double")
    r = {x.k: x.pct for x in average_rank_pct(df, [(["g"], "v", "pct")]).collect()}
    assert r == {"a": 0.25, "b": 0.625, "c": 0.625, "d": None, "e": 1.0}
    m = {x.k: x.r for x in group_rank(df, [(["g"], "v", "r", "min", True)]).collect()}
    assert m == {"a": 4, "b": 2, "c": 2, "d": None, "e": 1}


def test_volatility_needs_three_and_slope_skips_nulls(spark):
    rows = [_row("A", 2000 + i, w) for i, w in enumerate([80, 82, 84, 90, 70])]
    rows[2] = ("A", 2002, None, 78, 700, 700, None, 0, 1.0)     # null inside the slope window
    f = FE.engineer_features(panel(spark, rows), DEFAULT, materialize_base=None).orderBy("year").collect()
    assert f[1].performance_volatility is None            # two observations
    assert f[2].wins_trend == 2.0                          # values 80, 82 -> slope 2
    # the window at 2004 (rows t-5..t-1) holds 80, 82, null, 90: nulls are dropped and
    # x is the position among the remaining values (0, 1, 2) -> slope 5
    assert abs(f[4].wins_trend - 5.0) < 1e-12


def test_zero_denominators_are_null_not_inf(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (4, 2)], "a int, b int")
    r = df.select(div("a", "b").alias("d"), safe_divide("a", "b", 1.0).alias("s")).collect()
    assert [x.d for x in r] == [None, None, 2.0] and [x.s for x in r] == [1.0, 1.0, 2.0]


def test_calibration_bins_exclude_one(spark):
    # Q19: p = 1.0 falls in no bin but stays in the denominator
    df = spark.createDataFrame([(1, 1.0), (1, 0.95), (0, 0.05), (0, 0.15)], "label int, p double")
    r = MC.calibration_errors(df).first()
    expected = (1 * abs(1 - 0.95) + 1 * abs(0 - 0.05) + 1 * abs(0 - 0.15)) / 4
    assert abs(r.ece - expected) < 1e-12
    ll = MC.probability_losses(spark.createDataFrame([(1, 1.0), (0, 0.0)], "label int, p double")).first()
    assert ll.log_loss < 1e-12


def test_bin_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 65.0, 65.1, 163.0, 69.0, 70.0, 81.0, 95.0)], "w double")
    r = df.select("w", S.projection_category("w").alias("c"), S.performance_tier("w").alias("t")).collect()
    got = {x.w: (x.c, x.t) for x in r}
    assert got[0.0] == (None, 0) and got[65.0] == ("Terrible", 0) and got[65.1] == ("Poor", 0)
    assert got[163.0][0] == "Elite" and got[69.0][1] == 0 and got[70.0][1] == 1 and got[81.0][1] == 2
    assert got[95.0] == ("Good", 4)


def test_alias_dimension_deduplicated(spark):
    # Q5: a historical name mapped twice keeps the last stated mapping
    df = spark.createDataFrame([("Old", 2000)], "team_name string, year int")
    al = spark.createDataFrame([("Old", "First", 0), ("Old", "Second", 1)], "historical string, current string, priority int")
    assert C.normalize_names(df, al).first().team_name == "Second"


def test_era_boundaries(spark):
    df = spark.createDataFrame([(y,) for y in (1900, 1919, 1920, 1942, 1947, 2025, 2030)], "year int")
    r = {x.year: (x.closed, x.open) for x in df.select(
        "year", era_case(F.col("year"), DEFAULT.era_ranges).alias("closed"),
        era_open_case(F.col("year"), DEFAULT.era_starts).alias("open")).collect()}
    assert r[1900] == ("unknown", "dead_ball") and r[1919] == ("dead_ball", "dead_ball")
    assert r[1920][0] == "live_ball" and r[1942][1] == "integration" and r[2030] == ("unknown", "modern")


def test_synthetic_config_is_distinct():
    assert SYNTHETIC.win_milestones != DEFAULT.win_milestones and DEFAULT.win_milestones == (90, 95, 100)


def test_decomposition_window_widths(spark):
    """WN19: width = min(5, n // 2) per entity; even widths cover rows [-w/2, w/2 - 1]."""
    from pennant.operators.windows import decompose
    series = {"n1": [10], "n2": [10, 20], "n4": [10, 20, 40, 80], "n5": [1, 2, 3, 4, 5],
              "n9": [1, 4, 9, 16, 25, 36, 49, 64, 81]}
    rows = [(t, 2000 + i, float(v)) for t, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "team_name string, year int, wins double")
    got = {(r.team_name, r.year - 2000): r.trend for r in decompose(df, "wins").collect()}
    assert got[("n1", 0)] is None                                  # width 0: no trend
    assert [got[("n2", i)] for i in range(2)] == [10.0, 20.0]      # width 1: the value itself
    assert [got[("n4", i)] for i in range(4)] == [None, 15.0, 30.0, 60.0]        # width 2: rows [-1, 0]
    assert [got[("n5", i)] for i in range(5)] == [None, 1.5, 2.5, 3.5, 4.5]      # width 2
    w4 = [None, None, (1 + 4 + 9 + 16) / 4, (4 + 9 + 16 + 25) / 4, (9 + 16 + 25 + 36) / 4,
          (16 + 25 + 36 + 49) / 4, (25 + 36 + 49 + 64) / 4, (36 + 49 + 64 + 81) / 4, None]  # width 4: rows [-2, 1]
    assert [got[("n9", i)] for i in range(9)] == w4


def test_gap_year_is_not_a_gap(spark):
    """Q14: windows are row based — the season before a missing year is 'previous'."""
    rows = [_row("A", 2000, 80), _row("A", 2001, 84), _row("A", 2003, 90)]
    f = FE.engineer_features(panel(spark, rows), DEFAULT, materialize_base=None).orderBy("year").collect()
    assert f[2].prev_wins == 84 and f[2].wins_change == 6
    assert f[0].run_diff_consistency is None            # a single observation has no std
    assert f[1].run_diff_consistency is not None
