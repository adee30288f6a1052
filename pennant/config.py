"""Panel parameters.

Every threshold, cut point and label used by the feature, target and report
operators lives in :class:`PanelConfig`.  ``DEFAULT`` carries the values of the
original application; ``SYNTHETIC`` carries cut points chosen up front from the
driver tables' distribution (seasons 1995-2001, ~88 games, ~57 wins median) so
that every flag and era actually fires on the test panel.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the original application's constants for equal
# results).  Kept verbatim and in natural order.
# ---------------------------------------------------------------------------

# Closed year ranges per era; years outside all ranges are 'unknown'.
ERA_RANGES = (
    ("dead_ball", 1901, 1919),
    ("live_ball", 1920, 1941),
    ("integration", 1942, 1962),
    ("expansion", 1963, 1976),
    ("free_agency", 1977, 1993),
    ("steroid", 1994, 2005),
    ("modern", 2006, 2025),
)
# Open-ended variant used inside feature engineering: (name, first year).
ERA_STARTS = (
    ("dead_ball", None),
    ("live_ball", 1920),
    ("integration", 1942),
    ("expansion", 1963),
    ("free_agency", 1977),
    ("steroid", 1994),
    ("modern", 2006),
)
# Display variant (different cut years).
DISPLAY_ERA_STARTS = (
    ("dead_ball", None),
    ("live_ball", 1920),
    ("integration", 1947),
    ("expansion", 1969),
    ("free_agency", 1977),
    ("steroid", 1994),
    ("modern", 2006),
)
# Playoff spots step rule: (first year, spots).
PLAYOFF_SPOT_STEPS = ((None, 2), (1969, 4), (1995, 8), (2012, 10))
# Playoff structure table variant: (name, first year, last year, teams).
PLAYOFF_STRUCTURE = (
    ("pre_division", 1901, 1968, 2),
    ("division_era", 1969, 1993, 4),
    ("wild_card_era", 1994, 2011, 8),
    ("expanded_wild_card", 2012, 2021, 10),
    ("expanded_playoffs", 2022, 2025, 12),
)
GAMES_PER_SEASON = {"modern": 162, "classic": 154, "early": 140}
SHORTENED_SEASONS = {1981: 110, 1994: 113, 1995: 144, 2020: 60}
# Era-specific elite-win thresholds; any other era uses 'modern'.
ERA_ELITE_WINS = {"dead_ball": 90, "live_ball": 95, "modern": 95}
MILESTONE_THRESHOLDS = {
    "wins": {"terrible": 65, "poor": 75, "average": 81, "good": 90,
             "excellent": 95, "elite": 100, "historic": 105},
    "runs_scored": {"low": 650, "below_average": 700, "average": 750,
                    "above_average": 800, "high": 850, "elite": 900},
    "runs_allowed": {"elite": 600, "excellent": 650, "good": 700, "average": 750,
                     "below_average": 800, "poor": 850},
    "run_differential": {"terrible": -150, "poor": -75, "below_average": -25,
                         "average": 0, "above_average": 50, "good": 100,
                         "excellent": 150, "elite": 200},
}
# Performance tier bins, left-closed: [0,70) [70,81) [81,90) [90,95) [95,inf).
TIER_CUTS = (70, 81, 90, 95)
TIER_LABELS = ("Rebuilding", "Below Average", "Average", "Contender", "Elite")
# Projection categories, right-closed: (0,65] (65,75] (75,85] (85,95] (95,105] (105,163].
PROJECTION_CUTS = (0, 65, 75, 85, 95, 105, 163)
PROJECTION_LABELS = ("Terrible", "Poor", "Below Average", "Good", "Excellent", "Elite")
# Report tiers for projected wins.
REPORT_WIN_TIERS = ((95, "Elite team projection with strong championship potential"),
                    (90, "Solid playoff contender with division title possibilities"),
                    (85, "Wild card contender in competitive position"),
                    (81, "Above .500 team with outside playoff chances"),
                    (None, "Rebuilding phase with focus on development"))
REPORT_DIVISION_TIERS = ((0.5, "Favored to win division"), (0.25, "Strong division contender"))
CONFIDENCE_HIGH = 0.7
CONFIDENCE_MEDIUM = 0.4
BENCHMARKS_CLASSIFICATION = (("excellent", 0.90, 0.85), ("good", 0.80, 0.75),
                             ("acceptable", 0.70, 0.65))  # (level, roc_auc, accuracy)
BENCHMARKS_REGRESSION = (("excellent", 5.0, 0.80), ("good", 8.0, 0.65),
                         ("acceptable", 12.0, 0.50))  # (level, rmse, r2)
# Rename mapping applied while cleaning.
TEAM_RENAMES = {
    "California Angels": "Los Angeles Angels",
    "Anaheim Angels": "Los Angeles Angels",
    "Florida Marlins": "Miami Marlins",
    "Montreal Expos": "Washington Nationals",
}
# End of fixed values.


@dataclass(frozen=True)
class PanelConfig:
    """Parameters of the panel operators (entity x period)."""

    entity: str = "team_name"
    period: str = "year"
    era_ranges: tuple = ERA_RANGES
    era_starts: tuple = ERA_STARTS
    playoff_steps: tuple = PLAYOFF_SPOT_STEPS
    max_playoff_spots: int = 12
    win_milestones: tuple = (90, 95, 100)
    runs_scored_milestone: int = 800
    runs_allowed_milestone: int = 650
    terrible_wins: int = 65
    historic_wins: int = 105
    era_elite_wins: dict = field(default_factory=lambda: dict(ERA_ELITE_WINS))
    era_elite_default: int = 95
    modern_strategy_years: tuple = (2006, 2024)
    leader_rule: str = "null"  # 'null' | 'null_or_zero'
    prev_columns: tuple = ("wins", "losses", "run_differential", "winning_percentage",
                           "pythagorean_win_pct", "runs_per_game", "runs_allowed_per_game")
    rolling_columns: tuple = ("wins", "run_differential", "winning_percentage")
    rolling_windows: tuple = (3, 5)
    change_columns: tuple = ("wins", "run_differential")
    trend_columns: tuple = ("wins", "run_differential", "winning_percentage")
    trend_window: int = 5
    era_columns: tuple = ("wins", "winning_percentage", "run_differential",
                          "runs_per_game", "runs_allowed_per_game")
    lag_years: tuple = (1,)
    games_in_season: int = 162

    def with_(self, **kw) -> "PanelConfig":
        return replace(self, **kw)


DEFAULT = PanelConfig()

# Cut points for the driver's synthetic panel (1995-2001, ~88 games per season).
SYNTHETIC = PanelConfig(
    entity="team_name",
    period="year",
    era_ranges=(("early", 1995, 1996), ("middle", 1997, 1998), ("late", 1999, 2001)),
    era_starts=(("early", None), ("middle", 1997), ("late", 1999)),
    win_milestones=(60, 65, 70),
    runs_scored_milestone=1200,
    runs_allowed_milestone=900,
    terrible_wins=45,
    historic_wins=75,
    era_elite_wins={"early": 70, "middle": 72},
    era_elite_default=74,
    modern_strategy_years=(1997, 2001),
    games_in_season=88,
)
