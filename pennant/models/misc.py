"""Small model-side operators that are pure aggregations (ML13, ML31, ML40,
ML41, ML42)."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.functions.safe import attach_scalars, div
from pennant.operators.vectors import vector_sums

# Feature-group rules in evaluation order (first match wins).
FEATURE_GROUP_RULES = (
    ("performance", ("home", "away", "vs_top")),
    ("efficiency", ("runs_per", "efficiency", "rating")),
    ("pythagorean", ("pythagorean", "luck")),
    ("historical", ("prev_", "_avg", "_change")),
    ("trend", ("trend", "momentum", "streak")),
    ("strength", ("strength", "percentile", "elite")),
    ("consistency", ("consistency", "volatility")),
    ("era_adjusted", ("era",)),
)
RAW_COLUMNS = ("team_name", "year", "wins", "losses", "winning_percentage", "games_behind", "wild_card_games_behind",
               "runs_scored", "runs_allowed", "run_differential", "record_at_home", "record_when_away",
               "record_against_top_50_percent", "record_in_the_last_10_games", "current_streak",
               "expected_win_loss_record")


def feature_group(name: str) -> str | None:
    for group, keys in FEATURE_GROUP_RULES:
        if any(k in name for k in keys):
            return group
    return None


def feature_groups(columns, exclude=()) -> dict:
    """Groups of engineered feature names, in column order (no job: schema only)."""
    out = {g: [] for g, _ in FEATURE_GROUP_RULES}
    for c in columns:
        if c in RAW_COLUMNS or c in exclude:
            continue
        g = feature_group(c)
        if g:
            out[g].append(c)
    return out


# Which feature groups a model type takes, in order: (group, part of the name or None, limit or None).
MODEL_FEATURES = {
    "division_winner": (("performance", None, None), ("efficiency", None, None), ("pythagorean", None, None),
                        ("historical", "prev_", None), ("trend", None, 5)),
    "win_total": (("performance", None, None), ("efficiency", None, None), ("pythagorean", None, None),
                  ("historical", None, None), ("consistency", None, None)),
    "milestone": (("performance", None, 10), ("efficiency", None, None), ("strength", None, None),
                  ("era_adjusted", None, 5)),
}


def select_features(columns, model_type: str, exclude=(), wanted=MODEL_FEATURES) -> list:
    """ML31 — feature list per model type from a metadata table; duplicates keep their first place.  A model type
    that the table doesn't name takes every engineered column."""
    if model_type not in wanted:
        return list(dict.fromkeys(c for c in columns if c not in RAW_COLUMNS and c not in exclude))
    groups = feature_groups(columns, exclude)
    return list(dict.fromkeys(c for group, part, limit in wanted[model_type]
                              for c in [x for x in groups[group] if part is None or part in x][:limit]))


def fit_pythagorean_exponent(df: DataFrame, rs="runs_scored", ra="runs_allowed", wins="wins", games="total_games",
                             lo: float = 1.5, hi: float = 3.0, step: float = 0.01, fine_step: float = 0.0001) -> DataFrame:
    """ML13 — exponent in [lo, hi] minimising the MSE of games·rs^e/(rs^e+ra^e)
    against wins: a coarse grid, then a fine grid around the coarse optimum.  A
    pass adds up one vector per task, a squared error for each grid point; of
    equal errors the smaller exponent wins.  Rows with a null take no part; nulls
    without rows."""
    base = df.select(*[F.col(c).cast("double").alias(n) for n, c in (("rs", rs), ("ra", ra), ("w", wins), ("g", games))]).na.drop()
    n, m = int(round((hi - lo) / step)), int(round(step / fine_step))

    def errors(grid: list[float]) -> list[float]:
        def add(batch):
            rs_, ra_, w, g = (batch[c].to_numpy() for c in ("rs", "ra", "w", "g"))
            out = np.zeros(len(grid) + 1)
            out[-1] = len(w)
            for i, e in enumerate(grid):
                top = rs_ ** e
                with np.errstate(invalid="ignore"):
                    out[i] = np.sum((g * top / (top + ra_ ** e) - w) ** 2)
            return out
        return vector_sums(base, add, len(grid) + 1).first()["sums"]

    def best(grid: list[float]) -> tuple[float | None, float | None]:
        *sums, rows = errors(grid)
        return min(zip([s / rows for s in sums], grid))[::-1] if rows else (None, None)

    top, _ = best([lo + k * step for k in range(n + 1)])
    found = (None, None) if top is None else best([e for e in (top + k * fine_step for k in range(-m, m + 1)) if lo - 1e-12 <= e <= hi + 1e-12])
    return df.sparkSession.createDataFrame([found], "exponent double, mse double")


def milestone_report(df: DataFrame, prob_cols) -> DataFrame:
    """ML40 — per milestone: mean probability and count of rows with p >= 0.5,
    most likely first (one unpivot + one aggregation)."""
    items = [F.struct(F.lit(c).alias("milestone"), F.col(c).cast("double").alias("p")) for c in prob_cols]
    long = df.select(F.inline(F.array(*items)))
    return long.groupBy("milestone").agg(F.avg("p").alias("mean_probability"),
                                         F.count_if(F.col("p") >= 0.5).alias("n_likely")) \
        .orderBy(F.desc("mean_probability"), "milestone")


def psi(expected: DataFrame, actual: DataFrame, column: str, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """ML41 — population stability index over the expected frame's decile edges:
    sum (a - e) ln(a / e) over bins (shares floored at eps); thresholds 0.1 / 0.15."""
    qs = [i / bins for i in range(1, bins)]
    from pennant.operators.ranking import quantiles
    edges = quantiles(expected, column, qs).withColumnRenamed("quantiles", "__edges")

    def binned(frame, name):
        b = F.aggregate(F.col("__edges"), F.lit(0), lambda acc, e: acc + F.when(F.col(column) > e, 1).otherwise(0))
        d = attach_scalars(frame.where(F.col(column).isNotNull()), edges).withColumn("bin", b)
        tot = frame.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("__n"))
        return attach_scalars(d.groupBy("bin").agg(F.count(F.lit(1)).alias("__c")), tot) \
            .select("bin", (F.col("__c") / F.col("__n")).alias(name))

    e, a = binned(expected, "e_share"), binned(actual, "a_share")
    j = e.join(a, "bin", "full").select(F.greatest(F.coalesce("e_share", F.lit(0.0)), F.lit(eps)).alias("e"),
                                       F.greatest(F.coalesce("a_share", F.lit(0.0)), F.lit(eps)).alias("a"))
    r = j.agg(F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi"))
    return r.withColumn("drift_level", F.when(F.col("psi") >= 0.15, "significant").when(F.col("psi") >= 0.1, "moderate")
                        .otherwise("none"))


def drift(df: DataFrame, column: str, period: str = "year", until: int | None = None, bins: int = 10) -> DataFrame:
    """ML41 — :func:`psi` between the periods up to ``until`` and all later ones (by default the middle of the range, so
    that every period is read); null without rows."""
    if until is None:
        low, high = df.agg(F.min(period), F.max(period)).first()
        until = 0 if low is None else (low + high) // 2
    return psi(df.where(F.col(period) <= until), df.where(F.col(period) > until), column, bins)


def poisson_cdf(resolution: float = 16.0 ** -13) -> list:
    """Distribution function of Poisson(1), up to the first value whose tail is below the hash's resolution."""
    cdf, term, k = [], math.exp(-1), 0
    while not cdf or term > resolution:
        cdf.append((cdf[-1] if cdf else 0.0) + term)
        k += 1
        term /= k
    return cdf


POISSON_CDF = poisson_cdf()


def poisson_weights(prefix: str, suffixes: list[bytes]) -> np.ndarray:
    """Poisson(1) draws of one row: from the first 52 bits of md5(prefix + suffix), one suffix per replicate."""
    first = hashlib.md5(prefix.encode())
    digests = bytearray()
    for s in suffixes:
        h = first.copy()
        h.update(s)
        digests += h.digest()[:8]
    u = ((np.frombuffer(digests, ">u8") >> 12).astype(np.float64) + 0.5) / float(16 ** 13)
    return np.searchsorted(np.array(POISSON_CDF), u, side="left")


def poisson_bootstrap(df: DataFrame, value: str, replicates: int = 1000, level: float = 0.95, seed: int = 42,
                      keys=("team_name", "year")) -> DataFrame:
    """ML42 — bootstrap interval of a mean without resampling rows: every row
    gets a Poisson(1) weight per replicate from a hash of (key, replicate,
    seed); a task adds up two vectors, weights and weighted values of all
    replicates; the interval is the percentile of replicate means."""
    d = df.select(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit("")).alias("key"), F.col(value).cast("double").alias("v"))
    suffixes = [f"{rep}|{seed}".encode() for rep in range(replicates)]

    def add(batch):
        out = np.zeros((2, replicates))
        for key, v in zip(batch["key"], batch["v"].to_numpy()):
            w = poisson_weights(key, suffixes)
            out[0] += w
            out[1] += w * v
        return out.ravel()

    sums = vector_sums(d.where(F.col("v").isNotNull()), add, 2 * replicates)
    pairs = F.arrays_zip(F.slice("sums", 1, replicates).alias("w"), F.slice("sums", replicates + 1, replicates).alias("s"))
    reps = sums.select(F.inline(pairs)).toDF("w", "s").select(div(F.col("s"), F.col("w")).alias("__m"))
    a = (1 - level) / 2
    return reps.agg(F.percentile("__m", [a, 1 - a]).alias("__ci"), F.avg("__m").alias("bootstrap_mean")) \
        .select("bootstrap_mean", F.col("__ci")[0].alias("lower"), F.col("__ci")[1].alias("upper"))
