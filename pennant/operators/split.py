"""Sampling and splitting (SP1-SP9).

Splits are *columns*, not separate DataFrames: one pass labels every row with
its role / fold, and consumers filter.  Randomness comes from a stable hash
of the key and a seed (``stable_hash``: the first 13 hex digits of md5, an
exact integer in double precision, identical in any engine), so a split is
reproducible, needs no driver state and survives recomputation after an
executor loss.

Exact stratified proportions need the rank of each row's hash inside its
class; that rank comes from the histogram + prefix-count helper (range
partitions, so a large class is spread), not from a window over a whole class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions.safe import attach_scalars
from pennant.operators.ranking import group_rank

HASH_SPACE = float(16 ** 13)


def stable_hash(keys, seed: int = 42) -> Column:
    """Deterministic 52-bit hash of the key columns and a seed."""
    s = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("long")


def _round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("long")


def stratified_split(df: DataFrame, label: str, keys, test: float = 0.2, val: float = 0.1,
                     seed: int = 42) -> DataFrame:
    """SP1 — exact per-class proportions: in each class, the rows with the
    smallest hashes form test (round(test·n_c)), then val (round(val·n_c)),
    the rest train.  Adds ``split``."""
    d = df.withColumn("__h", stable_hash(keys, seed))
    d = group_rank(d, [([label], "__h", "__r", "min", False)])
    n = d.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    d = d.join(n, label, "left")
    nt = _round_half_up(F.col("__nc") * test)
    nv = _round_half_up(F.col("__nc") * val)
    role = F.when(F.col("__r") <= nt, "test").when(F.col("__r") <= nt + nv, "val").otherwise("train")
    return d.withColumn("split", role).drop("__h", "__r", "__nc")


def quantile_period_split(df: DataFrame, keys, period="year", q: float = 0.8, val: float = 0.2,
                          seed: int = 42) -> DataFrame:
    """SP2 — periods above the q-quantile are test; of the rest, the
    round(val·n) smallest hashes are validation."""
    cut = df.agg(F.percentile(F.col(period).cast("double"), q).alias("__cut"))
    d = attach_scalars(df, cut).withColumn("__test", F.col(period) > F.col("__cut"))
    d = d.withColumn("__h", stable_hash(keys, seed))
    d = group_rank(d, [(["__test"], "__h", "__r", "min", False)])
    n = d.where(~F.col("__test")).agg(F.count(F.lit(1)).alias("__n"))
    d = attach_scalars(d, n)
    role = (F.when(F.col("__test"), "test").when(F.col("__r") <= _round_half_up(F.col("__n") * val), "val")
            .otherwise("train"))
    return d.withColumn("split", role).drop("__cut", "__test", "__h", "__r", "__n")


def last_periods_split(df: DataFrame, n_test: int = 3, period="year") -> DataFrame:
    """SP3 — the last ``n_test`` periods are test (max period: one-row aggregate)."""
    mx = df.agg(F.max(period).alias("__mx"))
    d = attach_scalars(df, mx)
    return d.withColumn("split", F.when(F.col(period) > F.col("__mx") - n_test, "test").otherwise("train")).drop("__mx")


def three_way_period_split(df: DataFrame, test_period: int, period="year") -> DataFrame:
    """SP4 — train < t-1, val = t-1, test >= t."""
    p = F.col(period)
    return df.withColumn("split", F.when(p >= test_period, "test").when(p == test_period - 1, "val")
                         .otherwise("train"))


def kfold(df: DataFrame, keys, k: int = 5, seed: int = 42) -> DataFrame:
    """SP5 — fold = hash mod k (shuffled k-fold; no ordering, no shuffle)."""
    return df.withColumn("fold", F.pmod(stable_hash(keys, seed), F.lit(k)).cast("int"))


def stratified_kfold(df: DataFrame, label: str, keys, k: int = 5, seed: int = 42) -> DataFrame:
    """SP6 — fold = (rank of the hash inside the class - 1) mod k: every class
    is dealt round-robin over the folds."""
    d = df.withColumn("__h", stable_hash(keys, seed))
    d = group_rank(d, [([label], "__h", "__r", "min", False)])
    return d.withColumn("fold", F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__h", "__r")


def time_series_folds(df: DataFrame, k: int = 3, gap: int = 0, max_train: int | None = None,
                      period="year") -> DataFrame:
    """SP7 / SP8 — expanding-window folds over the ordered distinct periods:
    test size = n // (k+1) periods; fold i tests the periods at positions
    [n - (k-i)·t, n - (k-i-1)·t) and trains on the ones before (minus ``gap``,
    at most ``max_train``).  Splitting on period values keeps every period's
    rows together and needs only the tiny distinct-period table ordered.
    Output: one row per (row, fold) the row takes part in, with ``role``."""
    per = df.select(period).distinct()
    w = Window.orderBy(period)   # distinct periods only: a handful of rows
    per = per.withColumn("__pos", F.row_number().over(w) - 1)
    n = per.agg(F.count(F.lit(1)).alias("__n"))
    per = attach_scalars(per, n).withColumn("__t", F.floor(F.col("__n") / (k + 1)).cast("int"))
    per = per.select(period, "__pos", "__n", "__t", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    start = F.col("__n") - (k - F.col("fold")) * F.col("__t")
    end = start + F.col("__t")
    train_end = start - gap
    train_start = F.greatest(F.lit(0), train_end - max_train) if max_train else F.lit(0)
    role = (F.when((F.col("__pos") >= start) & (F.col("__pos") < end), "test")
            .when((F.col("__pos") >= train_start) & (F.col("__pos") < train_end), "train"))
    per = per.withColumn("role", role).where(F.col("role").isNotNull()).select(period, "fold", "role")
    return df.join(per, period)


def learning_curve_subsets(df: DataFrame, keys, fractions=(0.1, 0.25, 0.5, 0.75, 1.0), seed: int = 42) -> DataFrame:
    """SP9 — nested subsets: a row belongs to every fraction above its hash
    quantile (u = hash / 16^13), so the 10 % sample is inside the 25 % one."""
    u = stable_hash(keys, seed).cast("double") / HASH_SPACE
    d = df.withColumn("__u", u)
    d = d.select("*", F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction"))
    return d.where(F.col("__u") < F.col("fraction")).drop("__u")
