"""Isotonic regression without a last pass on one machine (ML9).

Pool-adjacent-violators (PAV) merges neighbouring blocks of ascending x until their means ascend, and it does not matter in
which order: the blocks of a whole range come out of the blocks of its parts.  So every range partition of the distinct x
makes its own stack of blocks, and neighbouring partitions are merged pairwise, in rounds.  A merge can only touch blocks of
the left part whose mean is not below the right part's first block, and blocks of the right part whose mean is not above the
left part's last one; only these rows meet in a task, all others stay where they are.  With labels 0 and 1 the means of a
stack are different fractions, so n rows leave at most some n ** (2/3) blocks.

The fit is a table of blocks; the function between them is linear, and constant beyond the first and the last.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.operators.ranking import prefix_counts
from pennant.session import materialize

_BLOCK = "part int, low double, high double, w double, wy double"
#: So many corners of the fitted function are handed to tasks as two arrays; beyond that rows look them up in joins.
CORNERS = 10_000


def pool(low: np.ndarray, high: np.ndarray, w: np.ndarray, wy: np.ndarray, stack: list | None = None) -> list:
    """PAV over blocks in ascending order, on top of ``stack`` (lists of low, high, weight, weighted sum)."""
    stack = [] if stack is None else stack
    for block in zip(low.tolist(), high.tolist(), w.tolist(), wy.tolist()):
        stack.append(list(block))
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            top = stack.pop()
            stack[-1] = [stack[-1][0], top[1], stack[-1][2] + top[2], stack[-1][3] + top[3]]
    return stack


def _local(batches):
    """Stacks of a partition sorted by x."""
    stack, part = [], 0
    for b in batches:
        if len(b):
            part = int(b["part"].iloc[0])
            stack = pool(b["x"].to_numpy(), b["x"].to_numpy(), b["w"].to_numpy(), b["wy"].to_numpy(), stack)
    if stack:
        yield pd.DataFrame([(part, *s) for s in stack], columns=["part", "low", "high", "w", "wy"])


def _merged(key, rows):
    rows = rows.sort_values("low")
    stack = pool(*(rows[c].to_numpy() for c in ("low", "high", "w", "wy")))
    return pd.DataFrame([(key[0], *s) for s in stack], columns=["part", "low", "high", "w", "wy"])


def fit_isotonic(df: DataFrame, x: str, y: str, weight: str | None = None) -> DataFrame:
    """Blocks of the isotonic (ascending) least-squares fit: ``low``, ``high`` (the block's smallest and largest x), ``w``,
    ``value``.  Rows with a null or non-finite x or y, or a weight not above 0, take no part; equal x are one point.
    Without rows there are no blocks."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.alias("w"))
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in ("x", "y")]
    points = rows.where(finite[0] & finite[1] & (F.col("w") > 0)).groupBy((F.col("x") + 0.0).alias("x")).agg(   # -0.0 is 0.0
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = points.repartitionByRange(parts, "x").sortWithinPartitions("x").withColumn("part", F.spark_partition_id())
    blocks = materialize(ranged.mapInPandas(_local, _BLOCK))
    mean = F.col("wy") / F.col("w")
    while parts > 1:
        pair = F.floor(F.col("part") / 2).cast("int")
        ends = blocks.groupBy(pair.alias("part2")).agg(F.max(F.when(F.col("part") % 2 == 0, mean)).alias("left_max"),      # one row per pair
                                                      F.min(F.when(F.col("part") % 2 == 1, mean)).alias("right_min"))
        marked = blocks.withColumn("part2", pair).join(F.broadcast(ends), "part2")
        touched = F.when(F.col("part") % 2 == 0, mean >= F.col("right_min")).otherwise(mean <= F.col("left_max"))
        marked = marked.withColumn("touched", F.coalesce(touched, F.lit(False)))
        stay = marked.where(~F.col("touched")).select(F.col("part2").alias("part"), "low", "high", "w", "wy")
        done = marked.where("touched").select(F.col("part2").alias("part"), "low", "high", "w", "wy").groupBy("part").applyInPandas(_merged, _BLOCK)
        blocks = materialize(stay.unionByName(done))
        parts = -(-parts // 2)
    return blocks.select("low", "high", "w", mean.alias("value"))


def corners(blocks: DataFrame) -> DataFrame:
    """The corners (``x``, ``value``) of the fitted function: both ends of every block, once where they are equal."""
    return blocks.select(F.explode(F.array_distinct(F.array(F.struct(F.col("low").alias("x"), "value"), F.struct(F.col("high").alias("x"), "value"))))
                         .alias("c")).select("c.*")


def apply_isotonic(df: DataFrame, blocks: DataFrame, x: str, out: str, most: int = CORNERS) -> DataFrame:
    """Adds ``out``, the fitted function at ``x``; null where x is null or not a number, or the fit has no blocks."""
    ends = corners(blocks)
    few = ends.orderBy("x").limit(most + 1).collect()
    if len(few) <= most:
        return df.withColumn(out, _interpolate([r["x"] for r in few], [r["value"] for r in few])(F.col(x).cast("double")))
    ends = materialize(ends)
    asked = df.select((F.col(x).cast("double") + 0.0).alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).distinct()
    points = asked.withColumn("n", F.lit(0)).unionByName(ends.select("x", F.lit(1).alias("n"))).groupBy("x").agg(F.sum("n").cast("long").alias("n"))
    counted = materialize(prefix_counts(points.withColumn("one", F.lit(0)), ["one"], "x", "n").select("x", "n", "__below", "__tot"))
    numbered = counted.where("n = 1").select("x", F.col("__below").alias("i")).join(ends, "x")
    near = lambda name, i: numbered.select(F.col("i").alias(i), F.col("x").alias(f"x_{name}"), F.col("value").alias(f"v_{name}"))
    look = asked.join(counted, "x").withColumn("i", F.greatest(F.col("__below") - 1, F.lit(0))) \
        .withColumn("j", F.least("__below", F.col("__tot") - 1))
    look = look.join(near("i", "i"), "i").join(near("j", "j"), "j")
    share = (F.col("x") - F.col("x_i")) / (F.col("x_j") - F.col("x_i"))
    value = F.when(F.col("x") <= F.col("x_i"), F.col("v_i")).when(F.col("x") >= F.col("x_j"), F.col("v_j")) \
        .otherwise(F.col("v_i") + share * (F.col("v_j") - F.col("v_i")))
    look = look.select(F.col("x").alias("__iso_x"), value.alias(out))
    return df.join(look, F.col(x).cast("double") + 0.0 == F.col("__iso_x"), "left").drop("__iso_x")


def _interpolate(xs: list, values: list):
    xs, values = np.array(xs, np.float64), np.array(values, np.float64)

    @F.pandas_udf("double")
    def at(column: pd.Series) -> pd.Series:
        v = column.to_numpy(np.float64)
        if not len(xs):
            return pd.Series(np.full(len(v), np.nan)).astype(object).where(lambda s: s.notna(), None)
        got = pd.Series(np.interp(v, xs, values)).astype(object)
        return got.where(~np.isnan(v), None)

    return at
