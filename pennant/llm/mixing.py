"""Mixing sources to target weights.

Sizes are summed per source (partial aggregation: a hot source costs one row per task before the shuffle).  Each
source has a weight and a limit (``most`` times its size); the total is shared by weight, and what a limited source
cannot take is shared again among the others: the fixed point of level = (total - limits of full sources) / (weights
of the rest), found by a few small aggregations over the table of sources.  The repetition rate of a source is its
target over its size.  A document is emitted floor(rate) times, plus once more with probability equal to the
fraction, decided by a hash of its key and a seed, so reruns and lost executors give the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import running_sum, small, unit_hash, written


def source_targets(sized: DataFrame, source: str = "source", size: str = "size", weights: tuple[int, ...] = (1, 2, 3),
                   most: int = 3) -> DataFrame:
    """One row per source (null is a source, the last one): ``source``, ``source_size``, ``weight``, ``target``, ``rate``.

    Sources are numbered by code point over all partitions; weights repeat along the numbers.  Whole-number totals
    are kept exact; the level is one division.  A source of size 0 has target and rate 0.
    """
    per = sized.groupBy(F.col(source).alias("source")).agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("source_size"))
    per = per.withColumn("_last", F.col("source").isNull()).withColumn("_one", F.lit(1))
    per, _ = running_sum(per, [F.col("_last"), F.col("source")], "_one", "_rank", "mix-sources")
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = written(per.select("source", "source_size", pick.cast("long").alias("weight"), (F.col("source_size") * most).alias("_limit")),
                  "mix-targets")
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, full = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("_limit") < F.lit(level) * F.col("weight")
        got = per.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, F.col("_limit"))), F.lit(0)).alias("used"),
                      F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open")).first()
        if got["n"] == full or not got["open"]:
            break
        full, level = got["n"], (total - got["used"]) / got["open"]
    target = F.least(F.col("_limit").cast("double"), F.lit(float(level or 0.0)) * F.col("weight"))
    return per.select("source", "source_size", "weight", target.alias("target"),
                      F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies(rate: Column, seed: str, *key: Column) -> Column:
    """floor(rate), plus 1 with probability rate - floor(rate) by the hash of seed and key."""
    return (F.floor(rate) + F.when(unit_hash(F.lit(seed), *key) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", seed: str = "mix-1",
        weights: tuple[int, ...] = (1, 2, 3), most: int = 3, keep: list[Column] | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``doc`` (or only the columns ``keep``), with ``size``, ``source_size``,
    ``target`` and ``n_copies``; nothing is emitted twice yet (see :func:`emit`).

    Rows with equal key (also null) get equal draws, so repeated rows are repeated alike; size null counts 0; an
    empty table gives an empty result.  The sources join as a broadcast if counted small; else Spark's join splits a
    hot source.
    """
    rows = docs.select(*(keep or [F.struct("*").alias("doc")]), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                       F.col(source).alias("_source"), F.col(key).alias("_key"))
    if keep is not None:
        rows = written(rows, "mix-sizes")
    per = written(source_targets(rows, "_source", "size", weights, most), "mix-rates")
    per = small(per.withColumnsRenamed({"source": "_s", "weight": "_weight", "rate": "_rate"}))
    return (rows.join(per, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("n_copies", copies(F.col("_rate"), seed, F.col("_key")))
            .drop("_s", "_source", "_key", "_rate", "_weight"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: the original rows, each as often as it was taken."""
    return mixed.where("n_copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("_copy")).select("doc.*")
