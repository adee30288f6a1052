"""Helpers shared by the operators: written stages, an ordered prefix sum, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.session import checkpoint_dir

#: White space of the word rule, as a character class of Java, RE2 and Python patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only if it was counted and has no more rows than this.
BROADCAST_ROWS = 10_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    It cuts the lineage as ``checkpoint()`` does (a lost executor loses nothing), but stays columnar,
    compressed and prunable.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for ``df`` if counting shows that it is small; else ``df`` itself."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def word_count(text: Column) -> Column:
    """Number of words of the word rule in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*parts: Column) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of an md5 over the parts; the same in every engine."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2 ** 52))


def running_sum(df: DataFrame, order: list[Column], value: str, before: str, name: str) -> tuple[DataFrame, int]:
    """Adds ``before``: the sum of ``value`` over all rows earlier in ``order``; returns also the whole sum.

    One range exchange, written once (so that the partition totals and the rows see the same bounds), one
    total per partition to the driver (bounded by the number of partitions), and one window in each partition.
    ``order`` should tell rows apart, so that a hot key is spread over several partitions.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("n")).orderBy("_part").collect()
    starts, at = [], 0
    for r in totals:
        starts.append((r["_part"], at))
        at += r["n"] or 0
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    w = Window.partitionBy("_part").orderBy(*order)
    inside = F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (ranged.withColumn("_in", inside).join(F.broadcast(offsets), "_part")
            .withColumn(before, F.col("_in") + F.col("_start")).drop("_part", "_in", "_start")), at
