"""SS1-SS5 queries (streams over the driver tables, run with availableNow)."""

from pyspark.sql import functions as F

from pennant.plans.catalog import out, register
from pennant.streaming import cache, scoring, snapshots, weights


@register("SS1_stream_scoring")
def ss1(spark, sf):
    return out(scoring.stream_scoring(spark, sf))


@register("SS2_stream_dedupe_ttl")
def ss2(spark, sf):
    answered = cache.stream_dedupe(spark, sf)
    return out(answered.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))


@register("SS3_stream_window_stats")
def ss3(spark, sf):
    return out(cache.stream_window_stats(spark, sf))


@register("SS4_stream_ensemble_weights")
def ss4(spark, sf):
    return out(weights.stream_ensemble_weights(spark, sf))


@register("SS5_stream_running_totals")
def ss5(spark, sf):
    return out(snapshots.stream_running_totals(spark, sf))
