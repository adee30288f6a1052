"""IO1-IO12 queries: every writer is exercised by a round trip through the
shared checkpoint folder and the read-back data is what gets compared."""

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from pennant.config import SYNTHETIC
from pennant.functions import scalar as S
from pennant.models import estimators as ES
from pennant.models.misc import feature_groups
from pennant.operators import aggregates as A
from pennant.operators import topk as T
from pennant.plans.catalog import CFG, clean_panel, features, out, raw, register
from pennant.plans.preprocess import preprocess
from pennant.plans.q_scalar import scored
from pennant.sources import io as IO

KEY = ["team_name", "year"]
MILESTONES = [f"achieved_{t}_wins" for t in CFG.win_milestones]


def _pred(spark, sf):
    return scored(spark, sf).select(*KEY, "predicted_wins", "division_winner_probability")


@register("IO1_csv_roundtrip")
def io1(spark, sf):
    r = raw(spark, sf)
    path = IO.save(r, IO.scratch_path(spark, "raw") + "/raw.csv", "csv")
    back = IO.load_csv(spark, path, r.schema)
    return out(preprocess(back, SYNTHETIC))


@register("IO3_load_predictions")
def io3(spark, sf):
    p = _pred(spark, sf)
    path = IO.save(p, IO.scratch_path(spark, "pred") + "/predictions.json", "json")
    return out(IO.load_predictions(spark, path, p.schema))


@register("IO5_save_formats")
def io5(spark, sf):
    p = _pred(spark, sf)
    base = IO.scratch_path(spark, "fmt")
    parts = []
    for fmt in ("csv", "json", "parquet"):
        path = IO.save(p, f"{base}/{fmt}", fmt)
        r = spark.read.schema(p.schema)
        back = r.option("header", True).csv(path) if fmt == "csv" else r.format(fmt).load(path)
        parts.append(back.withColumn("format", F.lit(fmt)))
    return out(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("IO6_report_sheets")
def io6(spark, sf):
    p = _pred(spark, sf).withColumn("division_winner_prediction",
                                    (F.col("division_winner_probability") > 0.5).cast("int"))
    paths = IO.save_report_sheets(p, A.prediction_summary(p), T.top_n(p, "predicted_wins", 10),
                                  IO.scratch_path(spark, "sheets"))
    return out(spark.read.parquet(paths["top10"]))


@register("IO6_all_sheets")
def io6_all(spark, sf):
    """Rows and columns of each sheet as read back."""
    p = _pred(spark, sf).withColumn("division_winner_prediction", (F.col("division_winner_probability") > 0.5).cast("int"))
    paths = IO.save_report_sheets(p, A.prediction_summary(p), T.top_n(p, "predicted_wins", 10), IO.scratch_path(spark, "sheets"))
    back = {k: spark.read.parquet(v) for k, v in sorted(paths.items())}
    parts = [d.agg(F.lit(k).alias("sheet"), F.count(F.lit(1)).alias("n_rows"), F.lit(",".join(sorted(d.columns))).alias("column_names"))
             for k, d in back.items()]
    return out(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("CL12_era_split_files")
def cl12_files(spark, sf):
    """One folder per era, written once and read back."""
    from pennant.operators.clean import write_era_splits
    path = write_era_splits(clean_panel(spark, sf).select(*KEY, "wins"), CFG.era_ranges, IO.scratch_path(spark, "eras"))
    return out(spark.read.parquet(path).select(*KEY, "wins", "era"))


@register("IO7_load_season")
def io7(spark, sf):
    p = clean_panel(spark, sf).select(*KEY, "wins")
    hist = IO.load_season(p, 2002, "historical").withColumn("source", F.lit("historical"))
    hist99 = IO.load_season(p, 1999, "historical").withColumn("source", F.lit("historical_present"))
    latest = IO.load_season(p, None, "latest").withColumn("source", F.lit("latest"))
    return out(hist.unionByName(hist99).unionByName(latest))


def payload_input(spark, sf):
    f = IO.load_season(features(spark, sf), None, "latest")
    p = (F.col("pythagorean_win_pct") * 162)
    return f.select("team_name", p.alias("predicted_wins"),
                    F.when(F.col("wins") % 2 == 0, p - 19.6).alias("win_prediction_lower"),
                    F.when(F.col("wins") % 2 == 0, p + 19.6).alias("win_prediction_upper"),
                    F.col("wins_percentile").alias("division_winner_probability"),
                    (F.col("wins_percentile") > 0.5).cast("int").alias("division_winner_prediction"),
                    F.when(F.col("wins_percentile") > 0.5,
                           S.confidence_level(S.binary_confidence("wins_percentile"))).alias("division_winner_confidence"),
                    *[F.col(m).cast("double").alias(f"prob_{m}") for m in MILESTONES])


@register("IO8_api_payload")
def io8(spark, sf):
    pl = IO.api_payload(payload_input(spark, sf), [f"prob_{m}" for m in MILESTONES])
    path = IO.save(IO.payload_json(pl), IO.scratch_path(spark, "payload"), "json")
    back = spark.read.schema("team_name string, json string").json(path)
    back = back.withColumn("doc", F.from_json("json", pl.drop("team_name").schema))
    return out(back.select("team_name", F.col("doc.wins.value").alias("wins_value"),
                           F.col("doc.wins.confidence_interval.lower").alias("ci_lower"),
                           F.col("doc.wins.confidence_interval.upper").alias("ci_upper"),
                           F.col("doc.wins.confidence_interval.level").alias("ci_level"),
                           F.col("doc.division_winner.probability").alias("dw_probability"),
                           F.col("doc.division_winner.prediction").alias("dw_prediction"),
                           F.col("doc.division_winner.confidence").alias("dw_confidence"),
                           *[F.col("doc.milestones")[m].alias(m) for m in MILESTONES]))


@register("IO9_competition_export")
def io9(spark, sf):
    return out(IO.competition_export(_pred(spark, sf)))


@register("IO10_model_metadata")
def io10(spark, sf):
    from pennant.plans.q_models import CLS_FEATURES, _split, ml_data
    tr, _, te = _split(ml_data(spark, sf))
    m = ES.random_forest_classifier().fit(tr)
    path = IO.save_model_with_metadata(spark, m, IO.scratch_path(spark, "model"), "division_winner",
                                       CLS_FEATURES, {"numTrees": 100, "maxDepth": 10})
    loaded, meta = IO.load_model_with_metadata(spark, path, RandomForestClassificationModel)
    s = loaded.transform(te).select(*KEY, F.col("prediction").cast("int").alias("prediction"))
    from pennant.functions.safe import attach_scalars
    return out(attach_scalars(s, meta.select("name", "model_class")))


@register("IO12_engineered_export")
def io12(spark, sf):
    f = features(spark, sf)
    path, _meta = IO.export_engineered(f, IO.scratch_path(spark, "engineered"), feature_groups(f.columns))
    back = spark.read.parquet(path)
    return out(back.select(*f.columns))
