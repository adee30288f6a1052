"""Keys for operators that are otherwise covered inside other keys, so each
line of the inventory has its own registered query (AG26, CL20, IO4, JN7,
MR8, MR16, MR17, MR21, TK8, TK9, UD1-UD6)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pennant.models import estimators as ES
from pennant.models import forecast as FC
from pennant.operators.apply import implied_exponents, parallel_apply
from pennant.operators import aggregates as A
from pennant.operators import metrics_reg as MR
from pennant.plans.catalog import clean_panel, features, out, register
from pennant.sources.panel import quarter_panel
from pennant.plans.q_metrics import reg_scored
from pennant.plans.q_models import CLS_FEATURES, _split, forest_search, ml_data
from pennant.plans.q_scalar import scored
from pennant.sources import io as IO

KEY = ["team_name", "year"]
PREP = ["runs_per_game", "runs_allowed_per_game", "pythagorean_win_pct", "home_win_pct", "win_pct_vs_top_teams"]


@register("AG26_distribution_text")
def ag26(spark, sf):
    s = A.eda_summary(clean_panel(spark, sf), ["wins", "run_differential", "winning_percentage"])
    return out(s.select("metric", "mean", "median", "std"))


@register("CL20_prepare_features")
def cl20(spark, sf):
    f = features(spark, sf).select(*KEY, *PREP).na.drop(subset=PREP)
    v = ES.assemble(f, PREP).withColumn("__a", vector_to_array("features"))
    return out(v.select(*KEY, *[F.col("__a")[i].alias(f"f{i}") for i in range(len(PREP))]))


@register("IO4_save_processed")
def io4(spark, sf):
    p = clean_panel(spark, sf)
    path = IO.save(p, IO.scratch_path(spark, "processed"), "parquet", partition_by=["year"])
    return out(spark.read.parquet(path).select(*p.columns))


@register("JN7_append_scores")
def jn7(spark, sf):
    """Predictions are appended to the rows they belong to (no positional stack)."""
    s = scored(spark, sf)
    return out(s.select(*KEY, "wins", "predicted_wins", (F.col("predicted_wins") - F.col("wins")).alias("error")))


@register("MR8_adjusted_r2")
def mr8(spark, sf):
    return out(MR.adjusted_r2(reg_scored(spark, sf), p=10))


@register("MR16_prediction_range")
def mr16(spark, sf):
    return out(MR.prediction_range(reg_scored(spark, sf)))


@register("MR17_error_summary")
def mr17(spark, sf):
    return out(MR.error_summary(reg_scored(spark, sf)))


@register("MR21_custom_scorers")
def mr21(spark, sf):
    r = reg_scored(spark, sf).select(F.col("y").alias("label"), F.col("yhat").alias("prediction"))
    vals = [(f"within_{k}", MR.WithinKEvaluator(float(k)).evaluate(r)) for k in (5, 10)]
    return spark.createDataFrame(vals, "metric string, value double")


@register("TK8_top_tuning_results")
def tk8(spark, sf):
    return out(forest_search(spark, sf).orderBy(F.desc("mean_score"), "param_index").limit(3))


@register("TK9_importance_ranking")
def tk9(spark, sf):
    tr, _, _ = _split(ml_data(spark, sf))
    lr = ES.logistic(reg=0.01).fit(tr)
    coef = lr.coefficients.toArray().tolist()
    rows = sorted(zip(CLS_FEATURES, coef), key=lambda x: (-abs(x[1]), x[0]))
    return spark.createDataFrame([(f, float(c), float(abs(c)), i + 1) for i, (f, c) in enumerate(rows)],
                                 "feature string, coefficient double, importance double, rank int")


@register("UD1_row_rules_builtin")
def ud1(spark, sf):
    """Row lambdas of the original (record / streak / era / elite threshold) as built-ins."""
    f = features(spark, sf)
    return out(f.select(*KEY, "at_home_wins", "streak_type", "streak_length", "era", "era_adjusted_elite_wins"))


@register("UD2_group_transform_builtin")
def ud2(spark, sf):
    f = features(spark, sf)
    return out(f.select(*KEY, "offensive_rating", "run_diff_consistency", "wins_era_zscore"))


@register("UD3_rolling_slope_builtin")
def ud3(spark, sf):
    return out(features(spark, sf).select(*KEY, "wins_trend", "winning_percentage_trend"))


@register("UD4_per_entity_fit")
def ud4(spark, sf):
    return out(FC.arima_forecasts(quarter_panel(spark, sf), "run_differential", horizon=1, period="quarter"))


@register("UD5_partition_apply")
def ud5(spark, sf):
    """``parallel_apply``: a numeric solver per row, which no built-in expresses, over Arrow batches."""
    p = clean_panel(spark, sf).select(*KEY, "wins", "losses", "runs_scored", "runs_allowed")
    return out(parallel_apply(p, implied_exponents, "team_name string, year int, exponent double"))


@register("UD6_custom_evaluator")
def ud6(spark, sf):
    d = ml_data(spark, sf, ["runs_scored", "runs_allowed", "run_differential"], "wins", balance=False)
    tr, _, te = _split(d)
    m = ES.linear_regressor("linear").fit(tr)
    ev = MR.WithinKEvaluator(5.0)
    return spark.createDataFrame([("within_5", float(ev.evaluate(m.transform(te))))], "metric string, value double")
