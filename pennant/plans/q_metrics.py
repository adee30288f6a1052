"""MC1-MC20 and MR1-MR20 queries.

Scored inputs without a model (so every metric has an exact SQL oracle):
* binary: ``labels`` ⋈ ``documents``; score ``p = (n_chars % 997) / 997``;
  prediction ``p >= 0.5``; a second label ``toxic`` with ``(7 n_chars % 991) / 991``;
* multi-class: ``embeddings``; class probabilities = softmax of the first 10
  embedding dimensions, prediction = arg-max;
* regression: the panel's actual wins vs Pythagorean wins (and the prior
  3-season mean as a second model).
"""

from pyspark.sql import functions as F

from pennant.operators import metrics_cls as MC
from pennant.operators import metrics_reg as MR
from pennant.plans.catalog import features, out, register
from pennant.sources.tables import read_table


def binary_scored(spark, sf):
    lab = read_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    p = (F.col("n_chars") % 997).cast("double") / 997.0
    p2 = ((F.col("n_chars") * 7) % 991).cast("double") / 991.0
    return j.select("doc_id", F.col("quality").alias("label"), p.alias("p"),
                    (p >= 0.5).cast("int").alias("prediction"), "toxic", p2.alias("p_toxic"))


def multiclass_scored(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    e = e.withColumn("logits", MC.class_logits(F.col("embedding"), 10)).withColumn("probs", MC.softmax_probs(F.col("logits"), 10))
    return e.select("vec_id", "label", "probs", MC.argmax_class(F.col("probs")).alias("prediction"))


def reg_scored(spark, sf):
    f = features(spark, sf, ["team_name", "year", "era", "total_games", "wins", "pythagorean_wins", "wins_3yr_avg"])
    return f.select("team_name", "year", "era", "total_games", F.col("wins").cast("double").alias("y"),
                    F.col("pythagorean_wins").alias("yhat"), F.col("wins_3yr_avg").alias("yhat_prior"))


@register("MC8_multiclass_log_loss")
def mc8_multi(spark, sf):
    return out(MC.multiclass_log_loss(multiclass_scored(spark, sf)))


@register("MC1_classification_metrics")
def mc1(spark, sf):
    return out(MC.binary_metrics(binary_scored(spark, sf)).select("accuracy", "precision", "recall", "f1"))


@register("MC2_confusion_matrix")
def mc2(spark, sf):
    return out(MC.confusion_counts(binary_scored(spark, sf)))


@register("MC3_normalized_confusion")
def mc3(spark, sf):
    return out(MC.normalized_confusion(binary_scored(spark, sf)))


@register("MC4_specificity_balanced")
def mc4(spark, sf):
    return out(MC.binary_metrics(binary_scored(spark, sf)).select("specificity", "sensitivity", "balanced_accuracy"))


@register("MC5_matthews")
def mc5(spark, sf):
    return out(MC.binary_metrics(binary_scored(spark, sf)).select("mcc"))


@register("MC6_roc_auc")
def mc6(spark, sf):
    return out(MC.roc_auc(binary_scored(spark, sf)))


@register("MC7_average_precision")
def mc7(spark, sf):
    return out(MC.average_precision(binary_scored(spark, sf)))


@register("MC8_9_log_loss_brier")
def mc8(spark, sf):
    return out(MC.probability_losses(binary_scored(spark, sf)))


@register("MC10_calibration_error")
def mc10(spark, sf):
    return out(MC.calibration_errors(binary_scored(spark, sf)))


@register("MC11_calibration_curve")
def mc11(spark, sf):
    return out(MC.calibration_curve(binary_scored(spark, sf)))


@register("MC12_ovr_auc")
def mc12(spark, sf):
    return out(MC.ovr_auc(multiclass_scored(spark, sf)))


@register("MC13_14_class_report")
def mc13(spark, sf):
    return out(MC.per_class_report(multiclass_scored(spark, sf)))


@register("MC15_16_curves")
def mc15(spark, sf):
    return out(MC.curve_points(binary_scored(spark, sf)))


@register("MC17_multilabel")
def mc17(spark, sf):
    return out(MC.multilabel_metrics(binary_scored(spark, sf), {"label": "p", "toxic": "p_toxic"}))


@register("MC18_prediction_analysis")
def mc18(spark, sf):
    return out(MC.prediction_analysis(binary_scored(spark, sf)))


@register("MC19_benchmark_level")
def mc19(spark, sf):
    b = binary_scored(spark, sf)
    m = MC.binary_metrics(b).select("accuracy").withColumn("__k", F.lit(1)).join(
        MC.roc_auc(b).withColumn("__k", F.lit(1)), "__k").drop("__k")
    return out(MC.benchmark_level(m))


@register("MC20_probability_distribution")
def mc20(spark, sf):
    return out(MC.probability_distribution(binary_scored(spark, sf)))


@register("MR1_core_metrics")
def mr1(spark, sf):
    return out(MR.core_metrics(reg_scored(spark, sf)))


@register("MR1_weighted_metrics")
def mr1w(spark, sf):
    return out(MR.core_metrics(reg_scored(spark, sf), weight="total_games"))


@register("MR2_7_error_profile")
def mr2(spark, sf):
    return out(MR.error_profile(reg_scored(spark, sf)))


@register("MR9_13_residual_tests")
def mr9(spark, sf):
    return out(MR.residual_tests(reg_scored(spark, sf)))


@register("MR10_durbin_watson")
def mr10(spark, sf):
    return out(MR.durbin_watson(reg_scored(spark, sf), ["year", "team_name"]))


@register("MR12_iqr_outliers")
def mr12(spark, sf):
    return out(MR.iqr_outliers(reg_scored(spark, sf)))


@register("MR14_interval_coverage")
def mr14(spark, sf):
    r = reg_scored(spark, sf).withColumns({"lower": F.col("yhat") - 1.96 * 5, "upper": F.col("yhat") + 1.96 * 5})
    return out(MR.interval_coverage(r))


@register("MR15_bias_by_bin")
def mr15(spark, sf):
    return out(MR.bias_by_quantile_bin(reg_scored(spark, sf)))


@register("MR18_diagnostic_residuals")
def mr18(spark, sf):
    return out(MR.diagnostic_residuals(reg_scored(spark, sf)))


@register("MR19_benchmark_level")
def mr19(spark, sf):
    return out(MR.benchmark_level(MR.core_metrics(reg_scored(spark, sf)).select("rmse", "r2")))


@register("MR20_model_comparison")
def mr20(spark, sf):
    return out(MR.model_comparison(reg_scored(spark, sf), "y", {"pythagorean": "yhat", "prior_mean": "yhat_prior"}))


@register("AG10_metrics_by_era")
def ag10(spark, sf):
    return out(MR.core_metrics(reg_scored(spark, sf), group=["era"]).select("era", "n", "rmse", "r2", "mae"))


@register("MC12_ovo_auc")
def mc12o(spark, sf):
    return out(MC.ovo_auc(multiclass_scored(spark, sf)))
