"""ML1-ML43 queries.

Model fits are checked rows-only (plus quality floors in tests); model-side
operators that are pure aggregations (exponent fit, feature selection, Holt
with fixed parameters, horizon rows, forecast ensemble, PSI, Poisson
bootstrap, residual bounds) also have SQL oracles.

Training data: the feature table; division-winner classifier and wins
regressor; time split train <= 1998, validation 1999, test >= 2000.
"""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from pennant.functions import scalar as S
from pennant.functions.safe import clip, div
from pennant.models import calibration as CAL
from pennant.models import ensemble as EN
from pennant.models import estimators as ES
from pennant.models import forecast as FC
from pennant.models import intervals as IV
from pennant.models import isotonic as ISO
from pennant.models import misc as MI
from pennant.models import search as SE
from pennant.models import tuning as TU
from pennant.operators import metrics_cls as MC
from pennant.operators.split import stable_hash, three_way_period_split
from pennant.plans.catalog import CFG, _memo, clean_panel, features, out, register
from pennant.sources.io import dense_index
from pennant.sources.panel import quarter_panel

KEY = ["team_name", "year"]
CLS_FEATURES = ["home_win_pct", "away_win_pct", "win_pct_vs_top_teams", "runs_per_game", "runs_allowed_per_game",
                "run_efficiency", "pythagorean_win_pct", "luck_pct", "momentum", "streak_score", "wins_percentile",
                "run_diff_percentile", "offensive_rating", "defensive_rating", "close_game_factor", "league_strength"]
REG_FEATURES = ["runs_scored", "runs_allowed", "run_differential", "pythagorean_win_pct", "runs_per_game",
                "runs_allowed_per_game", "home_win_pct", "away_win_pct", "win_pct_vs_top_teams", "offensive_rating",
                "defensive_rating", "close_game_factor"]
MILESTONES = [f"achieved_{t}_wins" for t in CFG.win_milestones] + ["made_playoffs"]


def ml_data(spark, sf, feats=CLS_FEATURES, label="is_division_winner", balance: bool = True, targets=MILESTONES):
    cols = list(dict.fromkeys([*KEY, *feats, label, "wins", "games_behind", *targets, "total_games",
                               "at_home_wins", "home_games", "runs_scored", "runs_allowed"]))
    d = features(spark, sf, cols).select(*cols) \
        .na.drop(subset=[*feats, label]).withColumn("label", F.col(label).cast("double"))
    d = ES.assemble(d, feats)
    d = three_way_period_split(d, 2000)
    return ES.balanced_weights(d, "label", train=F.col("split") == "train") if balance else d.withColumn("weight", F.lit(1.0))


def _split(d):
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "val"), d.where(F.col("split") == "test")


def _fit_rows(d):
    """What folds and fits read of the rows."""
    return d.select(*KEY, "features", "label", "weight")


def _scored(m, test):
    return out(m.transform(test).select(*KEY, "label", vector_to_array("probability")[1].alias("p"),
                                        F.col("prediction").cast("int").alias("prediction")))


def _reg_data(spark, sf):
    return ml_data(spark, sf, REG_FEATURES, "wins", balance=False, targets=())


@register("ML1_standard_scaler")
def ml1(spark, sf):
    d = ml_data(spark, sf)
    tr, _, _ = _split(d)
    m = ES.scaler().fit(tr)
    rows = m.transform(d).select(*KEY, vector_to_array("scaled").alias("s"))
    return out(rows.select(*KEY, *[F.col("s")[i].alias(f"scaled_{c}") for i, c in enumerate(CLS_FEATURES)]))


@register("ML2_logistic_regression")
def ml2(spark, sf):
    tr, _, te = _split(ml_data(spark, sf))
    return _scored(ES.logistic().fit(tr), te)


@register("ML3_random_forest_classifier")
def ml3(spark, sf):
    tr, _, te = _split(ml_data(spark, sf))
    return _scored(ES.random_forest_classifier().fit(tr), te)


@register("ML4_gbt_classifier")
def ml4(spark, sf):
    d = ml_data(spark, sf)
    trv = d.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    m = ES.gbt_classifier(validation_col="is_val").fit(ES.compact(trv.select("features", "label", "weight", "is_val")))
    return _scored(m, d.where(F.col("split") == "test"))


@register("ML5_rff_svm_calibrated")
def ml5(spark, sf):
    d = ES.random_fourier_features(ml_data(spark, sf), n_in=len(CLS_FEATURES))
    tr, va, te = _split(d)
    svm = ES.linear_svc().fit(tr)
    margin = lambda x: svm.transform(x).withColumn("__m", vector_to_array("rawPrediction")[1])
    va_m = VectorAssembler(inputCols=["__m"], outputCol="__mv").transform(margin(va).select("label", "__m"))
    platt = LogisticRegression(featuresCol="__mv", labelCol="label").fit(va_m)
    te_m = VectorAssembler(inputCols=["__m"], outputCol="__mv").transform(
        margin(te).select(*KEY, "label", "__m", F.col("prediction").cast("int").alias("prediction")))
    r = platt.transform(te_m.withColumnRenamed("prediction", "svm_prediction"))
    return out(r.select(*KEY, "label", vector_to_array("probability")[1].alias("p"),
                        F.col("svm_prediction").alias("prediction")))


@register("ML6_mlp_classifier")
def ml6(spark, sf):
    tr, _, te = _split(ml_data(spark, sf))
    return _scored(ES.mlp(len(CLS_FEATURES)).fit(tr), te)


@register("ML7_linear_regressors")
def ml7(spark, sf):
    d = _reg_data(spark, sf)
    tr, _, te = _split(d)
    n = tr.count()
    est = {k: ES.linear_regressor(k, alpha=1.0, n=n) for k in ("linear", "ridge", "lasso", "elastic_net")}
    return out(TU.train_many(spark, tr, te, est, "regression"))


@register("ML8_random_forest_regressor")
def ml8(spark, sf):
    tr, _, te = _split(_reg_data(spark, sf))
    m = ES.random_forest_regressor().fit(tr)
    return out(m.transform(te).select(*KEY, "label", "prediction"))


@register("ML8_gbt_regressor")
def ml8b(spark, sf):
    d = _reg_data(spark, sf)
    trv = d.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    m = ES.gbt_regressor(validation_col="is_val", tol=1e-6).fit(ES.compact(trv.select("features", "label", "is_val")))
    return out(m.transform(d.where(F.col("split") == "test")).select(*KEY, "label", "prediction"))


@register("ML9_calibrated_forest")
def ml9(spark, sf):
    tr, _, te = _split(ml_data(spark, sf))
    m = CAL.CalibratedClassifier(ES.random_forest_classifier(), "sigmoid", 5).fit(tr)
    return out(m.transform(te).select(*KEY, "label", "p"))


@register("ML9_isotonic_calibration")
def ml9b(spark, sf):
    tr, _, te = _split(ml_data(spark, sf))
    m = CAL.CalibratedClassifier(ES.random_forest_classifier(), "isotonic", 5).fit(tr)
    return out(m.transform(te).select(*KEY, "label", "p"))


@register("ML9_isotonic_blocks")
def ml9c(spark, sf):
    d = features(spark, sf).select("home_win_pct", F.col("is_division_winner").cast("double").alias("y"), F.col("wins").cast("double").alias("w"))
    return out(ISO.fit_isotonic(d, "home_win_pct", "y", "w"))


@register("ML10_playoff_classifier")
def ml10(spark, sf):
    d = ml_data(spark, sf, label="made_playoffs")
    tr, _, te = _split(d)
    m = CAL.CalibratedClassifier(ES.gbt_classifier(), "sigmoid", 3).fit(ES.compact(_fit_rows(tr)))
    s = m.transform(te)
    adj = S.standings_adjusted(s, "p", "games_behind", group=["year"], out="p_adjusted")
    return out(adj.select(*KEY, "label", "p", "p_adjusted"))


@register("ML11_tier_classifier")
def ml11(spark, sf):
    d = ml_data(spark, sf).withColumn(
        "tier", S.performance_tier(F.col("wins") * 162.0 / F.col("total_games")).cast("double"))
    tr, _, te = _split(d)
    m = ES.tier_classifier().fit(tr)
    r = m.transform(te).withColumn("probs", vector_to_array("probability"))
    return out(r.select(*KEY, "tier", F.col("prediction").cast("int").alias("predicted_tier"),
                        S.multiclass_confidence("probs").alias("confidence"),
                        S.tier_label(F.col("prediction").cast("int")).alias("tier_label")))


@register("ML12_forest_intervals")
def ml12(spark, sf):
    tr, _, te = _split(_reg_data(spark, sf))
    m = ES.random_forest_regressor().fit(tr)
    return out(IV.tree_percentile_interval(spark, m, te, KEY))


@register("ML13_pythagorean_exponent")
def ml13(spark, sf):
    return out(MI.fit_pythagorean_exponent(features(spark, sf)))


@register("ML14_run_production")
def ml14(spark, sf):
    feats = ["wins", "losses", "home_win_pct", "away_win_pct", "win_pct_vs_top_teams", "pythagorean_win_pct"]
    d = ml_data(spark, sf, feats, "runs_scored", balance=False)
    tr, _, te = _split(d)
    rs = ES.random_forest_regressor(label="runs_scored").fit(tr.withColumn("runs_scored", F.col("runs_scored").cast("double")))
    ra = ES.random_forest_regressor(label="runs_allowed").fit(tr.withColumn("runs_allowed", F.col("runs_allowed").cast("double")))
    s = rs.transform(te).withColumnRenamed("prediction", "pred_runs_scored")
    s = ra.transform(s).withColumnRenamed("prediction", "pred_runs_allowed")
    return out(s.select(*KEY, clip("pred_runs_scored", 400, 2000).alias("pred_runs_scored"),
                        clip("pred_runs_allowed", 400, 2000).alias("pred_runs_allowed"),
                        (F.col("pred_runs_scored") - F.col("pred_runs_allowed")).alias("pred_run_differential"),
                        S.implied_counterpart("pred_runs_scored").alias("implied_runs_allowed")))


def _multi(spark, sf, chain):
    d = ml_data(spark, sf)
    d = d.withColumns({m: F.col(m).cast("double") for m in MILESTONES})
    tr, _, te = _split(d)
    models = ES.fit_multi_output(tr, MILESTONES, lambda lab: RandomForestClassifier(labelCol=lab, numTrees=100, maxDepth=10, seed=42),
                                 chain=chain)
    return ES.predict_multi_output(te, models, chain=chain)


@register("ML15_multi_output")
def ml15(spark, sf):
    s = _multi(spark, sf, False)
    return out(s.select(*KEY, *[f"prob_{m}" for m in MILESTONES]))


@register("ML16_classifier_chain")
def ml16(spark, sf):
    s = _multi(spark, sf, True)
    return out(s.select(*KEY, *[f"prob_{m}" for m in MILESTONES]))


@register("ML17_probability_map")
def ml17(spark, sf):
    s = ES.probability_map(_multi(spark, sf, False), MILESTONES)
    return out(s.select(*KEY, F.to_json("milestone_probabilities").alias("milestone_probabilities")))


@register("ML18_residual_projector")
def ml18(spark, sf):
    d = features(spark, sf).select(*KEY, "wins", "total_games", "at_home_wins", "home_games") \
        .na.drop(subset=["at_home_wins", "home_games", "wins"]).where(F.col("home_games") > 0)
    d = d.withColumns({"pace": S.pace_simple("at_home_wins", "home_games", 1).cast("double") * F.col("total_games"),
                       "gp_share": div("home_games", "total_games")})
    d = d.withColumn("residual", F.col("wins") - F.col("pace"))
    d = ES.assemble(d, ["at_home_wins", "home_games", "gp_share", "pace"])
    d = three_way_period_split(d, 2000)
    m = ES.random_forest_regressor(label="residual", trees=50).fit(d.where(F.col("split") != "test"))
    s = m.transform(d.where(F.col("split") == "test"))
    return out(s.select(*KEY, "wins", "pace", (F.col("pace") + F.col("prediction")).alias("projected_wins")))


def _members(spark, sf):
    d = ml_data(spark, sf)
    tr, va, te = _split(d)
    return d, tr, va, te, {"rf": ES.random_forest_classifier(), "lr": ES.logistic()}


@register("ML19_soft_vote")
def ml19(spark, sf):
    d, tr, va, te, mem = _members(spark, sf)
    fitted = {n: e.fit(tr) for n, e in mem.items()}
    s = EN.member_scores(te, fitted)
    return out(EN.soft_vote(s, ["p_rf", "p_lr"], [0.6, 0.4]).select(*KEY, "label", "p_rf", "p_lr", "p_ensemble",
                                                                     "pred_ensemble"))


@register("ML20_stacking")
def ml20(spark, sf):
    d, tr, va, te, mem = _members(spark, sf)
    full, meta = EN.stack(tr, mem, LogisticRegression(featuresCol="meta_features", labelCol="label"), KEY, k=5)
    return out(EN.stack_transform(te, full, meta).select(*KEY, "label", "p_stacked"))


@register("ML21_blending")
def ml21(spark, sf):
    d, tr, va, te, mem = _members(spark, sf)
    fitted, meta = EN.blend(tr, va, mem, LogisticRegression(featuresCol="meta_features", labelCol="label"))
    return out(EN.stack_transform(te, fitted, meta, out="p_blended").select(*KEY, "label", "p_blended"))


@register("ML22_dynamic_weights")
def ml22(spark, sf):
    d, tr, va, te, mem = _members(spark, sf)
    rows = {"rf": tr, "lr": ES.compact(_fit_rows(tr))}
    fitted = {n: e.fit(rows[n]) for n, e in mem.items()}
    s = EN.member_scores(d.where(F.col("split") != "train"), fitted)
    long = s.select("year", "label", F.inline(F.array(
        F.struct(F.lit("rf").alias("model"), F.col("p_rf").alias("p")),
        F.struct(F.lit("lr").alias("model"), F.col("p_lr").alias("p")))))
    scores = MC.roc_auc(long, "label", "p", group=["model", "year"]).withColumnRenamed("roc_auc", "score")
    # members start from their cross-validated score on the training rows (that of chance where no fold has both classes)
    tables = {n: TU.cross_validate(spark, rows[n], e, "classification", KEY, k=5)[1] for n, e in mem.items()}
    start = [(n, float(t.fillna(0.5, ["mean_score"]).first()["mean_score"])) for n, t in tables.items()]
    init = spark.createDataFrame(start, "model string, weight double")
    return out(EN.dynamic_weights(scores.fillna(0.5, ["score"]), order_col="year", window=5, floor=0.1, init=init))


@register("ML23_hierarchical")
def ml23(spark, sf):
    d, tr, va, te, mem = _members(spark, sf)
    div_m = ES.random_forest_classifier().fit(tr)
    tr2 = EN.hierarchical(tr, {"division": []}, {"division": div_m})
    tr2 = VectorAssembler(inputCols=["features", "p_division"], outputCol="features2").transform(tr2)
    play = RandomForestClassifier(featuresCol="features2", labelCol="made_playoffs", numTrees=100, maxDepth=10, seed=42) \
        .fit(tr2.withColumn("made_playoffs", F.col("made_playoffs").cast("double")))
    te2 = EN.hierarchical(te, {"division": []}, {"division": div_m})
    te2 = VectorAssembler(inputCols=["features", "p_division"], outputCol="features2").transform(te2)
    r = play.transform(te2)
    return out(r.select(*KEY, "p_division", vector_to_array("probability")[1].alias("p_playoffs")))


@register("ML25_train_many")
def ml25(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    est = {"logistic": ES.logistic(), "random_forest": ES.random_forest_classifier(),
           "gbt": ES.gbt_classifier(), "mlp": ES.mlp(len(CLS_FEATURES), hidden=(16,)),
           "broken": LogisticRegression(featuresCol="no_such_column")}
    few = ES.compact(_fit_rows(tr))
    res = TU.train_many(spark, tr, te, est, "classification", own={"logistic": few, "gbt": few})
    return out(res)


@register("ML26_cross_validate")
def ml26(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    rf = ES.random_forest_classifier()
    grid = ParamGridBuilder().addGrid(rf.maxDepth, [3, 6]).build()
    _, table = TU.cross_validate(spark, tr, rf, "classification", KEY, k=5, grid=grid)
    return out(table)


@register("ML27_out_of_fold")
def ml27(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    oof = TU.out_of_fold(tr, ES.logistic(), KEY, k=5)
    return out(oof.select(*KEY, "fold", "label", vector_to_array("probability")[1].alias("p_oof")))


@register("ML28_nested_cv")
def ml28(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    lr = ES.logistic()
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1]).build()
    return out(TU.nested_cv(spark, ES.compact(_fit_rows(tr)), lr, grid, "classification", KEY, outer=5, inner=3))


#: The reference's random-search ranges for a random forest; MLlib has no ``min_samples_split``.
FOREST_SPACE = {"numTrees": range(50, 300), "maxDepth": range(3, 30), "minInstancesPerNode": range(1, 10),
                "featureSubsetStrategy": ["sqrt", "log2", "all"]}


def forest_search(spark, sf, n_iter: int = 50):
    """Cross-validated random search of ``n_iter`` forests (the reference's default is 50) over FOREST_SPACE; the table
    is written once and read by every query that asks for it."""
    def build():
        d, tr, va, te, _ = _members(spark, sf)
        return SE.forest_search(spark, tr, KEY, TU.random_param_maps(FOREST_SPACE, n_iter), k=5)
    return _memo(spark, sf, f"forest_search-{n_iter}", build)


@register("ML29_random_search")
def ml29(spark, sf):
    return out(forest_search(spark, sf).orderBy(F.desc("mean_score"), "param_index"))


@register("ML30_learning_curve")
def ml30(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    return out(TU.learning_curve(spark, tr, te, ES.logistic(), "classification", KEY))


@register("ML31_select_features")
def ml31(spark, sf):
    f = features(spark, sf)
    cols = MI.select_features(f.columns, "division_winner", exclude=MILESTONES + ["is_division_winner"])
    return out(f.select(*KEY, *cols))


@register("ML32_importance_preview")
def ml32(spark, sf):
    d, tr, va, te, _ = _members(spark, sf)
    m = ES.random_forest_classifier(trees=50).fit(tr)
    imp = m.featureImportances.toArray().tolist()
    rows = sorted(zip(CLS_FEATURES, imp), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


@register("ML33_permutation_importance")
def ml33(spark, sf):
    """Permutation importance in one pass: one hash permutation shared by all
    features (values of the row with place r by one hash move to the row with
    place r by another; equal hashes are told apart by the key, so both are
    true permutations), all feature variants unioned, one transform, one AUC
    grouped by feature."""
    d, tr, va, te, _ = _members(spark, sf)
    m = ES.random_forest_classifier().fit(tr)
    base = te.select(*KEY, "label", *CLS_FEATURES)
    a = dense_index(base.withColumn("__h1", stable_hash(KEY, 1)), ["__h1", *KEY], "__r")
    b = dense_index(base.withColumn("__h2", stable_hash(KEY, 2)), ["__h2", *KEY], "__r") \
        .select("__r", *[F.col(c).alias(f"__new_{c}") for c in CLS_FEATURES])
    from pennant.plans.features import materialize
    perm = materialize(a.join(b, "__r"), "checkpoint")   # shared by all 17 variants
    variants = [perm.select(*KEY, "label", F.lit("__none__").alias("feature"), *CLS_FEATURES)]
    for f in CLS_FEATURES:
        variants.append(perm.select(*KEY, "label", F.lit(f).alias("feature"),
                                    *[(F.col(f"__new_{c}") if c == f else F.col(c)).alias(c) for c in CLS_FEATURES]))
    allv = variants[0]
    for v in variants[1:]:
        allv = allv.unionByName(v)
    sc = _pos(m.transform(ES.assemble(allv, CLS_FEATURES)))
    auc = MC.roc_auc(sc, "label", "p", group=["feature"])
    base_auc = auc.where(F.col("feature") == "__none__").select(F.col("roc_auc").alias("__base"))
    from pennant.functions.safe import attach_scalars
    return out(attach_scalars(auc.where(F.col("feature") != "__none__"), base_auc)
               .select("feature", (F.col("__base") - F.col("roc_auc")).alias("importance")))


def _pos(s):
    return s.withColumn("p", vector_to_array("probability")[1])


@register("ML34_arima_forecasts")
def ml34(spark, sf):
    return out(FC.arima_forecasts(quarter_panel(spark, sf), "wins", horizon=2, period="quarter"))


@register("ML35_holt_forecasts")
def ml35(spark, sf):
    return out(FC.holt(clean_panel(spark, sf), "wins", 0.5, 0.3, 2))


@register("ML36_forecast_ensemble")
def ml36(spark, sf):
    p = clean_panel(spark, sf)
    a = FC.holt(p, "wins", 0.5, 0.3, 2).select("team_name", "forecast_period", "forecast")
    b = FC.holt(p, "wins", 0.8, 0.2, 2).select("team_name", "forecast_period", "forecast")
    return out(FC.forecast_ensemble(a.unionByName(b)))


@register("ML37_horizon_rows")
def ml37(spark, sf):
    return out(FC.horizon_rows(clean_panel(spark, sf), 3))


@register("ML38_batch_scoring")
def ml38(spark, sf):
    f = features(spark, sf).na.drop(subset=CLS_FEATURES)
    train = f.where(F.col("year") < 2000).withColumn("label", F.col("is_division_winner").cast("double"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=CLS_FEATURES, outputCol="features"),
                            RandomForestClassifier(numTrees=100, maxDepth=10, seed=42)]).fit(train)
    return out(pipe.transform(f).select(*KEY, vector_to_array("probability")[1].alias("p"),
                                        F.col("prediction").cast("int").alias("prediction")))


@register("ML39_comprehensive_report")
def ml39(spark, sf):
    d = _reg_data(spark, sf)
    tr, va, te = _split(d)
    reg = ES.random_forest_regressor().fit(tr)
    w = reg.transform(d.where(F.col("split") != "train")).withColumnRenamed("prediction", "predicted_wins")
    w = w.withColumn("y", F.col("label"))
    b = IV.residual_quantile_bounds(w.where(F.col("split") == "test"), "y", "predicted_wins",
                                    calibration=w.where(F.col("split") == "val"))
    c = ml_data(spark, sf)
    ctr, _, cte = _split(c)
    cls = CAL.CalibratedClassifier(ES.random_forest_classifier(), "sigmoid", 5).fit(ctr)
    p = cls.transform(cte).select(*KEY, F.col("p").alias("division_winner_probability"))
    mo = _multi(spark, sf, False).select(*KEY, *[f"prob_{m}" for m in MILESTONES])
    r = b.select(*KEY, "predicted_wins", F.col("lower_bound").alias("win_prediction_lower"),
                 F.col("upper_bound").alias("win_prediction_upper")).join(p, KEY, "left").join(mo, KEY, "left")
    r = r.withColumns({"division_winner_prediction": (F.col("division_winner_probability") >= 0.5).cast("int"),
                       "division_winner_confidence": S.confidence_level(
                           S.binary_confidence("division_winner_probability"))})
    return out(r)


@register("ML40_milestone_report")
def ml40(spark, sf):
    s = _multi(spark, sf, False)
    return out(MI.milestone_report(s, [f"prob_{m}" for m in MILESTONES]))


@register("ML41_psi_drift")
def ml41(spark, sf):
    return out(MI.drift(clean_panel(spark, sf), "winning_percentage"))


@register("ML42_poisson_bootstrap")
def ml42(spark, sf):
    return out(MI.poisson_bootstrap(clean_panel(spark, sf), "wins", replicates=1000))


@register("ML43_residual_bounds")
def ml43(spark, sf):
    f = features(spark, sf).select(*KEY, F.col("wins").cast("double").alias("y"), F.col("pythagorean_wins").alias("yhat"))
    return out(IV.residual_quantile_bounds(f).select(*KEY, "yhat", "lower_bound", "upper_bound"))
