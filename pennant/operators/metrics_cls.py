"""Classification metrics (MC1-MC20) as aggregations.

Input contract: a DataFrame with ``label`` (0/1 or class id), ``prediction``
and a score column (``p`` for binary; an array of class probabilities for
multi-class), plus any grouping columns.

* count-based metrics are ONE aggregation (partial aggregation per task);
* ranking metrics (ROC AUC, average precision, ROC / PR curves) are computed
  from a histogram over distinct scores with the two-level bucketed prefix
  sum from :mod:`pennant.operators.ranking` — never a window over raw rows and
  never a global sort;
* calibration metrics aggregate by probability bin (at most ``n_bins`` rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.config import BENCHMARKS_CLASSIFICATION
from pennant.functions.safe import div
from pennant.operators.ranking import prefix_counts


def _z(x: Column) -> Column:
    """zero-division -> 0 (scikit-learn's ``zero_division=0``)."""
    return F.coalesce(x, F.lit(0.0))


def confusion_counts(df: DataFrame, label="label", prediction="prediction", group=()) -> DataFrame:
    """MC2 — tn, fp, fn, tp (one aggregation)."""
    y, yh = F.col(label), F.col(prediction)
    g = df.groupBy(*group) if group else df.groupBy()
    return g.agg(F.count_if((y == 0) & (yh == 0)).alias("tn"), F.count_if((y == 0) & (yh == 1)).alias("fp"),
                 F.count_if((y == 1) & (yh == 0)).alias("fn"), F.count_if((y == 1) & (yh == 1)).alias("tp"))


def binary_metrics(df: DataFrame, label="label", prediction="prediction", group=()) -> DataFrame:
    """MC1, MC4, MC5 — accuracy, precision, recall, F1, specificity, balanced
    accuracy, Matthews correlation from the four counts."""
    c = confusion_counts(df, label, prediction, group)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    prec = _z(div(tp, tp + fp))
    rec = _z(div(tp, tp + fn))
    spec = _z(div(tn, tn + fp))
    mcc = _z(div(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))))
    return c.select(*group, "tn", "fp", "fn", "tp",
                    div(tp + tn, tp + tn + fp + fn).alias("accuracy"), prec.alias("precision"),
                    rec.alias("recall"), _z(div(2 * prec * rec, prec + rec)).alias("f1"),
                    spec.alias("specificity"), rec.alias("sensitivity"),
                    ((spec + rec) / 2).alias("balanced_accuracy"), mcc.alias("mcc"))


def normalized_confusion(df: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """MC3 — confusion cells with the share of their actual-class row."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    tot = cells.groupBy(label).agg(F.sum("n").alias("__row"))
    return cells.join(tot, label).select(label, prediction, "n", div("n", "__row").alias("row_share"))


def score_histogram(df: DataFrame, label="label", score="p", group=()) -> DataFrame:
    """Distinct-score histogram with positive / negative counts, plus the
    counts strictly below each score (``pos_below``, ``neg_below``) and totals."""
    g = list(group)
    y = F.col(label)
    hist = (df.where(F.col(score).isNotNull())
            .groupBy(*g, F.col(score).cast("double").alias("__s"))
            .agg(F.count(F.lit(1)).alias("__n"), F.count_if(y == 1).alias("__pos"), F.count_if(y != 1).alias("__neg")))
    if not g:
        hist = hist.withColumn("__grp", F.lit(0))
        g = ["__grp"]
    h = prefix_counts(hist, g, "__s", "__n", extra_sums=("__pos", "__neg"))
    return h


def roc_auc(df: DataFrame, label="label", score="p", group=()) -> DataFrame:
    """MC6 — exact ROC AUC (ties count one half) from the score histogram."""
    h = score_histogram(df, label, score, group)
    keys = list(group) or ["__grp"]
    contrib = F.col("__pos") * (F.col("__below___neg") + F.col("__neg") / 2.0)
    r = h.groupBy(*keys).agg(F.sum(contrib).alias("__c"), F.first("__tot___pos").alias("__P"),
                             F.first("__tot___neg").alias("__N"))
    return r.select(*group, div("__c", F.col("__P") * F.col("__N")).alias("roc_auc"))


def average_precision(df: DataFrame, label="label", score="p", group=()) -> DataFrame:
    """MC7 — step-wise AP = sum over thresholds of (R_i - R_{i-1}) * P_i."""
    h = score_histogram(df, label, score, group)
    keys = list(group) or ["__grp"]
    tp_ge = F.col("__tot___pos") - F.col("__below___pos")
    n_ge = F.col("__tot") - F.col("__below")
    contrib = div(F.col("__pos"), F.col("__tot___pos")) * div(tp_ge, n_ge)
    return h.groupBy(*keys).agg(F.sum(contrib).alias("average_precision")).select(*group, "average_precision")


def curve_points(df: DataFrame, label="label", score="p") -> DataFrame:
    """MC15 / MC16 — ROC and PR points at every distinct threshold (no
    intermediate-point dropping): threshold, fpr, tpr, precision, recall."""
    h = score_histogram(df, label, score)
    tp = F.col("__tot___pos") - F.col("__below___pos")
    fp = F.col("__tot___neg") - F.col("__below___neg")
    return h.select(F.col("__s").alias("threshold"), div(fp, "__tot___neg").alias("fpr"),
                    div(tp, "__tot___pos").alias("tpr"), div(tp, tp + fp).alias("precision"),
                    div(tp, "__tot___pos").alias("recall"))


# Fixed value: default clipping of the original's log loss (float64 machine epsilon).
LOG_LOSS_EPS = 2.220446049250313e-16


def probability_losses(df: DataFrame, label="label", score="p", eps: float = LOG_LOSS_EPS, group=()) -> DataFrame:
    """MC8 / MC9 — log loss (probabilities clipped to [eps, 1-eps]) and Brier score."""
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    ll = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    g = df.groupBy(*group) if group else df.groupBy()
    return g.agg(F.avg(ll).alias("log_loss"), F.avg(F.pow(F.col(score) - y, 2)).alias("brier_score"))


def calibration_errors(df: DataFrame, label="label", score="p", n_bins: int = 10) -> DataFrame:
    """MC10 — ECE / MCE over equal-width bins [k/n, (k+1)/n); p = 1.0 falls in
    no bin but stays in the denominator (as in the original)."""
    b = F.floor(F.col(score) * n_bins).cast("int")
    bins = (df.withColumn("__b", b).groupBy("__b")
            .agg(F.count(F.lit(1)).alias("__n"), F.avg(F.col(label).cast("double")).alias("__acc"),
                 F.avg(score).alias("__conf")))
    tot = df.agg(F.count(F.lit(1)).alias("__N"))
    inb = bins.where((F.col("__b") >= 0) & (F.col("__b") < n_bins)) \
        .withColumn("__gap", F.abs(F.col("__acc") - F.col("__conf")))
    r = inb.agg(F.sum(F.col("__n") * F.col("__gap")).alias("__w"), F.max("__gap").alias("mce"))
    return r.withColumn("__k", F.lit(1)).join(F.broadcast(tot.withColumn("__k", F.lit(1))), "__k") \
        .select(div("__w", "__N").alias("ece"), F.coalesce("mce", F.lit(0.0)).alias("mce"))


def calibration_curve(df: DataFrame, label="label", score="p", n_bins: int = 10) -> DataFrame:
    """MC11 — uniform bins right-closed (k/n, (k+1)/n], p = 0 in the first;
    non-empty bins only: mean predicted, observed frequency, count."""
    b = F.greatest(F.ceil(F.col(score) * n_bins).cast("int") - 1, F.lit(0))
    return (df.withColumn("bin", F.least(b, F.lit(n_bins - 1))).groupBy("bin")
            .agg(F.avg(score).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
                 F.count(F.lit(1)).alias("n")))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once a row, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax_probs(logits: Column, k: int) -> Column:
    """Class probabilities = softmax of the first ``k`` entries of a numeric array
    (array higher-order functions: compact generated code for any k)."""
    xs = F.transform(F.slice(logits, 1, k), lambda v: v.cast("double"))
    ex = _once(xs, lambda x: _once(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top))))
    return _once(ex, lambda e: _once(F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v), lambda total: F.transform(e, lambda v: v / total)))


def class_logits(values: Column, k: int) -> Column:
    """``k`` logits from a numeric array of any length: entry i adds to class i mod k, so every entry counts."""
    steps = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / k).cast("int")))
    return F.aggregate(steps, F.array_repeat(F.lit(0.0), k), lambda total, i: F.zip_with(
        total, F.slice(values, i * k + 1, F.lit(k)), lambda a, v: a + F.coalesce(v.cast("double"), F.lit(0.0))))


def multiclass_log_loss(df: DataFrame, label="label", probs="probs", eps: float = LOG_LOSS_EPS) -> DataFrame:
    """MC8 — mean negative log-probability of the true class (clipped to [eps, 1 - eps]); rows whose label is null or
    no class are left out."""
    p = F.get(F.col(probs), F.col(label).cast("int"))
    rows = df.where(p.isNotNull())
    return rows.agg(F.avg(-F.ln(F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps)))).alias("log_loss"), F.count(F.lit(1)).alias("n_rows"))


def argmax_class(probs: Column) -> Column:
    """Index (0-based) of the largest probability; ties -> lowest index."""
    return _once(probs, lambda p: (F.array_position(p, F.array_max(p)) - 1).cast("int"))


def per_class_report(df: DataFrame, label="label", prediction="prediction", classes=None) -> DataFrame:
    """MC13 / MC14 — per-class precision, recall, F1, support, plus macro and
    weighted averages and accuracy rows (one aggregation per level)."""
    y, yh = F.col(label), F.col(prediction)
    cls = df.select(y.alias("cls")).union(df.select(yh.alias("cls"))).distinct() if classes is None else None
    tp = df.where(y == yh).groupBy(y.alias("cls")).agg(F.count(F.lit(1)).alias("tp"))
    sup = df.groupBy(y.alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    npred = df.groupBy(yh.alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    base = cls if cls is not None else df.sparkSession.createDataFrame([(int(c),) for c in classes], "cls int")
    r = (base.join(tp, "cls", "left").join(sup, "cls", "left").join(npred, "cls", "left")
         .na.fill(0, ["tp", "support", "n_pred"]))
    prec = _z(div("tp", "n_pred"))
    rec = _z(div("tp", "support"))
    r = r.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                 _z(div(2 * prec * rec, prec + rec)).alias("f1"), F.col("support"), F.col("tp"))
    tot = F.sum("support")
    macro = r.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support"))
    weighted = r.agg(F.lit("weighted avg").alias("class"),
                     div(F.sum(F.col("precision") * F.col("support")), tot).alias("precision"),
                     div(F.sum(F.col("recall") * F.col("support")), tot).alias("recall"),
                     div(F.sum(F.col("f1") * F.col("support")), tot).alias("f1"), tot.alias("support"))
    acc = r.agg(F.lit("accuracy").alias("class"), div(F.sum("tp"), tot).alias("precision"),
                div(F.sum("tp"), tot).alias("recall"), div(F.sum("tp"), tot).alias("f1"), tot.alias("support"))
    return r.drop("tp").unionByName(macro).unionByName(weighted).unionByName(acc)


def ovr_auc(df: DataFrame, label="label", probs="probs", k: int = 10) -> DataFrame:
    """MC12 — one-vs-rest AUC per class and its macro mean.  All k class
    histograms are built in one pass (class id is a histogram group)."""
    long = df.select(F.col(label).alias("__y"),
                     F.posexplode(F.slice(F.col(probs), 1, k)).alias("cls", "__p"))
    long = long.withColumn("__pos", (F.col("__y") == F.col("cls")).cast("int"))
    per = roc_auc(long, "__pos", "__p", group=["cls"])
    macro = per.agg(F.lit(-1).alias("cls"), F.avg("roc_auc").alias("roc_auc"))
    return per.unionByName(macro)


def multilabel_metrics(df: DataFrame, labels: dict) -> DataFrame:
    """MC17 — per label (label column -> score column) accuracy / precision /
    recall / F1 at 0.5, via one unpivot + one grouped aggregation; plus the
    mean accuracy over labels (``label = 'overall'``)."""
    items = [F.struct(F.lit(lab).alias("label_name"), F.col(lab).alias("y"),
                      (F.col(sc) >= 0.5).cast("int").alias("yhat")) for lab, sc in labels.items()]
    long = df.select(F.inline(F.array(*items)))
    per = binary_metrics(long, "y", "yhat", group=["label_name"]).select(
        "label_name", "accuracy", "precision", "recall", "f1")
    overall = per.agg(F.lit("overall").alias("label_name"), F.avg("accuracy").alias("accuracy"),
                      F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"),
                      F.lit(None).cast("double").alias("f1"))
    return per.unionByName(overall)


def prediction_analysis(df: DataFrame, label="label", prediction="prediction", score="p") -> DataFrame:
    """MC18 — class counts, error rate, probability stats (ddof 0) for correct
    and wrong predictions, high-confidence error rate (one aggregation)."""
    y, yh, p = F.col(label), F.col(prediction), F.col(score)
    ok = y == yh
    hi_err = ((p > 0.8) & (y == 0)) | ((p < 0.2) & (y == 1))
    return df.agg(F.count_if(yh == 0).alias("n_pred_0"), F.count_if(yh == 1).alias("n_pred_1"),
                  F.avg((~ok).cast("double")).alias("error_rate"),
                  F.avg(F.when(ok, p)).alias("p_mean_correct"), F.stddev_pop(F.when(ok, p)).alias("p_std_correct"),
                  F.min(F.when(ok, p)).alias("p_min_correct"), F.max(F.when(ok, p)).alias("p_max_correct"),
                  F.avg(F.when(~ok, p)).alias("p_mean_wrong"), F.stddev_pop(F.when(~ok, p)).alias("p_std_wrong"),
                  F.min(F.when(~ok, p)).alias("p_min_wrong"), F.max(F.when(~ok, p)).alias("p_max_wrong"),
                  F.avg(hi_err.cast("double")).alias("high_confidence_error_rate"))


def benchmark_level(metrics: DataFrame, auc_col="roc_auc", acc_col="accuracy",
                    levels=BENCHMARKS_CLASSIFICATION) -> DataFrame:
    """MC19 — first level whose thresholds are all met (else 'below_acceptable')."""
    e = None
    for name, auc, acc in levels:
        cond = (F.col(auc_col) >= auc) & (F.col(acc_col) >= acc)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return metrics.withColumn("benchmark_level", e.otherwise(F.lit("below_acceptable")))


def probability_distribution(df: DataFrame, score="p", hi: float = 0.7, lo: float = 0.3) -> DataFrame:
    """MC20 — mean, std (ddof 0), min, max and counts of confident scores."""
    p = F.col(score)
    return df.agg(F.avg(p).alias("p_mean"), F.stddev_pop(p).alias("p_std"), F.min(p).alias("p_min"),
                  F.max(p).alias("p_max"), F.count_if(p >= hi).alias("n_high"), F.count_if(p <= lo).alias("n_low"),
                  F.count(p).alias("n"))


def ovo_auc(df: DataFrame, label="label", probs="probs", k: int = 10) -> DataFrame:
    """MC12 — one-vs-one AUC (Hand & Till): for each class pair (a, b) the mean
    of AUC(p_a | rows of a vs b) and AUC(p_b | rows of b vs a); macro mean over
    pairs.  Every row emits two records per pair it belongs to (its class and
    each other class), and all 2·k(k-1)/2 AUCs come from one grouped histogram."""
    p = F.col(probs)
    y = F.col(label)
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda c: c != y)
    d = df.where(y.between(0, k - 1)).select(y.alias("__y"), p.alias("__p"), F.explode(others).alias("__o"))
    a = F.least("__y", "__o")
    b = F.greatest("__y", "__o")
    recs = d.select(a.alias("class_a"), b.alias("class_b"), F.inline(F.array(
        F.struct(F.lit("a").alias("side"), F.element_at("__p", a + 1).alias("__s"),
                 (F.col("__y") == a).cast("int").alias("__pos")),
        F.struct(F.lit("b").alias("side"), F.element_at("__p", b + 1).alias("__s"),
                 (F.col("__y") == b).cast("int").alias("__pos")))))
    per = roc_auc(recs, "__pos", "__s", group=["class_a", "class_b", "side"])
    pair = per.groupBy("class_a", "class_b").agg(F.avg("roc_auc").alias("roc_auc"))
    macro = pair.agg(F.lit(-1).alias("class_a"), F.lit(-1).alias("class_b"), F.avg("roc_auc").alias("roc_auc"))
    return pair.unionByName(macro)
