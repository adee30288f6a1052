"""Core panel queries: raw source, cleaning pipeline, full feature table."""

from pennant.plans.catalog import clean_panel, out, raw, register
from pennant.config import SYNTHETIC
from pennant.plans.features import engineer_features
from pennant.plans.preprocess import preprocess


@register("raw_panel")
def q_raw_panel(spark, sf):
    return out(raw(spark, sf))


@register("CL16_preprocess")
def q_preprocess(spark, sf):
    return out(preprocess(raw(spark, sf), SYNTHETIC))


@register("features_full")
def q_features(spark, sf):
    return out(engineer_features(clean_panel(spark, sf), SYNTHETIC))
