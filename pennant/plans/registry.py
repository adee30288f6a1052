"""Imports every family of registered queries (side effect: fills REGISTRY)."""

from pennant.plans import catalog  # noqa: F401
from pennant.plans import q_agg, q_clean, q_core, q_extra, q_io, q_metrics, q_models, q_quality, q_scalar, q_stream, q_window  # noqa: F401

REGISTRY = catalog.REGISTRY
