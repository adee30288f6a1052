"""Model operators on MLlib: estimators, calibration, tuning, ensembles,
intervals and per-entity forecasting."""
