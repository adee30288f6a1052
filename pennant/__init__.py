"""pennant — entity x period panel analytics on Spark.

Sub-packages: ``sources`` (tables, panels, IO, dimensions), ``functions``
(column expressions), ``operators`` (quality, cleaning, windows, aggregates,
ranking, metrics, splits), ``plans`` (composed pipelines), ``models`` (MLlib
estimators, calibration, ensembles, forecasting) and ``streaming``.
"""

from pennant.config import DEFAULT, SYNTHETIC, PanelConfig  # noqa: F401
