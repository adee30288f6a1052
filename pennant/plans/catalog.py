"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (the panel is derived from ``lineitem``),
so its work grows with the data.  Doubles are rounded to 6 digits at the
output boundary only, to make results comparable with the SQL oracle.

``features`` / ``clean_panel`` are shared building blocks, materialised with a
reliable checkpoint into ``spark.checkpoint.dir`` (the "written table in the
shared folder" pattern).  With ``MEMO`` on they are built once per
(application, table folder) and re-read by later queries; ``bench.py`` switches
it off so every query is timed from the raw tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pennant.config import SYNTHETIC
from pennant.functions.safe import release_held, round_doubles
from pennant.plans.features import engineer_features, materialize
from pennant.plans.preprocess import preprocess
from pennant.sources.panel import raw_team_season
from pennant.sources.tables import table_path

CFG = SYNTHETIC
REGISTRY: dict = {}
MEMO = True
_CACHE: dict = {}


def register(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def out(df: DataFrame) -> DataFrame:
    return round_doubles(df, 6)


def _memo(spark: SparkSession, sf: str, name: str, build):
    """The shared tables are branching points (histograms, lookups, fits and
    scoring all read them), so they are always materialised once per call;
    ``MEMO`` additionally reuses them across queries of the same application."""
    if not MEMO:
        return _written(build)
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), name, _version(spark, sf))
    if key not in _CACHE:
        _CACHE[key] = _written(build)
    return _CACHE[key]


def _written(build) -> DataFrame:
    """Materialises what ``build`` makes; lookup tables persisted on the way are free again."""
    try:
        return materialize(build(), "checkpoint")
    finally:
        release_held()


def _version(spark: SparkSession, sf: str, table: str = "lineitem") -> tuple:
    """Names, sizes and times of the table's files: a table that changes under its path has another version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf, table))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)))


def clear_memo() -> None:
    _CACHE.clear()


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_team_season(spark, sf)


def clean_panel(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(spark, sf, "clean", lambda: preprocess(raw(spark, sf), CFG))


def features(spark: SparkSession, sf: str, columns=None) -> DataFrame:
    """The feature table, or only some of its columns: without the memo only the blocks behind them are built."""
    if columns is not None and not MEMO:
        return _written(lambda: engineer_features(clean_panel(spark, sf), CFG, columns=list(dict.fromkeys(columns))))
    return _memo(spark, sf, "features", lambda: engineer_features(clean_panel(spark, sf), CFG))
