"""DuckDB oracle SQL per registered query key."""

from __future__ import annotations

import os

from oracle.panel_sql import CLEAN, RAW, features_cte, with_ctes
from pennant.config import SYNTHETIC

CFG = SYNTHETIC
SQL: dict = {}


P_RAW = with_ctes(RAW)
P_CLEAN = with_ctes(RAW, CLEAN)
P_FEAT = with_ctes(RAW, CLEAN, features_cte(CFG))


SQL["raw_panel"] = P_RAW + "\nSELECT * FROM raw"
SQL["CL16_preprocess"] = P_CLEAN + "\nSELECT * FROM clean"
SQL["features_full"] = P_FEAT + "\nSELECT * FROM features"


_DESCRIBE = None


def _describe_con():
    """In-memory DuckDB with the tables bound (binding only; nothing is scanned)."""
    global _DESCRIBE
    if _DESCRIBE is None:
        import duckdb
        con = duckdb.connect()
        for t in ("region nation customer supplier part orders lineitem events documents embeddings "
                  "pages benchmark labels conversations").split():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SCHEMA_DIR}/{t}.parquet')")
        _DESCRIBE = con
    return _DESCRIBE


SCHEMA_DIRS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1")
SCHEMA_DIR = next((d for d in SCHEMA_DIRS if os.path.exists(f"{d}/lineitem.parquet")), SCHEMA_DIRS[0])
_ROUNDED: dict = {}


def rounded(sql: str) -> str:
    """Wrap ``sql`` so every DOUBLE output column is rounded to 6 digits — the
    same output boundary the Spark side applies (``round_doubles``)."""
    if sql in _ROUNDED:
        return _ROUNDED[sql]
    try:
        cols = _describe_con().execute(f"DESCRIBE ({sql})").fetchall()
        dbl = [r[0] for r in cols if r[1] in ("DOUBLE", "FLOAT")]
    except Exception:  # noqa: BLE001 — leave unrounded if binding is impossible
        dbl = []
    if dbl:
        rep = ", ".join(f'CASE WHEN abs("{c}") < 1e12 THEN floor("{c}" * 1000000.0::DOUBLE + 0.5::DOUBLE) '
                        f'/ 1000000.0::DOUBLE ELSE "{c}" END AS "{c}"' for c in dbl)
        res = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"
    else:
        res = sql
    _ROUNDED[sql] = res
    return res


def all_sql() -> dict:
    return {k: rounded(v) for k, v in SQL.items()}


# Families register their SQL into ``SQL`` on import (after the helpers above exist).
from oracle import sql_agg, sql_clean, sql_extra, sql_io, sql_metrics, sql_models, sql_quality, sql_scalar, sql_stream, sql_window  # noqa: E402,F401
