"""What ``__spark_entry__`` registers: the numbered operators and the pipeline over them."""

from __future__ import annotations

import corpus_pipeline

from pennant.llm.queries import QUERIES
from pennant.llm.sql import SQL

LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}
LLM_SQL = {k: v for k, v in SQL.items() if k in QUERIES}
if corpus_pipeline.ORACLE_SQL:
    LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
