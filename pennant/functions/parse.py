"""Parsing of semi-structured text columns (CL6-CL9) with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RECORD_PATTERN = r"^(\d+)-(\d+)"


def to_int(c) -> Column:
    """CL6 — numeric coercion; unparseable text becomes NULL (no ANSI error)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("int")


def to_double(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def record_part(c, part: int) -> Column:
    """CL7 — 'W-L' text -> wins (part 1) or losses (part 2); prefix match, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, RECORD_PATTERN, part).try_cast("int")


def record_prefix(name: str) -> str:
    """Output prefix of a parsed record column: the name without 'record_'."""
    return name.replace("record_", "")


def parse_record(name: str) -> list[Column]:
    p = record_prefix(name)
    return [record_part(name, 1).alias(f"{p}_wins"), record_part(name, 2).alias(f"{p}_losses")]


def parse_last_10(name: str = "record_in_the_last_10_games") -> list[Column]:
    """CL8 — last-10 record with a (5, 5) fallback; pct is always wins / 10."""
    w = F.coalesce(record_part(name, 1), F.lit(5))
    l = F.coalesce(record_part(name, 2), F.lit(5))
    return [w.alias("last_10_wins"), l.alias("last_10_losses"), (w / F.lit(10.0)).alias("last_10_pct")]


def parse_streak(name: str = "current_streak") -> list[Column]:
    """CL9 — 'W3' -> ('W', 3); null/blank -> ('W', 0); bad length -> 0."""
    s = F.trim(F.col(name))
    blank = s.isNull() | (s == "")
    kind = F.when(blank, F.lit("W")).otherwise(F.substring(s, 1, 1))
    length = F.when(blank, F.lit(0)).otherwise(
        F.coalesce(F.substring(s, 2, 1 << 20).try_cast("int"), F.lit(0)))
    return [kind.alias("streak_type"), length.alias("streak_length"),
            (kind == "W").cast("int").alias("on_winning_streak")]
