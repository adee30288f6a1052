"""Null-safe arithmetic helpers.

Division never produces inf/NaN: ``try_divide`` returns NULL on a zero
denominator (Spark 4 runs ANSI mode, so plain ``/`` would raise).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pennant.session import materialize


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(a, b) -> Column:
    """a / b as double; NULL when b is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def safe_divide(a, b, fill: float = 0.0) -> Column:
    """SC25 — a / b with non-finite results replaced by ``fill``."""
    return F.coalesce(div(a, b), F.lit(float(fill)))


def clip(c, lo=None, hi=None) -> Column:
    """SC36 — clamp into [lo, hi] (either bound optional)."""
    out = col(c)
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return out


def flag(cond: Column) -> Column:
    """Boolean condition stored as 0/1 int (NULL stays NULL)."""
    return cond.cast("int")


def round_half_up(c, digits: int = 6):
    """floor(x * 10^d + 0.5) / 10^d — plain IEEE operations, so any engine
    given the same double returns the same double (decimal-string rounding
    and binary rounding disagree at ties).  |x| >= 1e12 is left as is."""
    c = col(c)
    k = float(10 ** digits)
    return F.when(F.abs(c) < 1e12, F.floor(c * k + 0.5) / k).otherwise(c)


def round_doubles(df, digits: int = 6):
    """Round every double column to ``digits`` (report/oracle boundary only)."""
    return df.select(*[round_half_up(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def attach_scalars(df, one_row):
    """Attach a ONE-ROW aggregate to every row: equi-join on a constant key with
    an explicit broadcast (its size is proven: one row), never a cross join."""
    k = "__one"
    return df.withColumn(k, F.lit(1)).join(F.broadcast(one_row.withColumn(k, F.lit(1))), k, "left").drop(k)


def broadcast_if_small(df, max_rows: int = 1_000_000):
    """Broadcast a lookup table only behind a checked size: the table is
    materialised, counted (one small job) and broadcast when it has at most
    ``max_rows`` rows; otherwise it is returned as is and the join falls back to
    a shuffle join (AQE may still choose a broadcast from runtime statistics).
    Nothing stays in executor storage."""
    df = materialize(df)
    return F.broadcast(df) if df.count() <= max_rows else df


#: Tables that :func:`persist_and_count` holds until :func:`release_held`.
_HELD: list = []


def persist_and_count(dfs):
    """Persist several tables and count their rows with ONE job (a union of
    tagged rows, partially aggregated); returns the persisted tables and counts.
    The tables are held until the caller has written what reads them and calls
    :func:`release_held`."""
    from functools import reduce
    dfs = [d.persist() for d in dfs]
    _HELD.extend(dfs)
    tagged = [d.select(F.lit(i).alias("__t")) for i, d in enumerate(dfs)]
    got = {r["__t"]: r["n"] for r in reduce(lambda a, b: a.unionByName(b), tagged)
           .groupBy("__t").agg(F.count(F.lit(1)).alias("n")).collect()}
    return dfs, [got.get(i, 0) for i in range(len(dfs))]


def release_held() -> None:
    """Frees the executor storage of the tables held so far."""
    while _HELD:
        _HELD.pop().unpersist()


def broadcast_all_if_small(dfs, max_rows: int = 1_000_000):
    """``broadcast_if_small`` for several lookup tables with ONE counting job."""
    dfs, counts = persist_and_count(dfs)
    return [F.broadcast(d) if n <= max_rows else d for d, n in zip(dfs, counts)]
