"""Distributed rank helpers.

pandas-style ``rank(pct=True)`` (average rank over the non-null count) without
a window over raw rows: rows are first collapsed to a value histogram per
group (partially aggregated: a hot value is one row per task), then prefix
counts are taken over the range-partitioned histogram (:func:`prefix_counts`),
so a group that holds a third of all rows is spread over a third of the
partitions.

The per-row result is attached with an equi-join on (group, value); AQE turns
it into a broadcast hash join when the histogram is small and keeps a
sort-merge join (with skew splitting) when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions.safe import broadcast_if_small
from pennant.session import materialize

_UNB = Window.unboundedPreceding


def _gkey(group_cols) -> Column:
    if not group_cols:
        return F.lit("")
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in group_cols])


def value_histogram(df: DataFrame, specs, weight: Column | None = None) -> DataFrame:
    """Long histogram ``(__m, __g, __v, __n)`` for several (group_cols, value) specs in one pass."""
    items = [F.struct(F.lit(i).alias("__m"), _gkey(g).alias("__g"),
                      F.col(v).cast("double").alias("__v"))
             for i, (g, v, *_rest) in enumerate(specs)]
    long = df.select(F.inline(F.array(*items)), (weight if weight is not None else F.lit(1)).alias("__w"))
    return (long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
            .groupBy("__m", "__g", "__v").agg(F.sum("__w").alias("__n")))


def prefix_counts(hist: DataFrame, keys, value: str, n: str, extra_sums: tuple = (), partitions: int | None = None) -> DataFrame:
    """Add ``__below`` (sum of ``n`` over strictly smaller values within ``keys``) and ``__tot`` (group total) to a
    histogram; ``extra_sums`` are further count columns cumulated the same way (``__below_<c>``, ``__tot_<c>``).

    One algorithm for every size: the histogram is range-partitioned by (keys, value), so sampled bounds spread a
    large group over as many partitions as its share of the rows, whatever the distribution of its values; it is
    materialised once, so that totals and rows see the same bounds.  Totals per (keys, partition) are cumulated over
    the partitions (at most groups + partitions rows), and each row adds the running sum inside its own partition."""
    keys, sums = list(keys), [n, *extra_sums]
    parts = partitions or int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = materialize(hist.repartitionByRange(parts, *keys, value).withColumn("__part", F.spark_partition_id()))
    totals = h.groupBy(*keys, "__part").agg(*[F.sum(c).alias(f"__pn_{c}") for c in sums])
    over = Window.partitionBy(*keys)
    before = over.orderBy("__part").rowsBetween(_UNB, -1)
    totals = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__part").alias("__p"),
                           *[F.coalesce(F.sum(f"__pn_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sums],
                           *[F.sum(f"__pn_{c}").over(over).alias(f"__tot_{c}") for c in sums])
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    inside = Window.partitionBy(*keys, "__part").orderBy(value).rowsBetween(_UNB, -1)
    out = h.withColumns({f"__in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}).join(totals, same)
    out = out.withColumns({f"__below_{c}": F.col(f"__off_{c}") + F.col(f"__in_{c}") for c in sums})
    out = out.withColumnRenamed(f"__below_{n}", "__below").withColumnRenamed(f"__tot_{n}", "__tot")
    return out.drop("__part", "__p", *[f"__k_{k}" for k in keys], *[f"__{x}_{c}" for x in ("off", "in") for c in sums])


def ranked_histogram(source: DataFrame, specs, hist: DataFrame | None = None) -> DataFrame:
    """Materialised ``(__m, __g, __v, __pct)``: pandas ``rank(pct=True)`` of every distinct value of every spec."""
    ranked = prefix_counts(value_histogram(source, specs) if hist is None else hist, ["__m", "__g"], "__v", "__n")
    return materialize(ranked.select("__m", "__g", "__v", ((F.col("__below") + (F.col("__n") + 1) / 2.0) / F.col("__tot")).alias("__pct")))


def attach_ranks(df: DataFrame, ranked: DataFrame, specs, broadcast: bool = False) -> DataFrame:
    """One equi-join lookup per spec; ``broadcast`` only when the caller has
    checked the histogram's size."""
    out = df
    for i, (g, v, o) in enumerate(specs):
        look = ranked.where(F.col("__m") == i).select(
            F.col("__g").alias(f"__g{i}"), F.col("__v").alias(f"__v{i}"), F.col("__pct").alias(o))
        if broadcast:
            look = F.broadcast(look)
        out = out.join(look, (_gkey(g) == F.col(f"__g{i}")) & (F.col(v).cast("double") == F.col(f"__v{i}")),
                       "left").drop(f"__g{i}", f"__v{i}")
    return out


def average_rank_pct(df: DataFrame, specs, source: DataFrame | None = None) -> DataFrame:
    """Attach pandas ``rank(pct=True)`` columns.

    ``specs``: list of ``(group_cols, value_col, out_col)``.  NULL values get
    NULL; ties share the average rank; denominator = non-null count in group.
    ``source`` (default ``df``) is the frame the histogram is built from — pass
    the materialised base so the plan does not re-derive ``df``.  The lookups'
    join strategy is left to AQE (see :func:`rank_table` for the checked path).
    """
    return attach_ranks(df, ranked_histogram(df if source is None else source, specs), specs)


def group_rank(df: DataFrame, specs, source: DataFrame | None = None) -> DataFrame:
    """Attach ranks within groups without a window over raw rows.

    ``specs``: list of ``(group_cols, value_col, out_col, method, descending)``
    with ``method`` in ``average`` | ``min`` | ``max`` (pandas semantics;
    NULL values get NULL)."""
    hist = value_histogram(df if source is None else source, [(g, v) for g, v, *_ in specs])
    ranked = materialize(prefix_counts(hist, ["__m", "__g"], "__v", "__n"))
    out = df
    below, n, tot = F.col("__below"), F.col("__n"), F.col("__tot")
    for i, (g, v, o, method, desc) in enumerate(specs):
        first = (tot - below - n + 1) if desc else (below + 1)     # rank of the first tie
        r = {"min": first, "max": first + n - 1, "average": first + (n - 1) / 2.0}[method]
        look = ranked.where(F.col("__m") == i).select(
            F.col("__g").alias(f"__g{i}"), F.col("__v").alias(f"__v{i}"),
            (r.cast("double") if method == "average" else r.cast("long")).alias(o))
        out = out.join(look, (_gkey(g) == F.col(f"__g{i}")) & (F.col(v).cast("double") == F.col(f"__v{i}")),
                       "left").drop(f"__g{i}", f"__v{i}")
    return out


#: Accuracy of the sketch that splits values into segments; only how many rows are sorted depends on it, not the result.
SKETCH = 2_000


def quantiles(df: DataFrame, value, qs, group=(), out: str = "quantiles") -> DataFrame:
    """Exact quantiles (linear interpolation: v[lo] + (v[hi] - v[lo]) * frac at position q·(n-1), as numpy /
    ``quantile_cont``) by selection: neither a group nor all values are gathered, sorted or shuffled.

    1. A mergeable sketch per group gives values near both sides of every quantile; they cut the group's values into
       segments.
    2. One counting pass (partially aggregated) tells exactly how many values lie in each segment, hence in which segment
       each wanted order statistic lies, and how many values are below the segment.
    3. Only values of these segments become a histogram with prefix counts, in which the order statistics are found.

    Returns one row per group with an array column ``out`` (same order as ``qs``)."""
    g, qs = list(group), [float(q) for q in qs]
    v = F.col(value).cast("double") if isinstance(value, str) else value.cast("double")
    keys = g or ["__grp"]
    rows = df.select(*[F.col(k) for k in g], *([] if g else [F.lit(0).alias("__grp")]), v.alias("__v"))
    rows = materialize(rows.where(F.col("__v").isNotNull() & ~F.isnan("__v")))
    near = sorted({min(1.0, max(0.0, q + side * 3 / SKETCH)) for q in qs for side in (-1, 1)})
    edges = rows.groupBy(*keys).agg(F.percentile_approx("__v", near, SKETCH).alias("__edges"))
    edges = broadcast_if_small(edges.select(*[F.col(k).alias(f"__e_{k}") for k in keys], "__edges"))
    cut = rows.join(edges, _same(keys, "__e_")).select(*keys, "__v", F.size(F.filter("__edges", lambda e: e <= F.col("__v"))).alias("__seg"))
    counts = cut.groupBy(*keys, "__seg").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)                                        # as many rows as segments
    counts = counts.select(*keys, "__seg", "__n", F.sum("__n").over(w).alias("__tot"), (F.sum("__n").over(w.orderBy("__seg")) - F.col("__n")).alias("__before"))
    places = F.transform(F.array(*[F.lit(q) for q in qs]), lambda q, i: F.struct(i.alias("qi"), (q * (F.col("__tot") - 1)).alias("p")))
    targets = F.flatten(F.transform(places, lambda x: F.array(*[
        F.struct(x["qi"].alias("qi"), F.lit(hi).alias("hi"), f(x["p"]).cast("long").alias("at"), (x["p"] - F.floor(x["p"])).alias("frac"))
        for hi, f in ((0, F.floor), (1, F.ceil))])))
    inside = F.filter(targets, lambda t: (t["at"] >= F.col("__before")) & (t["at"] < F.col("__before") + F.col("__n")))
    wanted = counts.withColumn("__t", inside).where(F.size("__t") > 0)
    wanted = broadcast_if_small(wanted.select(*[F.col(k).alias(f"__w_{k}") for k in keys], F.col("__seg").alias("__wseg"), "__before", "__t"))
    here = _same(keys, "__w_") & (F.col("__seg") == F.col("__wseg"))
    hist = cut.join(wanted, here, "left_semi").groupBy(*keys, "__seg", "__v").agg(F.count(F.lit(1)).alias("__n"))
    found = materialize(prefix_counts(hist, [*keys, "__seg"], "__v", "__n").select(*keys, "__seg", "__v", "__n", "__below")).join(wanted, here)
    one = found.select(*keys, "__v", F.explode(F.filter("__t", lambda t: (t["at"] - F.col("__before") >= F.col("__below"))
                                                          & (t["at"] - F.col("__before") < F.col("__below") + F.col("__n")))).alias("__t"))
    both = one.groupBy(*keys, F.col("__t.qi").alias("__qi")).agg(
        F.max("__t.frac").alias("__frac"), F.max(F.when(F.col("__t.hi") == 0, F.col("__v"))).alias("__lo"),
        F.max(F.when(F.col("__t.hi") == 1, F.col("__v"))).alias("__up"))
    val = F.col("__lo") + (F.col("__up") - F.col("__lo")) * F.col("__frac")
    res = both.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__qi", val.alias("__val")))).alias("__s"))
    res = res.select(*keys, F.transform("__s", lambda s: s["__val"]).alias(out))
    return res.drop("__grp") if not g else res


def _same(keys, prefix: str) -> Column:
    """Null-safe equality of the key columns with their prefixed copies."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def rank_table(source: DataFrame, keys, specs, ranked: DataFrame | None = None, partition_by=None) -> DataFrame:
    """Narrow table ``keys + one pct column per spec``: the lookups run on a
    narrow projection (keys + ranked values) instead of the wide frame; with
    ``partition_by`` the result is hash-partitioned on it."""
    need = list(dict.fromkeys([*keys, *[c for g, v, _ in specs for c in (*g, v)]]))
    narrow = source.select(*need)
    ranked = ranked if ranked is not None else ranked_histogram(narrow, specs)
    out = attach_ranks(narrow, ranked, specs).select(*keys, *[o for _, _, o in specs])
    return out.repartition(*[F.col(c) for c in partition_by]) if partition_by else out
