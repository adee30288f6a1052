"""Validation and data quality (DQ1-DQ13).

Every gate is ONE aggregation job over the data (partial aggregation on each
executor, a single-row final); schema-level checks (required columns, types)
read ``df.schema`` and run no job at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

REQUIRED = ("team_name", "year", "wins", "losses", "winning_percentage", "games_behind",
            "wild_card_games_behind", "runs_scored", "runs_allowed", "run_differential")
NUMERIC = ("year", "wins", "losses", "winning_percentage", "runs_scored", "runs_allowed",
           "run_differential")
CRITICAL = ("team_name", "year", "wins", "losses")


def _is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)


def unparseable_count(df: DataFrame, col: str) -> F.Column:
    """DQ2 — non-null text that does not parse as a number (0 for numeric columns)."""
    if _is_numeric(df, col):
        return F.lit(0).cast("long")
    c = F.col(col)
    return F.count_if(c.isNotNull() & c.try_cast("double").isNull())


def validate(df: DataFrame, required=REQUIRED, numeric=NUMERIC, key=("team_name", "year"),
             period="year", period_bounds=(1901, 2025), critical=CRITICAL,
             total_bounds=(100, 165), min_rows: int = 1) -> DataFrame:
    """DQ1 — validation gate as a one-row issue table (one job)."""
    missing = sorted(set(required) - set(df.columns))
    non_numeric = [c for c in numeric if c in df.columns and not _is_numeric(df, c)]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if all(k in df.columns for k in key):
        aggs.append((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in key])).alias("n_duplicate_keys"))
    else:
        aggs.append(F.lit(0).cast("long").alias("n_duplicate_keys"))
    if period in df.columns:
        aggs += [F.min(period).alias("min_period"), F.max(period).alias("max_period")]
    else:
        aggs += [F.lit(None).cast("int").alias("min_period"), F.lit(None).cast("int").alias("max_period")]
    if "wins" in df.columns and "losses" in df.columns:
        t = F.col("wins") + F.col("losses")
        aggs.append(F.count_if((t < total_bounds[0]) | (t > total_bounds[1])).alias("n_unusual_totals"))
    nulls = [F.count_if(F.col(c).isNull()) for c in critical if c in df.columns]
    aggs.append(sum(nulls[1:], nulls[0]).alias("n_null_critical") if nulls
                else F.lit(0).cast("long").alias("n_null_critical"))
    r = df.agg(*aggs)
    lo, hi = period_bounds
    msgs = []
    if missing:
        msgs.append(F.lit("Missing required columns: " + ", ".join(missing)))
    for c in non_numeric:
        msgs.append(F.lit(f"Column '{c}' should be numeric"))
    msgs += [
        F.when(F.col("n_rows") < min_rows, F.concat(F.lit("Too few rows: "), F.col("n_rows").cast("string"))),
        F.when(F.col("n_duplicate_keys") > 0, F.concat(F.lit("Found "), F.col("n_duplicate_keys").cast("string"),
                                                       F.lit(" duplicate key combinations"))),
        F.when(F.col("min_period") < lo, F.concat(F.lit("Data contains periods before "), F.lit(str(lo)))),
        F.when(F.col("max_period") > hi, F.concat(F.lit("Data contains periods after "), F.lit(str(hi)))),
        F.when(F.col("n_null_critical") > 0, F.concat(F.lit("Critical columns have "),
                                                      F.col("n_null_critical").cast("string"),
                                                      F.lit(" missing values"))),
    ]
    issues = F.array_compact(F.array(*msgs))
    return r.select("*", F.size(issues).alias("n_issues"), F.concat_ws("; ", issues).alias("issues"),
                    (F.size(issues) == 0).cast("int").alias("is_valid"))


def numeric_check(df: DataFrame, columns) -> DataFrame:
    """DQ2 — per column: declared numeric?, count of unparseable values (one job)."""
    cols = [c for c in columns if c in df.columns]
    r = df.agg(*[unparseable_count(df, c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', {int(_is_numeric(df, c))}, `{c}`" for c in cols)
    return r.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, is_numeric, n_unparseable)")


def duplicate_key_count(df: DataFrame, keys) -> DataFrame:
    """DQ3 — rows beyond the first per key (count - count distinct; one job)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(*[F.col(k) for k in keys]).alias("n_distinct_keys")) \
             .withColumn("n_duplicate_keys", F.col("n_rows") - F.col("n_distinct_keys"))


def period_range_check(df: DataFrame, period="year", lo=1901, hi=2025) -> DataFrame:
    """DQ4 — min/max period and counts outside the allowed range."""
    p = F.col(period)
    return df.agg(F.min(p).alias("min_period"), F.max(p).alias("max_period"),
                  F.count_if(p < lo).alias("n_before"), F.count_if(p > hi).alias("n_after"))


def unusual_totals(df: DataFrame, lo=100, hi=165) -> DataFrame:
    """DQ5 — seasons whose game total is outside [lo, hi] (warning only)."""
    t = F.col("wins") + F.col("losses")
    return df.agg(F.count_if((t < lo) | (t > hi)).alias("n_unusual"), F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """DQ6 — NULL count per column, long form (one job)."""
    cols = list(columns or df.columns)
    r = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return r.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_null)")


def data_info(df: DataFrame, entity="team_name", period="year", approx: bool = False) -> DataFrame:
    """DQ8 — rows, columns (count and names), period range, distinct entities, NULLs in all and per column (one job)."""
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    distinct = F.approx_count_distinct(entity) if approx else F.count_distinct(entity)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  F.min(period).alias("min_period"), F.max(period).alias("max_period"),
                  distinct.alias("n_entities"), sum(nulls[1:], nulls[0]).alias("n_missing_total"),
                  F.lit(",".join(df.columns)).alias("column_names"),
                  F.concat_ws(",", *[F.concat(F.lit(f"{c}:"), n.cast("string")) for c, n in zip(df.columns, nulls)])
                  .alias("missing_by_column"))


def quality_profile(df: DataFrame, columns=None) -> DataFrame:
    """DQ9 — per numeric column: type, mean, std (ddof 1), min, max, zeros, negatives,
    missing count and percent, long form; from one aggregation."""
    cols = [c for c in (columns or df.columns) if _is_numeric(df, c)]
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}"), F.count_if(x == 0).alias(f"z{i}"), F.count_if(x < 0).alias(f"neg{i}"),
                 F.count_if(x.isNull()).alias(f"na{i}")]
    r = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{types[c]}', m{i}, s{i}, lo{i}, hi{i}, z{i}, neg{i}, na{i}" for i, c in enumerate(cols))
    long = r.selectExpr("__n", f"stack({len(cols)}, {stack}) as (column_name, dtype, mean, std, min, max, "
                               "n_zero, n_negative, n_missing)")
    return long.withColumn("pct_missing", F.col("n_missing") * 100.0 / F.col("__n")).drop("__n")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """DQ9 (part) — whole-row duplicates: count - count(distinct all columns)."""
    return df.groupBy(*df.columns).count().agg(
            F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct_rows")) \
        .withColumn("n_duplicate_rows", F.col("n_rows") - F.col("n_distinct_rows"))


def validate_input(df: DataFrame, required=("team_name", "wins", "losses", "runs_scored"),
                   max_games: int = 163, numeric=("wins", "losses", "runs_scored")) -> DataFrame:
    """DQ11 — per-row input validation before scoring; adds ``errors`` text and
    ``is_valid``; split good/bad with a filter on ``is_valid``."""
    checks = []
    for c in required:
        if c not in df.columns:
            checks.append(F.lit(f"missing column {c}"))
        else:
            checks.append(F.when(F.col(c).isNull(), F.lit(f"missing {c}")))
    for c in numeric:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            checks.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), F.lit(f"not a number: {c}")))
        elif c in df.columns and not _is_numeric(df, c):
            checks.append(F.lit(f"not a number: {c}"))
    if "wins" in df.columns and "losses" in df.columns:
        checks.append(F.when(F.col("wins").try_cast("double") + F.col("losses").try_cast("double") > max_games, F.lit("too many games")))
    errs = F.array_compact(F.array(*checks))
    return df.withColumns({"n_errors": F.size(errs), "errors": F.concat_ws("; ", errs),
                           "is_valid": (F.size(errs) == 0).cast("int")})


def missing_profile(df: DataFrame) -> DataFrame:
    """DQ12 — columns with missing values, count and percent, most missing first."""
    r = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = r.selectExpr("__n", f"stack({len(df.columns)}, {stack}) as (column_name, n_missing)")
    return (long.where(F.col("n_missing") > 0)
            .withColumn("pct_missing", F.col("n_missing") * 100.0 / F.col("__n")).drop("__n")
            .orderBy(F.desc("n_missing"), "column_name"))


def feature_validity(df: DataFrame, ratio_columns) -> DataFrame:
    """DQ13 — count of non-finite doubles and of ratio values outside [0, 1]."""
    dbl = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    inf = [F.count_if(F.isnan(F.col(c)) | (F.abs(F.col(c)) == float("inf"))) for c in dbl]
    out = [F.col(c) for c in ratio_columns if c in df.columns]
    bad = [F.count_if((c < 0) | (c > 1)) for c in out]
    return df.agg((sum(inf[1:], inf[0]) if inf else F.lit(0)).alias("n_non_finite"),
                  (sum(bad[1:], bad[0]) if bad else F.lit(0)).alias("n_ratio_out_of_range"))
