"""Quality rules with risk-controlled cutoffs.

Every rule compares one metric of a document with a cutoff.  Which cutoff holds in a stratum (a language, say)
is decided on labelled documents: cutoffs are tested from the most lenient to the strictest, and a cutoff is
accepted as long as the exact binomial test rejects "the rule loses more than ``risk`` of the good documents"
(P[Bin(n, risk) <= k] <= level for k false rejections among n good documents).  The order of the tests is fixed
beforehand, so the sequence needs no further correction; over rules and strata the level is divided (Bonferroni).
The risk of a stratum is divided among the rules, so all rules together lose at most ``risk`` of its good
documents, with confidence 1 - ``error`` for all strata at once.  A stratum with too few labels gets no cutoff.

Only DataFrame functions are used: metrics are computed row by row with array functions (nothing is exploded or
shuffled), labels are joined on narrow columns, and cutoffs come from one partially aggregated count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import SPACE, small, written

METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects documents with 1000 * top / base beyond a cutoff; ``cutoffs`` go from lenient to strict."""

    name: str
    top: str
    base: str
    above: bool
    cutoffs: tuple[int, ...]

    def value(self, q: str) -> Column:
        """Whole thousandths, so that every engine agrees; a document without base has no value and is kept."""
        base = F.col(f"{q}.{self.base}")
        return F.when(base > 0, F.floor(F.lit(1000) * F.col(f"{q}.{self.top}") / base)).cast("long")

    def rejects(self, value: Column, cutoff: Column) -> Column:
        return F.coalesce(value > cutoff if self.above else value < cutoff, F.lit(False))


RULES = (
    Rule("symbols", "n_symbols", "word_chars", True, (400, 300, 200, 150, 100, 70, 50, 30, 20, 10)),
    Rule("dup_lines", "n_dup_lines", "n_lines", True, (900, 800, 700, 600, 500, 400, 350, 300, 250, 200)),
    Rule("repeat_words", "n_repeat_words", "n_words", True, (450, 400, 350, 300, 250, 200, 150)),
    Rule("long_words", "word_chars", "n_words", True, (20000, 15000, 12000, 10000, 9000, 8000, 7500, 7000, 6500, 6000)),
    Rule("short_words", "word_chars", "n_words", False, (1000, 1500, 2000, 2500, 3000, 3250, 3500, 3750, 4000)),
)


def quality_metrics(docs: DataFrame, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Rows of ``docs`` as struct ``doc`` (or the columns ``keep`` of it) with a struct ``q`` of METRICS.

    Null and empty texts have zeros throughout.  The original row stays inside ``doc``, so no column name clashes.
    Three-word windows are told apart by 64-bit hashes within one text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*(keep or [F.struct("*").alias("doc")])).alias("d"), t.alias("t"))
    rows = rows.select("d", "t", F.filter(F.split("t", f"{SPACE}+"), lambda w: w != "").alias("w"),
                       F.filter(F.split("t", "\n"), lambda x: F.regexp_count(x, F.lit(f"^{SPACE}*[^\\x20\\x09-\\x0D]")) > 0)
                       .alias("lines"))
    rows = rows.select("d", "t", "lines", "w", F.size("w").cast("long").alias("n"),
                       F.transform("w", lambda w, i: F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2))).alias("h"))
    rows = rows.select("d", "t", "lines", "n", F.when(F.col("n") >= 3, F.slice("h", F.lit(1), (F.col("n") - 2).cast("int")))
                       .otherwise(F.expr("array()").cast("array<bigint>")).alias("h"))
    # windows that occur again: neighbours in hash order; their places in text order then cover 3 words at most each
    rows = rows.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"),
                                       F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("s", lambda x, i: F.coalesce((i > 0) & (F.get("s", i - 1)["h"] == x["h"]), F.lit(False))
                     | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(F.transform(again, lambda x: x["i"]))))
    covered = F.aggregate(F.transform("p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - p, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return rows.select(
        "d.*",
        F.struct(F.col("n").alias("n_words"),
                 F.length(F.regexp_replace("t", f"{SPACE}+", "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).alias("q"))


def base_failed(q: str = "q") -> Column:
    """The base rule: fewer than 50 words, or over half of the words in repeated three-word windows."""
    n, r = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (n < 50) | (F.lit(100) * r > F.lit(50) * n)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P[Bin(n, risk) <= k], summed in logarithms; 1 where k is above the mean (no cutoff passes there)."""
    odds = F.log(F.lit(risk / (1 - risk)))
    first = n * F.log(F.lit(1 - risk))
    start = F.struct(first.cast("double").alias("term"), first.cast("double").alias("total"))

    def step(a, i):
        term = a["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(term, a["total"])
        return F.struct(term.cast("double").alias("term"),
                        (top + F.log(F.exp(term - top) + F.exp(a["total"] - top))).cast("double").alias("total"))

    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, step, lambda a: F.exp(a["total"]))
    return F.when(k > n * risk, F.lit(1.0)).when(k == 0, F.exp(first)).otherwise(summed)


def risk_cutoffs(labelled: DataFrame, stratum: str = "stratum", good: str = "good", rules=RULES, risk: float = 0.05,
                 error: float = 0.05) -> DataFrame:
    """One row per stratum and rule: the accepted cutoff (null: none), labelled good documents, false rejections.

    ``labelled`` holds the struct ``q``, the stratum (null is a stratum of its own, named '') and ``good`` (boolean;
    null rows are left out).  Documents that fail the base rule don't count: no cutoff decides on them.
    """
    rows = labelled.where(F.col(good) & ~base_failed()).select(F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "q")
    lost = {r: [F.count_if(r.rejects(r.value("q"), F.lit(c))) for c in r.cutoffs] for r in rules}
    counts = written(rows.groupBy("stratum").agg(F.count("*").alias("n_good"), *[F.array(*v).alias(r.name) for r, v in lost.items()]),
                     "risk-counts")
    level = error / max(1, counts.count() * len(rules))
    each = counts.select("stratum", "n_good", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.array(*map(F.lit, r.cutoffs)).alias("cutoffs"), F.col(r.name).alias("lost"))
        for r in rules])).alias("x")).select("stratum", "n_good", "x.*")
    failed = F.transform("lost", lambda k: binomial_tail(k, F.col("n_good"), risk / len(rules)) > level)
    each = each.withColumn("passed", F.when(F.array_contains(failed, True), F.array_position(failed, True) - 1)
                           .otherwise(F.size("lost")).cast("int"))
    at = F.col("passed") - 1
    return each.select("stratum", "rule", "n_good", F.get("cutoffs", at).alias("cutoff"), F.get("lost", at).alias("n_lost"))


def judge(scored: DataFrame, cutoffs: DataFrame, stratum: Column, rules=RULES) -> DataFrame:
    """Adds ``base_failed`` and ``kept``.  One row per stratum is joined; it is broadcast if it is counted small.

    A stratum without labels has no cutoffs: only the base rule holds there.
    """
    wide = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cut"))
    joined = scored.withColumn("_stratum", F.coalesce(stratum, F.lit(""))).join(small(wide), "_stratum", "left")
    hit = F.lit(False)
    for r in rules:
        hit = hit | F.coalesce(r.rejects(r.value("q"), F.col("_cut")[r.name]), F.lit(False))
    return (joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~hit)
            .drop("_stratum", "_cut"))


def good_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document: good if every label row says quality 1; rows with nulls are left out."""
    return labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        (F.min("quality") == 1).alias("good"))


def apply_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
                rules=RULES, risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """Struct ``doc`` (the whole row), struct ``q``, ``base_failed`` and ``kept`` for every row of ``docs``.

    Repeated rows are judged one by one; an empty table gives an empty result; rows without a key are judged, but
    carry no label.  Rows and metrics are written once: the labelled counts read the metrics alone, and the verdicts
    filter what is written (a filter over the metrics' expressions would be pushed into them, over and over).
    """
    scored = written(quality_metrics(docs, text), "risk-scored")
    labelled = scored.select(F.col(f"doc.{key}").alias("_id"), F.col(f"doc.{stratum}").alias("stratum"), "q").join(good_labels(labels), "_id")
    cutoffs = written(risk_cutoffs(labelled, rules=rules, risk=risk, error=error), "risk-cutoffs")
    return judge(scored, cutoffs, F.col(f"doc.{stratum}"), rules)


def quality_verdicts(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang",
                     rules=RULES, risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """Like :func:`apply_rules`, without the texts: ``_id``, ``stratum``, ``q``, ``base_failed``, ``kept``; one pass."""
    narrow = written(quality_metrics(docs, text, [F.col(key).alias("_id"), F.col(stratum).alias("stratum")]), "risk-metrics")
    cutoffs = risk_cutoffs(narrow.join(good_labels(labels), "_id"), rules=rules, risk=risk, error=error)
    return judge(narrow, written(cutoffs, "risk-cutoffs"), F.col("stratum"), rules)
