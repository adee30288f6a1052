"""Secret scan: candidate strings by pattern, false positives removed by a random forest.

Candidates are long runs of key-like characters, and any value of six or more characters that is assigned to a secret's
name (in quotes, or without spaces).  The forest sees a candidate's length and make-up, its character
transitions (changes of class, and the mean log-probability of its letter pairs under the corpus' own words), how much
of it dictionary words cover (words that occur in the corpus at least five times), the path it was found under, and
the words beside it.  It is trained on labelled findings; where no labels are given, findings whose format or context
proves what they are serve (:func:`provable`).  The dictionary and the letter pairs are counted over all texts.

Everything is DataFrame functions and Spark ML in the JVM.  Texts are read, never shuffled, except the few with
findings when they are redacted.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import small, written

#: A candidate: a whole run of 12 or more key characters with a digit in it, or of 16 or more capitals.
CANDIDATE = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9]|[A-Z]{16})[A-Za-z0-9+/_\-]{12,}={0,2}"
NAMES = r"(?i:(?:pass(?:word|wd|phrase)?|secret|token|api[_ \-]?key|access[_ \-]?key|private[_ \-]?key|auth|credential)s?)"
#: What may stand between a secret's name and its value; bounded, so that it can be looked back at.
SIGN = r"[0-9]{0,8}(?i:key|value)?(?:[_\-][A-Za-z0-9_\-]{0,40})?[\"']?[ \t]{0,32}(?::=|=>|={1,3}|:)[ \t]{0,32}"
ASSIGNED = NAMES + r"[\"']?\s*(=|:|:=|=>)\s*[\"']?$|" + NAMES + SIGN + r"[\"']?$"
#: A value after a name and a sign: what is in quotes, else all up to a space or quote without closing punctuation.  The
#: short looks back keep the long one from most places.
VALUE = (r"(?<=[=:> \t\"'])(?<=[=:>][ \t]{0,32}[\"']?)(?<=" + NAMES + SIGN + r"[\"']?)"
         r"(?:(?<=\")[^\"\r\n]{6,}(?=\")|(?<=')[^'\r\n]{6,}(?=')|[^\s\"']{5,}[^\s\"'.,;:)\]}>])")
#: Everything the scan looks at.  A run of CANDIDATE that begins where a VALUE does is a part of it.
FOUND = VALUE + "|" + CANDIDATE
FEATURES = ("length", "digits", "capitals", "distinct", "changes", "is_hex", "transition", "coverage", "path_hint", "path_bucket",
            "assigned", "named", "before_word", "after_quote", "dashes")
MARK = "[SECRET]"


def candidates(docs: DataFrame, text: str = "text", path: str = "source", keep: list[Column] | None = None) -> DataFrame:
    """A row per candidate: columns ``keep``, ``path``, ``place`` (its number in the text, from 0), ``start`` (code
    points before it), ``value``, ``before`` (48 characters), ``after`` (16).  Null and empty texts have none."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*(keep or []), F.coalesce(F.col(path), F.lit("")).alias("path"), t.alias("_t")).where(F.col("_t").rlike(FOUND))
    rows = rows.withColumn("_m", F.regexp_extract_all("_t", F.lit(FOUND), 0)).withColumn("_s", F.split("_t", FOUND, -1)).drop("_t")
    ends = F.aggregate(F.zip_with(F.slice("_s", F.lit(1), F.size("_m")), "_m", lambda s, m: F.struct(F.length(s).alias("s"), F.length(m).alias("m"))),
                       F.expr("array(cast(0 as bigint))"), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["s"] + x["m"])))
    rows = rows.withColumn("_at", ends)
    each = F.transform("_m", lambda m, i: F.struct(
        i.cast("int").alias("place"), (F.get("_at", i) + F.length(F.get("_s", i))).alias("start"), m.alias("value"),
        F.substring(F.get("_s", i), -48, 48).alias("before"), F.substring(F.get("_s", i + 1), 1, 16).alias("after")))
    return rows.withColumn("_c", F.explode(each)).drop("_m", "_s", "_at").select("*", "_c.*").drop("_c")


def dictionary(docs: DataFrame, text: str = "text", least: int = 5) -> DataFrame:
    """``word``, ``n``: lower-case words of 3 to 24 ASCII letters that occur ``least`` times or more in all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z]+")).alias("word"))
    return words.where("length(word) between 3 and 24").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def transition_table(words: DataFrame) -> dict[str, float]:
    """Log-probability of a letter after a letter, over the dictionary; 26 * 26 entries at most come to the driver."""
    pair = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"), "n")
    got = {r["pair"]: r["n"] for r in pair.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    import math

    total = {}
    for p, n in got.items():
        total[p[0]] = total.get(p[0], 0) + n
    return {p: math.log(n / (total[p[0]] + 26)) for p, n in sorted(got.items())}


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds FEATURES.  The dictionary is joined with the letter runs of the distinct candidates only."""
    table = transition_table(words)
    letters = "abcdefghijklmnopqrstuvwxyz"
    logs = F.array(*[F.lit(table.get(a + b, -7.0)) for a in letters for b in letters])
    value, n = F.col("value"), F.length("value")
    runs = found.select("value").distinct().select("value", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,24}"), F.lit(0)))).alias("word"))
    covered = runs.join(words.select("word"), "word").groupBy("value").agg(F.sum(F.length("word")).alias("_covered"))
    rows = found.join(covered, "value", "left")
    rows = rows.withColumn("_codes", F.transform(F.split(F.lower(value), ""), lambda c: F.ascii(c) - 97))
    pairs = F.zip_with("_codes", F.slice("_codes", F.lit(2), F.size("_codes")), lambda a, b: F.when(
        a.between(0, 25) & b.between(0, 25), F.get(logs, a * 26 + b)).when(b.isNotNull(), F.lit(-7.0)).otherwise(F.lit(0.0)))
    count = lambda p: F.regexp_count(value, F.lit(p))
    yes = lambda c: F.when(c, 1.0).otherwise(0.0)
    return rows.withColumns({
        "length": n.cast("double"), "digits": count("[0-9]") / n, "capitals": count("[A-Z]") / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "changes": (count("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+") - 1) / n, "is_hex": yes(value.rlike("^[0-9a-f]+$")),
        "transition": F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / n,
        "coverage": F.coalesce(F.col("_covered") / n, F.lit(0.0)),
        "path_hint": yes(F.col("path").rlike("(?i)test|example|sample|mock|doc")), "path_bucket": F.pmod(F.xxhash64("path"), F.lit(16)).cast("double"),
        "assigned": yes(F.col("before").rlike(r"[=:]\s*[\"']?$")), "named": yes(F.col("before").rlike(NAMES + r"[^A-Za-z]{0,6}$")),
        "before_word": F.length(F.regexp_extract("before", r"([A-Za-z]+)[^A-Za-z]{0,6}$", 1)).cast("double"),
        "after_quote": yes(F.col("after").rlike("^[\"']")), "dashes": count("[-_/+]") / n}).drop("_covered", "_codes")


def provable(found: DataFrame) -> DataFrame:
    """Adds ``label`` to a featured frame.  1.0: a known key format, or a value assigned to a secret's name that is a run
    of CANDIDATE or mixes three kinds of characters.  0.0: placeholders; plain numbers, dates, UUIDs and lower-case
    words with numbers where no secret's name stands before; and, after a name, templates, keywords, calls without
    quotes, and single words of the corpus' dictionary.  Null for the rest."""
    v, named = F.col("value"), F.col("before").rlike(ASSIGNED)
    format_ = v.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^sk_live_[A-Za-z0-9]{16,}$|^xox[bap]-[A-Za-z0-9\-]{20,}$")
    dummy = v.rlike(r"(?i)example|x{6}|0{8}|1234567|^changeme")
    plain = v.rlike(r"^[0-9/+_\-]+$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[a-z/_\-]+[0-9]{0,4}$")
    run = v.rlike("^" + CANDIDATE + "$")
    mixed = sum(F.when(v.rlike(p), 1).otherwise(0) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]")) >= 3
    template = v.rlike(r"(?i)^(\$?\{.*\}|\$\(.*\)|<.*>|%.*%|[*._\-]+|null|false|undefined|string|required|optional|missing|invalid|unknown|default)$")
    call = v.rlike(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*[(\[]") & ~F.col("before").rlike("[\"']$")
    word = v.rlike("^[A-Za-z]?[a-z]+$") & (F.col("coverage") >= 1)
    return found.withColumn("label", F.when(dummy, 0.0).when(format_ | (named & run), 1.0).when(named & (template | call | word), 0.0)
                            .when(named & mixed & ~v.rlike(r"\s"), 1.0).when(plain & ~named, 0.0))


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str = "source", keep: list[Column] | None = None,
         most_labels: int = 20_000, trees: int = 40, depth: int = 8, threshold: float = 0.5) -> DataFrame:
    """Every candidate in every text, with ``score`` (the forest's probability) and ``is_secret``.

    ``labelled`` has the columns of :func:`candidates` and ``label`` (1.0 or 0.0; null rows are left out); default:
    the provable findings among the candidates.  The forest is fitted on at most ``most_labels`` labelled findings,
    distinct ones: of each label the first by hash, half of the number (at least one), so a rare label is never crowded
    out.  If one of the two labels is missing in all labelled findings nothing can be learned: then the provable
    label decides (score 1, 0, or 0.5 for the rest, which are not reported).  Empty tables give an empty result.
    """
    found = written(candidates(docs, text, path, keep), "secret-candidates")
    words = written(dictionary(docs, text), "secret-words")
    rows = written(provable(featured(found, words)), "secret-features")
    source = rows if labelled is None else featured(labelled, words)
    order = F.xxhash64("value", "before", "after", "path")
    known = source.where("label is not null").select("label", *FEATURES, order.alias("_o")).distinct()
    secret, other = (known.where(c).orderBy("_o").limit(max(1, most_labels // 2)) for c in ("label = 1", "label = 0"))
    sample = written(secret.unionByName(other).drop("_o"), "secret-sample")
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_v")
    if sample.select("label").distinct().count() < 2:
        scored = rows.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        forest = RandomForestClassifier(labelCol="label", featuresCol="_v", predictionCol="_p", rawPredictionCol="_r", probabilityCol="_q",
                                        numTrees=trees, maxDepth=depth, seed=10, featureSubsetStrategy="sqrt")
        scored = forest.fit(assemble.transform(sample)).transform(assemble.transform(rows)).withColumn("score", vector_to_array("_q")[1]).drop("_v", "_p", "_r", "_q")
    return scored.drop(*FEATURES, "label").withColumn("is_secret", F.col("score") > threshold)


def redact(docs: DataFrame, text: str = "text", path: str = "source", **how) -> DataFrame:
    """``docs`` with every secret replaced by MARK; all rows and columns stay.

    A verdict depends on the text and the path only, so it is found by their hash: repeated rows need no row numbers,
    and copies share one verdict.  Only texts with candidates take part in the join.
    """
    digest = lambda t, p: F.concat(F.unhex(F.md5(t)), F.unhex(F.md5(p)))
    key = digest(F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(path).cast("string"), F.lit("")))
    found = scan(docs, text=text, path=path, keep=[key.alias("_key")], **how)
    marks = found.where("is_secret").select("_key", "place").distinct().groupBy("_key").agg(F.collect_set("place").alias("_places"))
    has = F.coalesce(F.col(text), F.lit("")).rlike(FOUND)
    rows = docs.where(has).select(F.struct("*").alias("_doc"), key.alias("_key")).join(small(marks), "_key", "left")
    t = F.col(f"_doc.{text}")
    matches, between = F.regexp_extract_all(t, F.lit(FOUND), F.lit(0)), F.split(t, FOUND, -1)
    parts = F.zip_with(between, F.transform(matches, lambda m, i: F.when(F.array_contains("_places", i), F.lit(MARK)).otherwise(m)),
                       lambda s, m: F.concat(s, F.coalesce(m, F.lit(""))))
    clean = F.when(F.col("_places").isNull(), t).otherwise(F.array_join(parts, ""))
    changed = rows.withColumn("_clean", clean).select(F.col("_doc").withField(text, F.col("_clean")).alias("_doc")).select("_doc.*")
    return changed.unionByName(docs.where(~has))
