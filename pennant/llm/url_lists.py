"""URL filter lists as they stood when a page was fetched.

List entries are dated events (an entry is added, later removed, perhaps added again).  Per list and key they become
validity intervals, and every capture is joined as of its fetch time with the entries active then.  The most specific
active entry decides (a path prefix over a host, a host over its parent domains); between equals, block wins.

Keys of a capture are its host, the host's parent domains, and the host with each prefix of whole path segments, so
the join is an equality join.  Both sides also carry the month: a host that holds a third of all captures is spread
over the months of the crawl, and equal (url, time) pairs are evaluated once.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennant.llm.common import written

#: Scheme, authority and path of a URL, as patterns that every engine reads alike.
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and closing dot; '' where there is none (null, no scheme)."""
    own = F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), AUTHORITY, 1), r"^.*@", "")
    return F.lower(F.regexp_replace(own, r"\.?(:[0-9]*)?$", ""))


def path_segments(url: Column) -> Column:
    """Segments of the path, without empty ones."""
    return F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda s: s != "")


def capture_keys(host: Column, seg: Column) -> Column:
    """Structs (key, depth) under which an entry can name a URL of this host and path; deeper is more specific.

    Parent domains have depth 1 .. labels, path prefixes 1000 + number of segments (no host has 1000 labels).
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        F.array_join(F.slice(labels, n - i + 1, i), ".").alias("key"), i.cast("int").alias("depth")))
    paths = F.transform(seg, lambda s, i: F.struct(
        F.concat(host, F.lit("/"), F.array_join(F.slice(seg, F.lit(1), i + 1), "/")).alias("key"), (i + 1001).cast("int").alias("depth")))
    return F.when(host != "", F.concat(domains, paths)).otherwise(F.expr("array()").cast("array<struct<key:string,depth:int>>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``key``, ``verdict``, ``valid_from``, ``valid_to`` (null: still valid) from dated events.

    ``entries`` holds ``list``, ``key``, ``verdict`` ('block' or 'allow'), ``at`` (date) and ``op`` ('add' or 'remove').
    Events with a null are left out; repeated ones count once; on one day a removal comes after an addition.  Events
    are merged per day before the window, so a window partition holds at most one row per day.
    """
    known = entries.select("list", F.lower("key").alias("key"), "verdict", "at", "op").na.drop()
    days = known.groupBy("list", "key", "verdict", "at").agg((F.max(F.when(F.col("op") == "remove", 1).otherwise(0)) == 0).alias("on"))
    w = Window.partitionBy("list", "key", "verdict").orderBy("at")
    turns = days.withColumn("was", F.lag("on").over(w)).where("was is null or was <> on")
    ends = turns.withColumn("valid_to", F.lead("at").over(w))
    return ends.where("on").select("list", "key", "verdict", F.col("at").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetch_date") -> DataFrame:
    """Every row of ``captures`` as struct ``doc``, with ``host``, ``n_active`` (entries that matched), ``verdict``
    ('block', 'allow', or 'none'), and the deciding entry's ``list``, ``key``, ``valid_from``, ``valid_to``.

    A capture without host or without time matches nothing ('none').  Repeated rows are all returned.  An interval
    holds its first day, not its last.  Of equal deciding entries block comes first, then the smallest list name.
    """
    lists = written(validity_intervals(entries), "url-intervals")
    rows = captures.select(F.struct("*").alias("doc"), F.col(url).alias("_url"), F.to_date(F.col(at)).alias("_at"))
    seen = rows.where("_url is not null and _at is not null").select("_url", "_at").distinct()
    last = seen.agg(F.max("_at")).first()[0]
    month = lambda c: F.year(c) * 12 + F.month(c)
    end = F.least(F.coalesce("valid_to", F.lit(last).cast("date")), F.lit(last).cast("date"))
    spans = lists.where(F.col("valid_from") <= F.lit(last).cast("date")).withColumn(
        "_month", F.explode(F.sequence(month(F.col("valid_from")), month(end))))
    split = seen.withColumn("_host", url_host(F.col("_url"))).withColumn("_seg", path_segments(F.lower("_url")))
    keyed = split.withColumn("_k", F.explode(capture_keys(F.col("_host"), F.col("_seg")))).select("_url", "_at", "_k.key", "_k.depth", month(F.col("_at")).alias("_month"))
    hits = keyed.join(spans, ["key", "_month"]).where("valid_from <= _at and (valid_to is null or _at < valid_to)")
    best = hits.groupBy("_url", "_at").agg(F.count("*").alias("n_active"), F.min(F.struct(
        (-F.col("depth")).alias("d"), (F.col("verdict") != "block").alias("v"), "list", "key", "verdict", "valid_from", "valid_to")).alias("b"))
    best = best.withColumnsRenamed({"_url": "_u", "_at": "_t"})
    out = rows.join(best, (F.col("_url") == F.col("_u")) & (F.col("_at") == F.col("_t")), "left")
    return out.select("doc", url_host(F.col("_url")).alias("host"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                      F.coalesce("b.verdict", F.lit("none")).alias("verdict"), "b.list", "b.key", "b.valid_from", "b.valid_to")


def entries_from_pages(pages: DataFrame, start: str = "2024-01-01") -> DataFrame:
    """Dated entries for hosts, parent domains and first path segments that occur in ``pages``, chosen by md5.

    The tables hold no filter lists; these grow with the pages and are the same in every engine.
    """
    day = lambda n: F.date_add(F.lit(start).cast("date"), n.cast("int"))
    number = lambda c: F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("long")
    urls = pages.select(url_host(F.col("url")).alias("host"), F.get(path_segments(F.lower("url")), F.lit(0)).alias("seg")).where("host <> ''").distinct()
    hosts = urls.select("host").distinct().withColumn("v", number(F.col("host")))
    first = day(F.col("v") % 200)
    event = lambda name, key, verdict, at, op, on: F.when(on, F.struct(
        F.lit(name).alias("list"), key.alias("key"), F.lit(verdict).alias("verdict"), at.alias("at"), F.lit(op).alias("op")))
    v, host = F.col("v"), F.col("host")
    spam = hosts.select(F.explode(F.array(
        event("spam", host, "block", first, "add", v % 3 == 0), event("spam", host, "block", F.date_add(first, 60), "remove", v % 6 == 0),
        event("spam", host, "block", F.date_add(first, 100), "add", v % 30 == 0))).alias("e")).where("e is not null").select("e.*")
    parents = hosts.select(F.regexp_replace("host", r"^[^.]*\.", "").alias("p")).distinct().withColumn("v", number(F.col("p")))
    wide = parents.where(v % 4 == 0).select(F.lit("domains").alias("list"), F.col("p").alias("key"), F.lit("block").alias("verdict"),
                                            day(v % 300).alias("at"), F.lit("add").alias("op"))
    parts = urls.where("seg is not null").select(F.concat_ws("/", "host", "seg").alias("k")).distinct().withColumn("v", number(F.col("k")))
    free = parts.where(v % 5 == 0).select(F.lit("cleared").alias("list"), F.col("k").alias("key"), F.lit("allow").alias("verdict"),
                                          day(v % 250).alias("at"), F.lit("add").alias("op"))
    return spam.unionByName(wide).unionByName(free)


def dated_pages(pages: DataFrame, start: str = "2024-01-01") -> DataFrame:
    """``page_id``, ``url`` and a fetch date from the page's number (the table holds none)."""
    return pages.select("page_id", "url", F.date_add(F.lit(start).cast("date"), F.pmod(F.col("page_id"), F.lit(365)).cast("int")).alias("fetch_date"))
