"""Event-sourced chat formatting.

A conversation is a log of events ordered by sequence number: ``start`` opens a message with its role, ``delta`` adds
streamed text, ``edit`` replaces the text so far, ``regenerate`` discards it (deltas that follow build the new
answer).  The log is partitioned by conversation and message, folded into final messages, and the messages of a
conversation are rendered in order.

The fold keeps, of each message, only the events since its last edit or regeneration, found with one aggregation; the
concatenation then holds exactly the final text of one message.  Rendering groups the finished messages of one
conversation: that is the output record itself, so no group is larger than what is returned.

The template frames every turn: OPEN role newline text SHUT.  Inside roles and texts a backslash is doubled and every
control string gets a backslash after its first character, so no control string is left and the text comes back by
dropping each backslash that escapes the next character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SHUT = "<|turn|>", "<|end|>\n"
#: Control strings that must not stay whole inside a text: this template's, and those of common chat templates.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
EVENTS = ("start", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def escape_role(role: Column) -> Column:
    """A role as it stands in a turn's first line: line breaks are escaped as well."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_of(rows: DataFrame, piece: int = 4000) -> DataFrame:
    """The log of finished rows (``conv_id``, ``turn``, ``role``, ``text``) as a service would have streamed it.

    ``conv_id``, ``message``, ``seq``, ``event``, ``role``, ``text``.  A message is a row; rows of one conversation
    and turn are ordered by role and text, and rows that repeat one another share a message number and stay apart by
    ``copies``.  Long texts are streamed in pieces; answers are first drafted, then regenerated; other long turns
    are typed, then edited.  Null roles and texts are empty.
    """
    clean = rows.select("conv_id", F.coalesce("turn", F.lit(-1).cast("long")).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    one = clean.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("copies"))
    message = F.struct("turn", "role", F.xxhash64("text").alias("same"))
    parts = F.transform(F.sequence(F.lit(0), F.ceil(F.length("text") / piece).cast("int") - 1), lambda i: F.struct(
        F.lit("delta").alias("event"), F.lit(None).cast("string").alias("role"), F.substring("text", i * piece + 1, F.lit(piece)).alias("text")))
    step = lambda event, role, text: F.array(F.struct(F.lit(event).alias("event"), role.alias("role"), text.alias("text")))
    none = F.lit(None).cast("string")
    streamed = F.when(F.length("text") > 0, parts).otherwise(F.expr("array()").cast("array<struct<event:string,role:string,text:string>>"))
    drafted = F.concat(step("start", F.col("role"), none), step("delta", none, F.substring("text", 1, 40)),
                       F.when(F.col("role") == "assistant", step("regenerate", none, none)).otherwise(step("edit", none, F.lit(""))))
    log = one.select("conv_id", message.alias("message"), "copies", F.posexplode(F.concat(drafted, streamed)).alias("seq", "e"))
    return log.select("conv_id", "message", "copies", F.col("seq").cast("long").alias("seq"), "e.event", "e.role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``message``, ``copies``, ``role``, ``text``.

    Events of a message are taken by ``seq`` (equal numbers: by event name, then text; a repeated event counts once).
    The role is that of the last event that gives one ('' if none does); the text is the last edit's and the deltas
    after it, or only the deltas after the last regeneration.  Unknown events and null sequence numbers are left out.
    """
    key = ["conv_id", "message", "copies"]
    log = events.where(F.col("seq").isNotNull() & F.col("event").isin(*EVENTS)).select(*key, "seq", "event", "role", "text")
    reset = F.when(F.col("event").isin("edit", "regenerate"), F.col("seq"))
    last = log.groupBy(*key).agg(F.max(reset).alias("_reset"), F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("_role"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    live = log.alias("l").join(last.alias("r"), same).where("_reset is null or seq >= _reset").where("event <> 'regenerate'")
    texts = F.array_sort(F.collect_set(F.struct("seq", "event", F.coalesce("text", F.lit("")).alias("text"))))
    whole = live.groupBy(*[F.col(f"l.{k}") for k in key]).agg(texts.alias("t"))
    joined = F.array_join(F.transform("t", lambda x: x["text"]), "")
    done = whole.select(*key, joined.alias("text"))
    roles = last.select(*[F.col(k).alias(f"_{k}") for k in key], F.coalesce(F.col("_role.role"), F.lit("")).alias("role"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return roles.join(done, same, "left").select(*[F.col(f"_{k}").alias(k) for k in key], "role", F.coalesce("text", F.lit("")).alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss`` (spans ``start``, ``length`` in code points of the assistant texts, escaped).

    Messages are ordered by ``message``, then role and text; a null conversation is one conversation.
    """
    turns = messages.select("conv_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "copies"))).alias("_c"), "message", "role",
                            escape_role(F.col("role")).alias("r"), escape(F.col("text")).alias("t"), "text")
    row = F.struct("message.turn", "role", "text", "r", "t", "_c")
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("m"))
    shown = lambda x: F.concat(F.lit(OPEN), x["r"], F.lit("\n"), x["t"], F.lit(SHUT))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("array()").cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(a, x):
        own = (a["at"] + len(OPEN) + 1 + F.length(x["r"])).cast("long")
        size = F.length(x["t"]).cast("long")
        span = F.array(F.struct(own.alias("start"), size.alias("length")))
        return F.struct((own + size + len(SHUT)).alias("at"),
                        F.when(x["role"] == "assistant", F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return whole.select("conv_id", F.array_join(F.transform("m", shown), "").alias("formatted"),
                        F.aggregate("m", start, step, lambda a: a["spans"]).alias("loss"))


def parse(rendered: DataFrame) -> DataFrame:
    """Reads ``formatted`` back: ``turns`` (structs role, text) and ``loss_text`` (the masked texts, unescaped, joined)."""
    pieces = F.filter(F.split("formatted", r"<\|turn\|>"), lambda p: p != "")
    body = F.transform(pieces, lambda p: F.regexp_replace(p, r"<\|end\|>\n$", ""))
    first = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n"   # up to the first line break that isn't escaped
    turns = F.transform(body, lambda b: F.struct(unescape(F.regexp_extract(b, first, 1)).alias("role"),
                                                 unescape(F.regexp_replace(b, first + "(.*)$", "$2")).alias("text")))
    masked = F.transform("loss", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rendered.select("conv_id", "formatted", "loss", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))
