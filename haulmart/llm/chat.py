"""Conversations rebuilt from event logs and rendered for training.

A log row is (conv_id, seq, event, message, role, text). ``message`` opens a
message, ``delta`` appends to it, ``edit`` puts another text in its place,
``regenerate`` drops what was streamed so far and ``delete`` drops the message.
Events of one message are folded in the order of ``seq``; messages stand in
the order of their first events. Only DataFrame functions are used.

Template: a user's turn stands in ``[INST]`` marks, an assistant's in ``<s>``
marks, any other role's in ``<<role>>`` marks. Inside texts and roles the
letters ``~ < [ >`` become ``~0 ~1 ~2 ~3``, so no text can hold a mark and
every text comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Letters that marks are made of and what stands for them.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), (">", "~3"))
_TURN = r"\[INST\][^\[<]*\[/INST\]|<s>[^\[<]*</s>|<<[^\[<>]*>>[^\[<]*<</>>"
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, message, first_seq, role, text): the final messages of an event log.

    A message whose last event but deltas is a ``delete`` is dropped. Null
    texts are empty, other events change nothing, deltas before any opening
    count from the start, and of equal ``seq`` the lesser event name, then
    text, comes first. The last role given holds.
    """
    event = F.struct("seq", "event", F.coalesce("text", F.lit("")).alias("text"), "role")
    folded = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("first_seq"), F.sort_array(F.collect_list(event)).alias("events")
    )
    at_reset = F.transform(
        "events", lambda e, i: F.when(e["event"].isin(*RESETS, "delete"), i + 1)
    )
    folded = folded.withColumn("from", F.coalesce(F.array_max(at_reset), F.lit(1)))
    folded = folded.withColumn(
        "live", F.slice("events", F.col("from"), F.size("events"))
    ).withColumn("roles", F.filter(F.col("events.role"), lambda r: r.isNotNull()))
    counted = F.filter(
        "live", lambda e: e["event"].isin(*RESETS, "delta") & e["text"].isNotNull()
    )
    return folded.filter(F.coalesce(F.col("live")[0]["event"] != "delete", F.lit(True))).select(
        "conv_id", "message", "first_seq",
        F.when(F.size("roles") > 0, F.element_at("roles", -1)).alias("role"),
        F.array_join(F.transform(counted, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of final messages.

    ``loss_spans`` are the (start, length) of assistants' escaped texts in
    ``formatted``, in characters. A conversation is one output row; its turns
    are placed by a window that reads them in order, before they meet.
    """
    text, role = escape(F.col("text")), escape(F.coalesce("role", F.lit("")))
    opening = (
        F.when(F.col("role") == "user", F.lit("[INST]"))
        .when(F.col("role") == "assistant", F.lit("<s>"))
        .otherwise(F.concat(F.lit("<<"), role, F.lit(">>")))
    )
    closing = (
        F.when(F.col("role") == "user", F.lit("[/INST]"))
        .when(F.col("role") == "assistant", F.lit("</s>"))
        .otherwise(F.lit("<</>>"))
    )
    order = ["first_seq", "message"]
    earlier = (
        Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    turns = messages.select(
        "conv_id", *order, "role", text.alias("inner"), opening.alias("opening"),
        F.concat(opening, text, closing).alias("piece"),
    )
    turns = turns.withColumn(
        "start", F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0)) + F.length("opening")
    )
    loss = F.when(
        F.col("role") == "assistant", F.struct("start", F.length("inner").alias("length"))
    )
    whole = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(*order, "piece", loss.alias("loss")))).alias("turns")
    )
    return whole.select(
        "conv_id",
        F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter(F.col("turns.loss"), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def formatted(log: DataFrame) -> DataFrame:
    return render(fold(log))


def parsed(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` (role, text), read back from ``formatted`` alone."""
    inner = lambda t: F.regexp_extract(t, r"^(?:\[INST\]|<s>|<<[^>]*>>)([^\[<]*)", 1)
    role = lambda t: (
        F.when(t.startswith("[INST]"), F.lit("user"))
        .when(t.startswith("<s>"), F.lit("assistant"))
        .otherwise(unescape(F.regexp_extract(t, r"^<<([^>]*)>>", 1)))
    )
    found = F.regexp_extract_all("formatted", F.lit(_TURN), 0)
    return chats.withColumn(
        "turns",
        F.transform(
            found, lambda t: F.struct(role(t).alias("role"), unescape(inner(t)).alias("text"))
        ),
    )


def log_of(rows: DataFrame, delta: int = 200) -> DataFrame:
    """The event log of finished conversations (conv_id, turn, role, text).

    An assistant's text is streamed in deltas of ``delta`` characters after a
    false start that is generated anew; other messages come whole. Rows that
    share a turn are messages of their own, in the order of role and text.
    """
    rank = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("conv_id", "turn", "role", text.alias("text")).withColumn(
        "message", F.row_number().over(rank)
    )
    pieces = F.expr(f"greatest(1, cast(ceil(length(text) / {delta}) as int))")
    streamed = F.flatten(F.array(
        F.array(
            F.struct(F.lit("message").alias("event"), F.lit("").alias("text")),
            F.struct(F.lit("delta").alias("event"), F.substring("text", 1, delta).alias("text")),
            F.struct(F.lit("regenerate").alias("event"), F.lit("").alias("text")),
        ),
        F.transform(
            F.sequence(F.lit(0), pieces - 1),
            lambda i: F.struct(
                F.lit("delta").alias("event"),
                F.col("text").substr(i * delta + 1, F.lit(delta)).alias("text"),
            ),
        ),
    ))
    plain = F.array(F.struct(F.lit("message").alias("event"), F.col("text").alias("text")))
    events = F.when(F.col("role") == "assistant", streamed).otherwise(plain)
    each = rows.select("conv_id", "message", "role", F.posexplode(events).alias("n", "e"))
    # The place in the log: by message, then by event.
    seq = F.col("message").cast("long") * (1 << 32) + F.col("n")
    return each.select("conv_id", seq.alias("seq"), "e.event", "message", "role", "e.text")
