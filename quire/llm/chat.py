"""Operator 4: chat formatting from an event log (DataFrame functions only).

A conversation arrives as events ``(conv_id, seq, turn, kind, role, text)``. Events of a turn are sorted by ``seq``
and folded into its final message:

* ``message`` and ``edit`` set the turn's text to the event's text,
* ``delta`` appends the event's text,
* ``regenerate`` drops what the turn holds so far (its text, usually null, starts the new one).

The role is that of the turn's last event that has one. Messages are rendered in the order of ``turn`` as
``<|turn|>role<|text|>text<|end|>`` and a newline. Inside roles and texts ``\\`` becomes ``\\\\``, ``<`` becomes ``\\l`` and
``[`` becomes ``\\b``, so no control string of this or a bracketed template can occur there, and the mapping is
one-to-one.

Defined cases: null text or role is empty; a null ``conv_id`` or ``turn`` is a value of its own; events with equal
``seq`` are taken in the order of kind, then text; repeated rows of a ``delta`` append twice; an empty log gives no
rows; columns other than the six are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
LEARNED_ROLE = "assistant"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("<"), F.lit("\\l"))
    return F.replace(c, F.lit("["), F.lit("\\b"))


def unescape(c: Column) -> Column:
    """Cut at escaped backslashes first; what lies between holds only ``\\l`` and ``\\b``."""
    parts = F.transform(F.split(c, "\\\\\\\\", -1), lambda x: F.replace(
        F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")))
    return F.array_join(parts, "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Events -> one row per turn ``(conv_id, turn, role, text)``. Grouped by conversation *and* turn, so a
    conversation that holds a large share of the log is spread over many tasks."""
    e = events.select("conv_id", "turn", F.struct(
        "seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role").alias("e"))
    g = e.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list("e")).alias("es"))
    resets = F.transform("es", lambda x, i: F.when(x["kind"] == "delta", F.lit(0)).otherwise(i + 1))
    g = g.withColumn("first", F.greatest(F.array_max(resets), F.lit(1)))
    roles = F.filter(F.transform("es", lambda x: x["role"]), lambda r: r.isNotNull())
    return g.select(
        "conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(F.slice("es", F.col("first"), F.size("es")), lambda x: x["text"]), "").alias("text"))


def format_chat(messages: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """Messages ``(conv_id, turn, role, text)`` -> one row per conversation: ``conv_id``, ``formatted`` (the text),
    ``segments`` (its pieces in order, each with ``loss``: whether it is learned) and ``loss_spans`` (start and
    end of the learned pieces in code points of ``formatted``). Each learned message's text is one span."""
    head = F.concat(F.lit(TURN), escape("role"), F.lit(TEXT))
    m = messages.select("conv_id", "turn", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    w = W.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.length("head") + F.length("body") + F.lit(len(END))
    m = m.withColumn("start", F.sum(size.cast("long")).over(w.rowsBetween(W.unboundedPreceding, 0)) - size
                     + F.length("head")).withColumn("n", F.row_number().over(w))
    g = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "n", "head", "body", "start", (F.col("role") == learned_role).alias("loss")))).alias("ms"))
    pieces = F.flatten(F.transform("ms", lambda x: F.array(
        F.struct(x["head"].alias("piece"), F.lit(False).alias("loss")),
        F.struct(x["body"].alias("piece"), x["loss"].alias("loss")),
        F.struct(F.lit(END).alias("piece"), F.lit(False).alias("loss")))))
    spans = F.transform(F.filter("ms", lambda x: x["loss"]), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + F.length(x["body"])).alias("end")))
    return g.select("conv_id", pieces.alias("segments"), spans.alias("loss_spans")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"),
        "segments", "loss_spans")


def parse_chat(formatted: Column) -> Column:
    """The messages in a formatted text, as an array of ``(role, text)``."""
    turns = F.filter(F.split(formatted, "<\\|turn\\|>", -1), lambda t: t != "")
    halves = F.transform(turns, lambda t: F.split(F.substring_index(t, END, 1), "<\\|text\\|>", -1))
    return F.transform(halves, lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")


def log_of_rows(rows: DataFrame, pieces: int = 8) -> DataFrame:
    """The event log that a service streaming the conversations ``(conv_id, turn, role, text)`` would have left:
    learned messages come as a draft, a regeneration and ``pieces`` deltas, every third other
    message as a shortened message and an edit. Rows are numbered within their conversation by turn, so that
    rows that repeat a turn stay messages of their own."""
    m = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    w = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    m = m.withColumn("turn", F.row_number().over(w))

    def event(kind, text):
        return F.struct(F.lit(kind).alias("kind"), F.col("role").alias("role"), text.cast("string").alias("text"))

    half = F.substring("text", 1, 40)
    size = F.ceil(F.length("text") / pieces).cast("int")
    deltas = [event("delta", F.substring(F.col("text"), size * i + 1, size)) for i in range(pieces)]
    streamed = F.array(event("delta", half), event("regenerate", F.lit(None)), *deltas)
    edited = F.array(event("message", half), event("edit", F.col("text")))
    plain = F.array(event("message", F.col("text")))
    log = F.when(F.col("role") == LEARNED_ROLE, streamed).when(F.col("turn") % 3 == 0, edited).otherwise(plain)
    return m.select("conv_id", "turn", F.posexplode(log).alias("seq", "e")).select(
        "conv_id", "seq", "turn", "e.kind", "e.role", "e.text")
