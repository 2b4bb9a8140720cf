"""Chat formatting by event-sourced reconstruction.

A conversation log is a table of events ``conv_id, seq, kind, turn, role, text``:

* ``message`` gives turn ``turn`` its role and text (a later message on the same turn replaces it);
* ``delta`` appends its text to the turn (streamed output), in ``seq`` order, after the last reset;
* ``edit`` and ``regenerate`` replace the text of the turn and discard every later turn born before them.

``fold`` replays the log: one aggregation per (conversation, turn) finds the last reset and the deltas
after it, and a running maximum over the turns of a conversation finds the cuts of earlier turns.
``render`` writes every turn as

    ### <role>:\\n<text>\\n</turn>\\n

where a backslash, ``#`` and ``<`` inside a text (and also ``:`` and a line break inside a role) are
preceded by a backslash, so a text can hold any control string and the template stays unambiguous: the
end mark ``\\n</turn>\\n`` cannot occur inside an escaped text, because every ``<`` there follows a
backslash. The loss mask is the list of character spans of assistant texts in the formatted string.
``read_back`` parses a written table of formatted conversations and undoes the escapes.

Defined cases: null text is empty, null role is the empty role, a null conversation id is one
conversation; equal rows are separate turns when a caller numbers them so (``events_from_turns``);
an empty log gives no conversation. Everything runs as DataFrame expressions; a conversation is the unit
of one formatted string, so it is formed in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio.operators.ranking import staged_rank

# fixed values of the template
HEADER = "### "
ROLE_END = ":\n"
TURN_END = "\n</turn>\n"
LOSS_ROLE = "assistant"
RESETS = ("message", "edit", "regenerate")
CUTS = ("edit", "regenerate")

_PARSE = r"(?s)^### ((?:\\.|[^\\:])*):\n(.*)\z"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\#<])", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.coalesce(role, F.lit("")), r"([\\#<:\n])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_from_turns(rows: DataFrame) -> DataFrame:
    """A ``message`` event per row of a (conv_id, turn, role, text) table, numbered by turn (null last), role and text."""
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ranked = staged_rank(rows.select("conv_id", "turn", "role", "text"), ["conv_id"], order, name="slot")
    return ranked.select(
        "conv_id",
        F.col("slot").alias("seq"),
        F.lit("message").alias("kind"),
        F.col("slot").alias("turn"),
        "role",
        "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """Final turns ``conv_id, turn, role, text`` of every conversation after replaying its events."""
    kind = F.lower(F.col("kind"))
    reset_seq = F.when(kind.isin(*RESETS), F.col("seq"))
    message_seq = F.when(kind == "message", F.col("seq"))
    per_turn = events.groupBy("conv_id", "turn").agg(
        F.max(reset_seq).alias("reset_seq"),
        F.max_by(F.coalesce(F.col("text"), F.lit("")), reset_seq).alias("reset_text"),
        F.max_by(F.col("role"), message_seq).alias("role"),
        F.coalesce(F.max(message_seq), F.min("seq")).alias("birth"),
        F.max(F.when(kind.isin(*CUTS), F.col("seq"))).alias("cut"),
        F.collect_list(F.when(kind == "delta", F.struct("seq", F.coalesce(F.col("text"), F.lit("")).alias("text")))).alias(
            "deltas"
        ),
    )
    after_reset = F.filter(
        F.array_sort("deltas"), lambda d: F.col("reset_seq").isNull() | (d["seq"] > F.col("reset_seq"))
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_turn.withColumn("__cut_before", F.max("cut").over(earlier))
        .where(F.col("__cut_before").isNull() | (F.col("__cut_before") < F.col("birth")))
        .select(
            "conv_id",
            "turn",
            "role",
            F.concat(F.coalesce("reset_text", F.lit("")), F.array_join(F.transform(after_reset, lambda d: d["text"]), "")).alias(
                "text"
            ),
        )
    )


def render(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans`` (0-based [start, end) in code points)."""
    head = F.concat(F.lit(HEADER), escape_role(F.col("role")), F.lit(ROLE_END))
    body = escape_text(F.col("text"))
    seg = turns.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit(TURN_END)).alias("seg"),
        F.char_length(head).alias("hlen"),
        F.char_length(body).alias("tlen"),
        (F.coalesce(F.col("role"), F.lit("")) == LOSS_ROLE).alias("loss"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("offset", F.coalesce(F.sum(F.char_length("seg")).over(before), F.lit(0)).cast("long"))
    span = F.when(
        F.col("loss"),
        F.struct((F.col("offset") + F.col("hlen")).alias("start"), (F.col("offset") + F.col("hlen") + F.col("tlen")).alias("end")),
    )
    grouped = seg.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "seg"))).alias("segs"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
    )
    return grouped.select(
        "conv_id",
        F.size("segs").cast("long").alias("n_turns"),
        F.array_join(F.transform("segs", lambda s: s["seg"]), "").alias("formatted"),
        "loss_spans",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse written conversations: ``conv_id, turns`` (role, text unescaped), ``loss_text``, ``formatted``."""
    pieces = F.split(F.col("formatted"), TURN_END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, _PARSE, 1)).alias("role"), unescape(F.regexp_extract(p, _PARSE, 2)).alias("text")
        ),
    )
    loss = F.array_join(
        F.transform(
            "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
        ),
        "",
    )
    return formatted.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), "formatted")


def digests(parsed: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of parsed conversations."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
