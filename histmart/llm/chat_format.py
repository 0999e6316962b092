"""Chat formatting (operator 9): event-sourced conversations, folded and rendered with native functions only.

A log row is ``(conv_id, mid, seq, kind, role, text)``: ``mid`` orders the
messages of a conversation, ``seq`` orders the events. Kinds:

* ``message``: the whole text of a message; restarts it if it already has one;
* ``delta``: a streamed piece, appended;
* ``edit``: new whole text; drops what later messages said before it;
* ``regenerate``: discards the text so far (its own text, if any, starts the
  new one); drops what later messages said before it.

``fold`` gives the surviving messages, ``render`` one text per conversation
with its loss segments, ``read_back`` parses rendered text again. The log is
dealt once, by conversation; a conversation ends as one text, so one task
holds it by nature.

Template: ``<|turn|>role\\ntext<|end|>\\n`` per turn. Inside roles and texts a
backslash is doubled and one is put after the first character of any control
string, so none survives; unescaping drops each escaping backslash.

Defined cases: null text and null role are empty; a null conversation id is a
conversation of its own; null ``mid`` or ``seq`` sort first; events that tie
on ``seq`` go by kind (delta last) and text; repeated ``message`` rows under
one ``mid`` leave one message, while ``as_events`` numbers the rows of a table
of turns, so there each row is a turn; extra columns are ignored; an empty log
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template's own marks, and marks of widespread templates that tokenizers treat as control tokens.
TURN, END = "<|turn|>", "<|end|>"
CONTROL = r"([<\[])(?=\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"(?s)\\(.)"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), CONTROL, r"$1\\")


def escape_role(c: Column) -> Column:
    return F.regexp_replace(escape(c), "\n", "\\\\\n")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1")


def as_events(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """A table of whole turns as a log: one ``message`` event per row, ties ordered by role and text."""
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return t.select("conv_id", place.alias("mid"), place.alias("seq"), F.lit("message").alias("kind"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Surviving messages: ``conv_id, mid, role, text``."""
    by_conv = Window.partitionBy("conv_id").orderBy("mid")
    rewrite = F.col("kind").isin("edit", "regenerate")
    e = events.select("conv_id", "mid", F.coalesce("seq", F.lit(-(2 ** 63)).cast("long")).alias("seq"), "kind", "role",
                      F.coalesce("text", F.lit("")).alias("text"),
                      (F.col("kind") == "delta").cast("int").alias("late"))
    messages = e.repartition("conv_id").groupBy("conv_id", "mid").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.max(F.when(F.col("kind") != "delta", F.struct("seq", "late", "kind", "text"))).alias("reset"),
        F.max(F.when(rewrite, F.col("seq"))).alias("rewritten"),
        F.sort_array(F.collect_list(F.struct("seq", "late", "kind", "text"))).alias("parts"))
    before = F.max("rewritten").over(by_conv.rowsBetween(Window.unboundedPreceding, -1))
    kept = F.filter("parts", lambda p: (F.col("reset").isNull() | (p >= F.col("reset")))
                    & (F.col("cut").isNull() | (p["seq"] > F.col("cut"))))
    return (messages.withColumn("cut", before).withColumn("live", kept).where(F.size("live") > 0)
            .select("conv_id", "mid", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform("live", lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments``: segments are the pieces of ``formatted`` in order, each with its loss flag."""
    turn = F.struct(
        "mid",
        F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == ASSISTANT).alias("loss"))
    rows = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    tail = F.lit(END + "\n")
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
        F.struct(tail.alias("text"), F.lit(False).alias("loss")))))
    return (rows.select("conv_id", segments.alias("segments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"))


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, turns, loss``: roles and texts parsed from ``formatted``, and the text under the loss mask."""
    pieces = F.split("formatted", r"<\|turn\|>")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces) - 1)  # nothing stands before the first mark
    parsed = F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)\A((?:[^\\\n]|\\.)*+)\n", 1)).alias("role"),
        unescape(F.regexp_replace(F.regexp_replace(p, r"(?s)\A(?:[^\\\n]|\\.)*+\n", ""), r"<\|end\|>\n\z", "")).alias("text")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return rendered.select("conv_id", parsed.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_back`` found."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")
