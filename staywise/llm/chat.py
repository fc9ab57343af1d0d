"""Chat formatting from event logs, by built-in functions only.

A log row is (conv_id, seq, message, kind, role, text). Logs are partitioned by conversation and folded in order of ``seq``:

* ``message``, ``delta``: the text is appended to the message;
* ``edit``: everything the message and later messages had so far goes, the message starts again with this text;
* ``regenerate``: the same without a text; the deltas that follow are the new answer.

So an event lives exactly if no edit or regeneration of its own or an earlier message comes after it, which is one running maximum per
conversation. All windows and groups share the partitioning by conversation: the log is shuffled once, nothing is folded in Python.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles each ``<`` that pipes follow gets one more pipe, so
no text can hold a control string, and dropping one pipe restores it. Line ends in roles become ``<|n|>``. The loss mask lists
[start, end) code point spans of the assistant texts in the rendered string.

Edge cases: null texts and roles are empty; rows without a conversation id form one conversation; ties in ``seq`` are taken in order of
role and text; a message whose events are all replaced vanishes; a conversation without messages has no row; other columns are ignored. A
conversation is rendered as one string, so it must fit one row; its events are reduced to messages before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LOG = ("conv_id", "seq", "message", "kind", "role", "text")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\|+)", r"<|$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\|(\|+)", r"<$1")


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): one ``message`` event a row."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("seq"),
        F.row_number().over(order).cast("long").alias("message"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


def fold(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of the final messages."""
    so_far = Window.partitionBy("conv_id").orderBy("message")
    resets = F.col("kind").isin("edit", "regenerate")
    alive = (
        log.select(*LOG)
        .withColumn("cut", F.max(F.when(resets, F.col("seq"))).over(so_far))
        .where("cut is null or seq >= cut")
    )
    event = F.struct("seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        alive.groupBy("conv_id", "message")
        .agg(F.sort_array(F.collect_list(event)).alias("events"), F.max(~resets).alias("spoken"), F.max("kind").alias("kind"))
        .where("spoken or kind <> 'regenerate'")
        .select(
            "conv_id",
            "message",
            F.coalesce(F.get(F.filter("events", lambda e: e["role"] != ""), F.lit(0))["role"], F.lit("")).alias("role"),
            F.array_join(F.transform("events", lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) of folded messages."""
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("<|n|>"))
    parts = messages.select(
        "conv_id",
        "message",
        (F.col("role") == "assistant").alias("learned"),
        F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body"),
    ).withColumn("size", F.length("head") + F.length("body") + len(END))
    before = F.sum("size").over(Window.partitionBy("conv_id").orderBy("message")) - F.col("size")
    placed = parts.withColumn("start", before + F.length("head")).select(
        "conv_id",
        F.struct(
            "message",
            F.concat("head", "body", F.lit(END)).alias("piece"),
            F.when(F.col("learned"), F.struct("start", (F.col("start") + F.length("body")).alias("end"))).alias("span"),
        ).alias("m"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("ms", lambda m: m["piece"]), "").alias("formatted"),
        F.array_compact(F.transform("ms", lambda m: m["span"])).alias("mask"),
    )


def format_chats(log: DataFrame) -> DataFrame:
    return render(fold(log))


def turns_of(formatted: Column) -> Column:
    """The (role, text) array that a rendered string holds."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = unescaped(F.replace(F.substr(head, F.lit(len(START) + 1)), F.lit("<|n|>"), F.lit("\n")))
        text = unescaped(F.substr(piece, F.length(head) + 2))
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    spans = F.transform(
        mask, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(spans, "")


def digests(rendered: DataFrame) -> DataFrame:
    """What the rendered strings hold, read back from them."""
    read = rendered.select(
        "conv_id",
        turns_of(F.col("formatted")).alias("turns"),
        learned_text(F.col("formatted"), F.col("mask")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
