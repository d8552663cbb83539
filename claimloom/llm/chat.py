"""Chat formatting with typed content parts (DataFrame functions only).

A message is a list of parts: text, image, audio or document. Parts are visited in order; text is escaped, every other
part becomes a placeholder that stands for as many tokens as the part expands to, and its reference is recorded.

Template of a turn: ``<|start|>ROLE<|text|>TEXT<|end|>`` and a line feed. Control strings inside roles and texts are
escaped reversibly: ``~`` becomes ``~0`` and the i-th control string ``~i``, so none is left and :func:`unescape` gives
the original back. The loss mask is the escaped text of the assistant's turns, as code point ranges.

Defined results: a null text or role is an empty one; null turns come first; rows of equal turn are ordered by role and
text, repeated rows stay; a null conversation id is a conversation of its own; parts of an unknown or null type have no
output; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
"""Escaped inside texts, as ``~1``, ``~2``, ... The first covers all strings of our own template."""

IMAGE_PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("~"), F.lit("~0"))
    for i, control in enumerate(CONTROL, 1):
        out = F.replace(out, F.lit(control), F.lit(f"~{i}"))
    return out


def unescape(text: Column) -> Column:
    for i, control in enumerate(CONTROL, 1):
        text = F.replace(text, F.lit(f"~{i}"), F.lit(control))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def expanded_tokens(part: Column) -> Column:
    """How many tokens a non-text part stands for; missing measures count as 0, any known part as 1 at least."""
    patches = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    n = (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", part["pages"] * DOCUMENT_TOKENS_PER_PAGE)
    )
    return F.greatest(F.lit(1), F.coalesce(n.cast("long"), F.lit(0))).cast("long")


def visit(parts: Column) -> Column:
    """The parts that have output, in order: struct<piece, kind, ref, tokens>."""
    known = F.filter(parts, lambda p: F.coalesce(p["type"].isin("text", "image", "audio", "document"), F.lit(False)))
    return F.transform(
        known,
        lambda p: F.struct(
            F.when(p["type"] == "text", escape(p["text"]))
            .otherwise(F.concat(F.lit("<|"), p["type"], F.lit("|>")))
            .alias("piece"),
            p["type"].alias("kind"),
            p["ref"].alias("ref"),
            F.when(p["type"] == "text", F.lit(0).cast("long")).otherwise(expanded_tokens(p)).alias("tokens"),
        ),
    )


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a message."""
    nothing = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            nothing.cast("string").alias("ref"),
            nothing.cast("int").alias("width"),
            nothing.cast("int").alias("height"),
            nothing.cast("double").alias("seconds"),
            nothing.cast("int").alias("pages"),
        )
    ).cast(PARTS)


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, loss, attachments, n_placeholder_tokens.

    ``messages`` has conv_id, turn, role and either ``parts`` or ``text``. ``loss``: array<struct<start, length>> in
    code points of ``formatted``, one entry per assistant turn. ``attachments``: array<struct<turn_no, part_no, kind,
    ref, tokens>> in order of their placeholders; turn_no counts turns of the conversation from 0.
    """
    parts = F.col("parts") if "parts" in messages.columns else text_parts(F.col("text"))
    visited = messages.select("conv_id", "turn", "role", visit(parts).alias("__parts"))
    pieces = visited.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(START), escape(F.col("role")), F.lit(TEXT)).alias("head"),
        F.coalesce(F.array_join(F.transform("__parts", lambda p: p["piece"]), ""), F.lit("")).alias("body"),
        "__parts",
    )
    turn = F.concat("head", "body", F.lit(END + "\n"))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumns(
        {
            "no": F.row_number().over(in_order) - 1,
            "at": F.coalesce(F.sum(F.length(turn)).over(before), F.lit(0)),
            "formatted": turn,
        }
    )
    span = F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    attached = F.filter(
        F.transform(
            "__parts",
            lambda p, i: F.struct(
                F.col("no").alias("turn_no"), i.alias("part_no"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                p["tokens"].alias("tokens"),
            ),
        ),
        lambda a: a["kind"] != "text",
    )
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("no", "formatted"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss"),
        F.array_sort(F.flatten(F.collect_list(attached))).alias("attachments"),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("formatted"),
        "loss",
        "attachments",
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("n_placeholder_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text-only conversation: array<struct<role, text>>."""
    turns = F.filter(F.split(formatted, r"<\|start\|>", -1), lambda t: t != "")
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring_index(t, TEXT, 1)).alias("role"),
            unescape(F.substring_index(F.substring_index(t, TEXT, -1), END, 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))),
        "",
    )


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    read = formatted.select(
        "conv_id",
        "formatted",
        read_back(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
