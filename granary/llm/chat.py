"""Chat formatting from typed content parts.

A turn is a list of parts. Text parts become escaped text; image, audio and
document parts become one ordered placeholder each, and their references and
the number of tokens each placeholder expands to are recorded beside the text.

Template, per turn: ``<|turn|>`` role (URL-encoded) newline content ``<|end|>``
newline. Escaping: a backslash is doubled, and a control string gets a
backslash after its first character, so none is left whole inside a text.
Removing one backslash before each character restores the text exactly. A text
part that follows another one starts with ``<|part|>``, so no control string
can come together from two parts, and ``read_parts`` gives back every part: a
placeholder is one only where it is not escaped.

Edge cases: NULL text or role counts as empty, NULL parts are no parts, turns
with the same number are ordered by role, then content; a NULL turn comes
first. A part of a kind that has no placeholder raises. A conversation is put
together in one row, so it has to fit a task's memory; rows without a
conversation id form one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END, PART = "<|turn|>", "<|end|>", "<|part|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Tokens per unit of an attachment: image tile, second of audio, page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
CONTROL = r"(<|\[)(/?s>|/?INST\]|/?SYS\]|\|[A-Za-z_]{1,32}\|>)"
PART_TYPE = "array<struct<type:string,text:string,ref:string,units:int>>"
SLASH = "\\\\"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), SLASH, SLASH * 2)
    return F.regexp_replace(doubled, CONTROL, "$1" + SLASH + "$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            null.cast("string").alias("ref"),
            null.cast("int").alias("units"),
        )
    ).cast(PART_TYPE)


def is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(True))


def visit(part: Column, before: Column) -> Column:
    """What one part adds to the content behind another one (NULL for the first)."""
    unknown = F.raise_error(F.concat(F.lit("a part of no known kind: "), part["type"])).cast("string")
    border = F.when(is_text(before) & before.isNotNull(), F.lit(PART)).otherwise(F.lit(""))
    content = F.when(is_text(part), F.concat(border, escape(part["text"]))).otherwise(unknown)
    for kind, placeholder in PLACEHOLDERS.items():
        content = F.when(part["type"] == kind, F.lit(placeholder)).otherwise(content)
    return content


def expanded(part: Column) -> Column:
    """Tokens that an attachment's placeholder expands to; at least one unit each."""
    tokens = F.lit(0)
    for kind, cost in UNIT_TOKENS.items():
        units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))
        tokens = F.when(part["type"] == kind, units * cost).otherwise(tokens)
    return tokens.cast("long")


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))


def flatten(df: DataFrame, parts: str) -> DataFrame:
    """Add ``content`` and ``attachments`` (kind, ref, tokens, in placeholder order)."""
    listed = F.filter(F.coalesce(F.col(parts), F.array().cast(PART_TYPE)), lambda p: p.isNotNull())
    visited = F.transform(listed, lambda p, i: visit(p, F.get(listed, i - 1)))
    return df.withColumn("content", F.array_join(visited, "")).withColumn(
        "attachments",
        F.transform(
            F.filter(listed, is_attachment),
            lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), expanded(p).alias("tokens")),
        ),
    )


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: formatted text, loss mask and attachments.

    ``loss`` lists start and length (code points) of the content of turns whose
    role is in ``learn``. Offsets come from a running sum over the turns, and
    the texts cross the network once: window and grouping share the partitioning.
    """
    flat = flatten(
        turns.select(
            F.col(f"`{conversation}`").alias("_conv"),
            F.col(f"`{turn}`").alias("_turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("_role"),
            F.col(f"`{parts}`").cast(PART_TYPE).alias("_parts"),
        ),
        "_parts",
    )
    head = F.concat(F.lit(TURN), F.url_encode("_role"), F.lit("\n"))
    pieces = flat.select(
        "_conv",
        "_turn",
        "_role",
        "content",
        "attachments",
        F.concat(head, "content", F.lit(END + "\n")).alias("piece"),
        F.length(head).alias("head"),
        F.length("content").alias("chars"),
    )
    so_far = (
        Window.partitionBy("_conv")
        .orderBy("_turn", "_role", "content")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = pieces.withColumn("ends", F.sum(F.length("piece").cast("long")).over(so_far)).withColumn(
        "start", F.col("ends") - F.length("piece") + F.col("head")
    )
    kept = F.when(
        F.col("_role").isin(*learn), F.struct("start", F.col("chars").cast("long").alias("chars"))
    )
    grouped = placed.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("ends", "piece", "attachments"))).alias("turns"),
        F.sort_array(F.collect_list(kept)).alias("loss"),
    )
    return grouped.select(
        F.col("_conv").alias(conversation),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        "loss",
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as structs of role and text."""
    pieces = F.split(formatted, r"<\|end\|>\n")
    whole = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    bodies = F.transform(whole, lambda p: F.substring(p, len(TURN) + 1, 2147483647))
    return F.transform(
        bodies,
        lambda b: F.struct(
            F.url_decode(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.replace(F.substr(b, F.instr(b, "\n") + F.lit(1)), F.lit(PART), F.lit(""))).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = F.transform(
        loss, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int"))
    )
    return unescape(F.replace(F.array_join(parts, ""), F.lit(PART), F.lit("")))


def read_parts(formatted: Column, attachments: Column) -> Column:
    """The turns of a formatted text with their typed parts: role, and type, text, ref and tokens of each.

    Placeholders take their references from ``attachments`` in order. An empty
    text part next to a placeholder leaves nothing to read back.
    """
    pieces = F.split(formatted, r"<\|end\|>\n")
    whole = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    marks = "|".join([*PLACEHOLDERS, PART[2:-2]])
    kinds = {v: k for k, v in PLACEHOLDERS.items()}
    used = F.transform(
        whole, lambda p: F.regexp_count(p, F.lit("|".join(m.replace("|", r"\|") for m in PLACEHOLDERS.values())))
    )

    def turn(piece: Column, i: Column) -> Column:
        body = F.substring(piece, len(TURN) + 1, 2147483647)
        content = F.substr(body, F.instr(body, "\n") + F.lit(1))
        mark = rf"<\|(?:{marks})\|>"
        found = F.filter(F.split(content, f"(?={mark})|(?<={mark})"), lambda p: p != "")
        ahead = F.aggregate(F.slice(used, F.lit(1), i), F.lit(0), lambda a, n: a + n)

        def part(p: Column, k: Column) -> Column:
            own = F.size(F.filter(F.slice(found, F.lit(1), k + 1), lambda q: q.isin(*kinds)))
            kind = F.lit("text")
            for mark, name in kinds.items():
                kind = F.when(p == mark, F.lit(name)).otherwise(kind)
            there = F.when(p.isin(*kinds), F.get(attachments, ahead + own - 1))
            text = F.when(~p.isin(*kinds), unescape(p))
            return F.struct(kind.alias("type"), text.alias("text"), there["ref"].alias("ref"), there["tokens"].alias("tokens"))

        parts = F.filter(F.transform(found, lambda p, k: F.when(p != PART, part(p, k))), lambda p: p.isNotNull())
        return F.struct(F.url_decode(F.substring_index(body, "\n", 1)).alias("role"), parts.alias("parts"))

    return F.transform(whole, turn)
