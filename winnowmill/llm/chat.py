"""Chat formatting with typed content parts, in DataFrame functions only.

A conversation is rows of turns. A turn's content is an array of parts
``struct<type, text, ref, width, height, seconds, pages>`` of type text, image, audio or document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, let, packed, unpacked

START, END = "<|im_start|>", "<|im_end|>"
#: Placeholders of attachments, and how many tokens each stands for.
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PATCH_PIXELS = 28
AUDIO_TOKENS_PER_SECOND = 25
PAGE_TOKENS = 512
PART = (
    "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
)


def text_part(text: Column) -> Column:
    """An array of one text part."""
    nothing = [F.lit(None).cast(t).alias(n) for n, t in
               (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *nothing))


def escape(text: Column) -> Column:
    r"""Text in which no control string begins: ``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|`` and so on."""
    return F.when(F.contains(text, F.lit("|")), F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")).otherwise(text)


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.when(F.contains(text, F.lit("|")), F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")).otherwise(text)


def _escape_role(role: Column) -> Column:
    """A role on one line."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def part_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; 1 where its measures are missing, 0 for text."""
    patches = F.ceil(part["width"] / PATCH_PIXELS) * F.ceil(part["height"] / PATCH_PIXELS)
    audio = F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND)
    count = (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", audio)
        .when(part["type"] == "document", part["pages"] * PAGE_TOKENS)
    )
    kinds = part["type"].isin(*PLACEHOLDERS)
    return F.when(kinds, F.greatest(F.coalesce(count, F.lit(1)), F.lit(1))).otherwise(0).cast("bigint")


def _flat(part: Column) -> Column:
    """What a part becomes in the formatted text. Unknown types are texts, null texts are empty."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind, placeholder in PLACEHOLDERS.items():
        out = F.when(part["type"] == kind, F.lit(placeholder)).otherwise(out)
    return out


def format_turns(
    turns: DataFrame, role_col: str = "role", content_col: str = "content", loss_role: str = "assistant"
) -> DataFrame:
    """All columns of ``turns`` plus ``formatted, loss_start, loss_chars, attachments, expanded_tokens``.

    ``formatted`` is START, the role, a line break, the parts in order, END and a line break. Text parts
    are escaped so that no control string begins in them, attachments become placeholders;
    ``attachments`` lists (index, type, ref, position in ``formatted``, tokens) and ``expanded_tokens``
    sums their tokens. The loss mask covers the content of turns of ``loss_role``: ``loss_chars`` code
    points from ``loss_start`` (0-based), else no code points.

    A null role is empty, null content has no parts. Rows are formatted one by one, without a shuffle,
    so the length of a conversation does not matter. Columns of any other name stay, those that are called
    like an output column are replaced; repeated rows are formatted each. No rows give none.
    """
    outputs = ("formatted", "loss_start", "loss_chars", "attachments", "expanded_tokens")
    kept = [c for c in turns.columns if c.lower() not in outputs]
    parts = F.coalesce(col(content_col), F.array().cast(f"array<{PART}>"))
    head = F.concat(F.lit(START), _escape_role(F.coalesce(col(role_col), F.lit(""))), F.lit("\n"))
    flat = F.transform(parts, _flat)
    learns = F.coalesce(col(role_col) == loss_role, F.lit(False))
    rows = turns.select(packed(turns, kept), head.alias("__head"), flat.alias("__flat"), parts.alias("__parts"), learns.alias("__learned"))
    body = F.array_join("__flat", "")
    length = F.length("__head")

    def attachments(ends: Column) -> Column:
        listed = F.transform(
            F.col("__parts"),
            lambda p, i: F.struct(
                i.alias("index"), p["type"].alias("type"), p["ref"].alias("ref"),
                F.when(i == 0, length).otherwise(length + F.get(ends, i - 1)).cast("bigint").alias("position"),
                part_tokens(p).alias("tokens"),
            ),
        )
        return F.filter(listed, lambda a: a["tokens"] > 0)

    # Running lengths of the flattened parts, in one pass.
    ends = F.aggregate(
        "__flat",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s)).alias("at"), F.array_append(a["ends"], a["at"] + F.length(s)).alias("ends")
        ),
        lambda a: a["ends"],
    )
    only_text = F.forall("__parts", lambda p: ~F.coalesce(p["type"].isin(*PLACEHOLDERS), F.lit(False)))
    nothing = F.array().cast("array<struct<index: int, type: string, ref: string, position: bigint, tokens: bigint>>")
    learned = F.col("__learned")
    return rows.select(
        *unpacked(kept),
        F.concat("__head", body, F.lit(f"{END}\n")).alias("formatted"),
        F.when(learned, length).otherwise(0).cast("bigint").alias("loss_start"),
        F.when(learned, F.length(body)).otherwise(0).cast("bigint").alias("loss_chars"),
        F.when(only_text, nothing).otherwise(let(ends, attachments)).alias("attachments"),
        F.aggregate("__parts", F.lit(0).cast("bigint"), lambda a, p: a + part_tokens(p)).alias("expanded_tokens"),
    )


def read_turn(formatted: Column) -> tuple[Column, Column]:
    """Role and text of a formatted turn; attachments read as their placeholders."""
    inner = F.substr(formatted, F.lit(len(START) + 1), F.length(formatted) - F.lit(len(START) + len(END) + 1))
    at = F.locate("\n", inner)
    return _unescape_role(F.substr(inner, F.lit(1), at - 1)), unescape(F.substr(inner, at + 1))


def read_loss(formatted: Column, start: Column, chars: Column) -> Column:
    """The text under a turn's loss mask."""
    return unescape(F.substr(formatted, start.cast("int") + 1, chars.cast("int")))
