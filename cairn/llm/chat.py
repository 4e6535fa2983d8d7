"""Chat formatting: a visitor over typed content parts, and a template with reversible escapes and a loss mask.

Only DataFrame functions. A turn is ``(conv_id, turn, role, parts)``; a part is a struct of ``PART_TYPE``. ``flatten_parts``
visits the parts in order: text is escaped and kept, every other part becomes an ordered placeholder, and its reference
is recorded with the tokens it expands to. ``format_chats`` joins the turns of a conversation:

    <|turn|>role<|text|>content<|end|>      (once per turn)

``\\`` and every control string inside roles and texts are escaped by a backslash (``ESCAPES``), so no text can open or
close a turn, and unescaping gives the text back. ``loss_spans`` holds the code point spans of the assistants' contents.

Defined results: null role or text is empty; null ``turn`` comes first; equal turn numbers are ordered by role and text
(repeated rows stay, as turns of their own); a null ``conv_id`` is a conversation; a null part or part type gives
nothing; sizes that are null or negative count as zero. A conversation is one output row, hence held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_TYPE = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: what is written for each control string; the backslash itself comes first
ESCAPES = (("\\", "\\\\"), ("<|", "<\\|"), ("</s>", "<\\/s>"), ("<s>", "<\\s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]"))
LOSS_ROLE = "assistant"
#: tokens of an attachment: an image per started square of pixels, audio per started second, a document per page
PIXELS, AUDIO_RATE, PAGE_TOKENS = 28, 25, 640


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _size(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def expanded_tokens(part: Column) -> Column:
    """Tokens that a non-text part stands for."""
    squares = F.ceil(_size(part["width"]) / PIXELS) * F.ceil(_size(part["height"]) / PIXELS)
    return (F.when(part["type"] == "image", squares)
            .when(part["type"] == "audio", F.ceil(_size(part["seconds"])) * AUDIO_RATE)
            .when(part["type"] == "document", _size(part["pages"]) * PAGE_TOKENS)
            .otherwise(0).cast("long"))


def visit(part: Column, written: bool = True) -> Column:
    """What a part writes: its escaped text (as it is unless ``written``), or the placeholder of its type."""
    text = F.coalesce(part["text"], F.lit(""))
    return (F.when(part["type"] == "text", escape(text) if written else text)
            .when(part["type"].isin("image", "audio", "document"), F.concat(F.lit("<|"), part["type"], F.lit("|>")))
            .otherwise(F.lit("")))


def flatten_parts(parts: Column) -> tuple[Column, Column, Column]:
    """(content, attachments, plain content): attachments are ``(place, type, uri, tokens)`` in the order of their placeholders."""
    whole = F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>"))
    content, plain = (F.array_join(F.transform(whole, lambda p: visit(p, written)), "") for written in (True, False))  # noqa: B023
    others = F.filter(whole, lambda p: p["type"].isin("image", "audio", "document"))
    attachments = F.transform(others, lambda p, i: F.struct(
        i.alias("place"), p["type"].alias("type"), p["uri"].alias("uri"), expanded_tokens(p).alias("tokens")))
    return content, attachments, plain


def text_part(text: Column) -> Column:
    """A content of one text part."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), null("string").alias("uri"), null("int").alias("width"),
        null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages")))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, formatted, loss_spans, attachments, media_tokens`` from ``conv_id, turn, role, parts``."""
    content, attachments, plain = flatten_parts(F.col("parts"))
    spoken = F.coalesce(F.col("role"), F.lit(""))
    role = escape(spoken)
    pieces = turns.select(
        "conv_id", "turn", (spoken == LOSS_ROLE).alias("_loss"), spoken.alias("_role"), plain.alias("_plain"),
        content.alias("_content"), attachments.alias("_attached"),
        F.concat(F.lit(TURN), role, F.lit(TEXT), content, F.lit(END)).alias("_piece"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "_role", "_plain")
    placed = pieces.select(
        "conv_id", "_piece", "_loss", "_attached", F.char_length("_content").alias("_length"), F.row_number().over(order).alias("_at"),
        (F.sum(F.char_length("_piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
         - F.char_length("_content") - len(END)).alias("_start"))
    rows = F.sort_array(F.collect_list(F.struct("_at", "_piece", "_loss", "_start", "_length", "_attached")))
    spans = F.transform(F.filter("_rows", lambda r: r["_loss"]), lambda r: F.struct(
        r["_start"].alias("start"), r["_length"].cast("long").alias("length")))
    attached = F.flatten(F.transform("_rows", lambda r: F.transform(r["_attached"], lambda a: F.struct(
        (r["_at"] - 1).alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["uri"].alias("uri"), a["tokens"].alias("tokens")))))
    return (placed.groupBy("conv_id").agg(rows.alias("_rows")).select(
        "conv_id", F.size("_rows").cast("long").alias("n_turns"),
        F.array_join(F.transform("_rows", lambda r: r["_piece"]), "").alias("formatted"),
        spans.alias("loss_spans"), attached.alias("attachments"))
        .withColumn("media_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])))


def parse_chat(formatted: Column) -> Column:
    """The turns read back from a formatted conversation: array of ``(role, text)``; placeholders stay as written."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)

    def back(piece: Column) -> Column:
        halves = F.split(piece, r"<\|text\|>")
        content = F.get(halves, F.lit(1))
        return F.struct(unescape(F.get(halves, F.lit(0))).alias("role"),
                        unescape(F.left(content, F.char_length(content) - len(END))).alias("text"))

    return F.transform(pieces, back)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
