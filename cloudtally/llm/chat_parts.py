r"""Chat formatting of messages whose content is a list of typed parts.

*Visitor.* A message's parts (``type``, ``text``, ``ref``, ``width``, ``height``, ``seconds``, ``pages``) are visited
in order. A text part gives its text; an image, audio or document part gives the placeholder ``<|image:1|>``, numbered
within its message, and a row in ``attachments`` with its place, reference and the tokens it will expand to: patches of
``PATCH`` pixels, ``AUDIO_RATE`` tokens a second, ``PAGE_TOKENS`` a page (one at least). Parts of another type give
nothing. ``n_expanded`` adds the tokens up.

*Template.* A turn is written as ``<|turn|>``, role, line end, text, ``<|end|>``, line end. In roles, and in texts between
two placeholders (text parts that follow each other are joined first), a backslash is doubled, and one is put after the
first character of each control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), and before a line end of a
role. So control strings in what people wrote are never read as
control, and taking one backslash away from each escaped character gives the same text back.

*Loss mask.* ``loss_begin`` and ``loss_end`` are code point offsets in the formatted turn; for an assistant's turn they
hold its text, for others nothing.

The output has one row per turn; a conversation is its turns in order, and only its digests bring them together. That
order is by turn number (null first), then role, then text, so repeated turns have a place. Null roles and texts are
empty; a null conversation id is one conversation. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 14
AUDIO_RATE = 25
PAGE_TOKENS = 800
TURN, END = "<|turn|>", "<|end|>\n"


def _escaped(text: Column) -> Column:
    text = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(text, r"(<(?=\||/?s>)|\[(?=/?INST\]))", r"$1\\")


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _tokens(part: Column) -> Column:
    """Tokens that an attachment expands to."""

    def patches(size: Column) -> Column:
        return F.ceil(F.coalesce(size, F.lit(PATCH)) / PATCH)

    image = patches(part["width"]) * patches(part["height"])
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE)
    document = F.coalesce(part["pages"], F.lit(1)) * PAGE_TOKENS
    kind = part["type"]
    expanded = F.when(kind == "image", image).when(kind == "audio", audio).otherwise(document)
    return F.greatest(expanded.cast("long"), F.lit(1).cast("long"))


def visited(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``content`` (escaped, with placeholders), ``attachments``, ``n_expanded``."""
    listed = F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>"))
    listed = F.filter(listed, lambda p: p["type"].isin("text", "image", "audio", "document"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), listed.alias("_parts"))
    attached = F.filter("_parts", lambda p: p["type"] != "text")
    rows = rows.withColumn("attachments", F.transform(attached, lambda p, i: F.struct(
        (i + 1).alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("n_tokens"))))

    # What stands before, between and after the placeholders: one text each, however many parts it came in.
    def visit(texts: Column, part: Column) -> Column:
        more = F.concat(F.element_at(texts, -1), F.coalesce(part["text"], F.lit("")))
        joined = F.concat(F.slice(texts, 1, F.size(texts) - 1), F.array(more))
        return F.when(part["type"] == "text", joined).otherwise(F.concat(texts, F.array(F.lit(""))))

    texts = F.aggregate("_parts", F.array(F.lit("")).cast("array<string>"), visit)
    rows = rows.withColumn("_texts", F.transform(texts, _escaped))
    marks = F.transform("attachments", lambda a: F.concat(
        F.lit("<|"), a["type"], F.lit(":"), a["place"].cast("string"), F.lit("|>")))
    flat = F.array_join(F.zip_with("_texts", marks, lambda text, m: F.concat(text, F.coalesce(m, F.lit("")))), "")
    expanded = F.aggregate("attachments", F.lit(0).cast("long"), lambda total, a: total + a["n_tokens"])
    return rows.select("conv_id", "turn", "role", flat.alias("content"), "attachments", expanded.alias("n_expanded"))


def formatted(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``formatted``, ``loss_begin``, ``loss_end``, attachments."""
    rows = visited(messages, parts)
    role = F.regexp_replace(_escaped(F.col("role")), "\n", "\\\\\n")
    rows = rows.withColumn("_head", F.concat(F.lit(TURN), role, F.lit("\n")))
    begin = F.length("_head")
    return rows.select(
        "conv_id",
        "turn",
        F.concat("_head", "content", F.lit(END)).alias("formatted"),
        begin.alias("loss_begin"),
        (begin + F.when(F.col("role") == "assistant", F.length("content")).otherwise(0)).alias("loss_end"),
        "attachments",
        "n_expanded",
    )


def text_messages(rows: DataFrame) -> DataFrame:
    """Messages of one text part each, from rows with ``conv_id``, ``turn``, ``role``, ``text``."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("type"), F.col("text"), *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()]
    )
    return rows.select("conv_id", "turn", "role", F.array(part.cast(PART)).alias("parts"))


def parsed(turns: DataFrame) -> DataFrame:
    """What formatted turns say: ``role`` and ``text`` from the template, ``loss_text`` from the mask, all unescaped."""
    head = r"(?s)^<\|turn\|>((?:[^\\\n]|\\.)*)\n"
    role = F.regexp_extract("formatted", head, 1)
    begin, around = len(TURN) + 2, len(TURN) + 1 + len(END)
    content = F.expr(f"substring(formatted, {begin} + length(_role), length(formatted) - length(_role) - {around})")
    masked = F.expr("substring(formatted, loss_begin + 1, loss_end - loss_begin)")
    rows = turns.withColumn("_role", role)
    return rows.select(
        "conv_id",
        "turn",
        _unescaped(F.col("_role")).alias("role"),
        _unescaped(content).alias("text"),
        _unescaped(masked).alias("loss_text"),
        F.length("formatted").cast("long").alias("n_chars"),
    )


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted turns."""
    rows = parsed(turns).select("conv_id", F.struct("turn", "role", "text", "loss_text", "n_chars").alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("turns", lambda t: t["loss_text"]), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.length(t["loss_text"])).alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["n_chars"]).alias("formatted_chars"),
    )
