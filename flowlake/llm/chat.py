"""Chat formatting with typed content parts.

A turn is an array of parts (type, text, ref, width, height, seconds, pages). A visitor, one case per
type, flattens the parts of a conversation into one string: texts with control strings escaped, and a
numbered placeholder for every image, audio and document part, whose reference, place and expanded
token count go to a list of attachments. The mask lists the spans of assistant texts. Escaping is
reversible: a backslash is doubled, ``<|`` becomes ``<\\|``, also where a text ends in ``<`` and the next one
begins with ``|``, and in roles a line end becomes ``<\\!``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that a part stands for: one per image tile of 28 x 28, 25 a second of sound, 256 a page.
TILE, PER_SECOND, PER_PAGE = 28, 25, 256


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\!"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\!"), F.lit("\n")))


def text_part(text: Column) -> Column:
    """A plain text as a turn's array of parts."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    )


def expanded_tokens(part: Column) -> Column:
    """Tokens that a part other than text expands to; missing sizes count as none, at least one token."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(0)) / TILE) * F.ceil(F.coalesce(part["height"], F.lit(0)) / TILE)
    return (
        F.when(part["type"] == "image", F.greatest(tiles, F.lit(1)))
        .when(part["type"] == "audio", F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND), F.lit(1)))
        .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(0)).cast("long") * PER_PAGE, F.lit(1)))
        .otherwise(F.lit(0))
        .cast("long")
    )


MEDIA = ("image", "audio", "document")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: conv, formatted, n_turns, loss_spans, attachments, expanded_tokens.

    ``turns`` has one row per turn, with ``parts`` of type array of PART. Turns are ordered by ``turn``,
    null first, ties by role and parts; repeated rows are repeated turns. A null role or text is empty, a
    null or empty array is a turn without text, null conversations form one. A part of another type than
    text, image, audio or document is taken as text. loss_spans are (start, length) in code points of
    the assistants' escaped text parts, empty ones left out (together they unescape to the texts); attachments are (number, type, ref,
    turn_index, start, tokens), numbered per conversation in order of appearance, with the place of the
    placeholder. Other columns are ignored. An empty table gives no row. Texts are
    whole however long; a conversation is one row, so its formatted text has to fit one.
    """
    slim = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "parts")
    numbered = slim.withColumn("t", F.row_number().over(order))  # before the turns become pieces
    visited = numbered.select("conv", "t", "role", F.posexplode(_pieces()).alias("p", "piece"))
    along = Window.partitionBy("conv").orderBy("t", "p").rowsBetween(Window.unboundedPreceding, 0)
    media = F.col("piece.kind").isin(*MEDIA)
    counted = visited.withColumn("number", F.sum(media.cast("int")).over(along))
    named = counted.withColumn(
        "plain", F.when(media, F.concat(F.lit("<|"), F.col("piece.kind"), F.lit("_"), F.col("number"), F.lit("|>"))).otherwise(F.col("piece.text"))
    )
    # Two texts side by side must not make a control string.
    before = Window.partitionBy("conv").orderBy("t", "p").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.last(F.when(F.length("plain") > 0, F.right("plain", F.lit(1))), ignorenulls=True).over(before)
    joins = (F.col("piece.kind") == "text") & F.startswith("plain", F.lit("|")) & F.coalesce(ends == "<", F.lit(False))
    named = named.withColumn("out", F.when(joins, F.concat(F.lit("\\"), F.col("plain"))).otherwise(F.col("plain")))
    placed = named.withColumn("length", F.length("out")).withColumn("start", F.sum("length").over(along) - F.col("length"))
    spoken = (F.col("role") == "assistant") & (F.col("piece.kind") == "text") & (F.col("length") > 0)
    attached = F.struct(
        "number", F.col("piece.kind").alias("type"), F.col("piece.ref").alias("ref"), (F.col("t") - 1).alias("turn_index"),
        "start", F.col("piece.tokens").alias("tokens"),
    )
    return placed.groupBy("conv").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "p", "out"))), lambda x: x["out"]), "").alias("formatted"),
        F.max("t").cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.when(spoken, F.struct("start", "length")))).alias("loss_spans"),
        F.array_sort(F.collect_list(F.when(media, attached))).alias("attachments"),
        F.sum("piece.tokens").alias("expanded_tokens"),
    ).withColumnRenamed("conv", conv)


def _pieces() -> Column:
    """What the visitor makes of a turn: its head, one piece per part, its end."""

    def piece(text, kind, ref=None, tokens=None):
        return F.struct(
            text.alias("text"), kind.alias("kind"), (F.lit(None).cast("string") if ref is None else ref).alias("ref"),
            (F.lit(0).cast("long") if tokens is None else tokens).alias("tokens"),
        )

    def visit(part):
        media = F.coalesce(part["type"].isin(*MEDIA), F.lit(False))
        text = F.when(media, F.lit("")).otherwise(escaped(F.coalesce(part["text"], F.lit(""))))
        return piece(text, F.when(media, part["type"]).otherwise(F.lit("text")), F.when(media, part["ref"]), expanded_tokens(part))

    head = piece(F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")), F.lit("head"))
    return F.concat(F.array(head), F.transform("parts", visit), F.array(piece(F.lit(END), F.lit("tail"))))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation, unescaped; placeholders stay in the text."""
    cut = F.split(formatted, r"\Q<|im_start|>\E", -1)

    def turn(segment):
        body = F.substring(segment, F.lit(1), F.length(segment) - len(END))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0))), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, in order, with nothing between."""
    cut = F.transform(spans, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))
    return unescaped(F.array_join(cut, ""))
