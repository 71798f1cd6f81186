"""Chat formatting with typed content parts.

A visitor flattens the parts of a turn (text, image, audio, document) into one
string: text is escaped, every attachment becomes a placeholder and is recorded
with its reference and the number of tokens that it expands to.  Turns are
marked with control strings; no escaped text can contain their opening.  Texts
that follow each other are joined before they are escaped, so that no control
string comes about where two parts meet, and the formatted string reads back
exactly.  All of it is DataFrame operators.

Defined results: null texts, roles and parts are empty, an unknown part type is
text, a null turn sorts first, rows that share a turn are ordered by role and
content and repeated rows are kept.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
START = "<|im_start|>"
END = "<|im_end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PLACEHOLDER = r"<\|(image|audio|document)\|>"
LOSS_ROLE = "assistant"

#: Tokens that an attachment expands to.
PATCH_PIXELS = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256

PART_TYPE = (
    "array<struct<type:string,text:string,ref:string,"
    "width:int,height:int,seconds:double,pages:int>>"
)


def escape(text: Column) -> Column:
    """No ``<|`` is left; ``<~`` is doubled first, so that the step can be undone."""
    return F.replace(F.replace(text, F.lit("<~"), F.lit("<~~")), F.lit("<|"), F.lit("<~|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<~|"), F.lit("<|")), F.lit("<~~"), F.lit("<~"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<~n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<~n"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(list(PLACEHOLDERS)), F.lit(False))


def _visit(parts: Column) -> Column:
    """The parts of a turn as one string.

    The visitor carries what is flattened so far and the text since the last
    attachment; that text is escaped as a whole when an attachment or the end
    of the turn is met.
    """
    empty = F.lit("")
    start = F.struct(empty.alias("done"), empty.alias("said"))

    def meet(state: Column, part: Column) -> Column:
        mark = F.concat(F.lit("<|"), part["type"], F.lit("|>"))
        attached = _is_attachment(part)
        done = F.when(attached, F.concat(state["done"], escape(state["said"]), mark)).otherwise(state["done"])
        said = F.when(attached, empty).otherwise(F.concat(state["said"], F.coalesce(part["text"], empty)))
        return F.struct(done.alias("done"), said.alias("said"))

    return F.aggregate(parts, start, meet, lambda state: F.concat(state["done"], escape(state["said"])))


def _tokens(part: Column) -> Column:
    patches = F.ceil(part["width"] / PATCH_PIXELS) * F.ceil(part["height"] / PATCH_PIXELS)
    return F.coalesce(
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", part["pages"] * DOCUMENT_TOKENS_PER_PAGE)
        .cast("bigint"),
        F.lit(0).cast("bigint"),
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) to one row per conversation.

    ``formatted`` is the text; ``loss`` lists the spans that are trained on, by
    place of the turn, code points from the turn's mark, length, and code
    points from the start of the text; ``attachments`` lists type, reference
    and tokens in order of their placeholders.
    """
    role = _escape_role(F.coalesce("role", F.lit("")))
    no_parts = F.array().cast(PART_TYPE)
    pieces = (
        turns.select(
            "conv_id",
            "turn",
            role.alias("role"),
            F.coalesce(F.col("parts").cast(PART_TYPE), no_parts).alias("parts"),
        )
        .select(
            "conv_id",
            "turn",
            "role",
            _visit(F.col("parts")).alias("body"),
            F.transform(
                F.filter("parts", _is_attachment),
                lambda p: F.struct(
                    p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")
                ),
            ).alias("attachments"),
        )
        .withColumn("piece", F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(END)))
        .withColumn("head", F.length("role") + F.lit(len(START) + 1))
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("place", F.row_number().over(order)).withColumn(
        "start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0))
    )
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct("place", "start", "head", F.length("body").alias("chars"), "role", "piece", "attachments")
            )
        ).alias("turns")
    )
    trained = F.filter("turns", lambda t: t["role"] == LOSS_ROLE)
    return gathered.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            trained,
            lambda t: F.struct(
                t["place"].alias("place"),
                t["head"].alias("head"),
                t["chars"].alias("chars"),
                (t["start"] + t["head"]).alias("start"),
            ),
        ).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add what the formatted string says: ``read_turns`` (role, text, types) and ``read_loss`` (texts).

    Placeholders of attachments are part of the text they stand in; ``types``
    lists them in order, without those that a text merely spells.
    """
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 2147483647 - 2)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        body = F.substr(piece, at + F.lit(1), F.length(piece) - at - F.lit(len(END)))
        return F.struct(
            _unescape_role(F.substr(piece, F.lit(1), at - F.lit(1))).alias("role"),
            unescape(body).alias("text"),
            F.regexp_extract_all(body, F.lit(PLACEHOLDER), F.lit(1)).alias("types"),
        )

    def trained(span: Column) -> Column:
        piece = F.get(F.col("pieces"), span["place"] - F.lit(1))
        return unescape(F.substr(piece, span["head"] - F.lit(len(START) - 1), span["chars"]))

    return (
        formatted.withColumn("pieces", pieces)
        .withColumn("read_turns", F.transform("pieces", turn))
        .withColumn("read_loss", F.transform("loss", trained))
        .drop("pieces")
    )
