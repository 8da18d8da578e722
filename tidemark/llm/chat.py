"""Chat formatting with a checked round trip.

A turn is written ``<s>role[INST] text [/INST]</s>``. A deterministic parser cuts at ``</s>`` and at
the markers. Every turn is rendered plainly, parsed and compared with its source; where that
differs, the control strings in it get a backslash after their first character, and the
result is parsed and compared again. Only conflicting turns change, and the
parser takes the backslashes out. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pick

OPEN, START, STOP, CLOSE = "<s>", "[INST] ", " [/INST]", "</s>"
TRAINED_ROLE = "assistant"

# A control string with any number of backslashes after its first character.
_TAIL = r"(/?s>|/?INST\])"
_CONTROL = rf"([<\[])(\\*){_TAIL}"
_ESCAPED = rf"([<\[])\\(\\*){_TAIL}"
_MARKERS = r"<s>|\[INST\]|\[/INST\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(START), text, F.lit(STOP), F.lit(CLOSE))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: an array of ``role`` and ``text``, null where ill formed.

    A turn's piece must be cut by its three markers into nothing, role, text and nothing.
    """

    def turn(piece: Column) -> Column:
        def of_parts(parts: Column) -> Column:
            role, text = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
            text = F.substr(text, F.lit(2), F.greatest(F.char_length(text) - 2, F.lit(0)))
            whole = F.concat(F.lit(OPEN), role, F.lit(START), text, F.lit(STOP))
            formed = (F.size(parts) == 4) & (whole == piece)
            return F.struct(
                F.when(formed, unescape(role)).alias("role"),
                F.when(formed, unescape(text)).alias("text"),
            )

        return _once(F.split(piece, _MARKERS), of_parts)

    return _once(
        F.split(formatted, CLOSE), lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), turn)
    )


def _returns(rendered: Column, role: Column, text: Column) -> Column:
    """Whether parsing gives back exactly this turn and nothing more."""

    def same(turns: Column) -> Column:
        got = F.get(turns, F.lit(0))
        return (F.size(turns) == 1) & got["role"].eqNullSafe(role) & got["text"].eqNullSafe(text)

    return _once(parse(rendered), same)


def _settle(role: Column, text: Column) -> Column:
    """``piece`` and ``head``: a turn's rendering, and its role there, escaped where it must be."""

    def safe(head: Column) -> Column:
        return _once(
            render(head, escape(text)),
            lambda piece: F.when(
                _returns(piece, role, text), F.struct(piece.alias("piece"), head.alias("head"))
            ).otherwise(F.raise_error(F.lit("a turn does not return from its rendering"))),
        )

    return _once(
        render(role, text),
        lambda plain: F.when(
            _returns(plain, role, text), F.struct(plain.alias("piece"), role.alias("head"))
        ).otherwise(_once(escape(role), safe)),
    )


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns``.

    ``turns`` has each turn's ``start`` and ``stop`` in ``formatted`` and its loss span
    ``loss_start``, ``loss_stop`` (empty unless the role is ``assistant``), in code points from 0.
    Turns are ordered by ``turn`` (null first), then role and text, so ties and repeated
    rows have a defined order and all stay. A null text or role is empty; rows of null
    ``conv_id`` are one conversation. Other columns are ignored; an empty table gives no
    rows. A turn that cannot be made to return raises an error.
    Turns are rendered and checked one by one before a conversation is put together.
    """
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    checked = rows.withColumn("settled", _settle(F.col("role"), F.col("text"))).select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.col("settled.piece").alias("piece"),
        F.char_length("settled.piece").cast("long").alias("n"),
        (F.char_length("settled.head") + len(OPEN) + len(START)).cast("long").alias("n_head"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    trained = F.col("role") == TRAINED_ROLE
    loss_start = F.col("start") + F.col("n_head")
    loss_stop = F.col("start") + F.col("n") - len(STOP) - len(CLOSE)
    placed = (
        checked.withColumn("start", F.coalesce(before, F.lit(0)).cast("long"))
        .withColumn("place", F.row_number().over(order))
        .select(
            "conv_id",
            "place",
            "piece",
            F.struct(
                "start",
                (F.col("start") + F.col("n")).alias("stop"),
                F.when(trained, loss_start).otherwise(F.col("start")).alias("loss_start"),
                F.when(trained, loss_stop).otherwise(F.col("start")).alias("loss_stop"),
            ).alias("span"),
        )
    )
    listed = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece", "span"))).alias("all")
    )
    return listed.select(
        "conv_id",
        F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
        F.transform("all", lambda x: x["span"]).alias("turns"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the output of :func:`format_turns` holds, read from it alone."""
    told = F.transform(
        "parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    pieces = F.split("formatted", CLOSE)
    loss = F.zip_with(
        F.slice(pieces, 1, F.size("turns")),
        "turns",
        lambda piece, t: unescape(
            F.substr(
                piece,
                (t["loss_start"] - t["start"] + 1).cast("int"),
                (t["loss_stop"] - t["loss_start"]).cast("int"),
            )
        ),
    )
    return (
        formatted.withColumn("parsed", parse(F.col("formatted")))
        .withColumn("loss", F.array_join(loss, ""))
        .select(
            "conv_id",
            F.size("parsed").cast("long").alias("n_turns"),
            F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )
