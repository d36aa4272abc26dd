"""Conversations as one training string each, with a loss mask and attachment references.

A message is a turn of a conversation: ``conv_id``, ``turn``, ``role`` and ``parts``, an
array of typed parts (``PART``). A visitor flattens the parts of a turn in order: text parts
that follow one another are joined and escaped as one, so that no control string arises where
two of them meet; any other kind leaves a placeholder ``<|kind|>``, an attachment reference and the
number of tokens that the placeholder will expand to (its units times the kind's rate).

    <|turn|>role<|body|>flattened parts<|end|>

Control strings inside texts and roles are kept apart by one more backslash after their
first character: ``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``. So no escaped text
holds a control string, and taking one backslash away gives the text back exactly.

Defined cases: a null text, role or part list is empty; a null conversation id is a
conversation of its own; a null turn comes first; equal turns go by role, then content;
repeated rows are turns of their own; an empty table gives an empty table; other columns
of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,units:bigint>"

#: Tokens for each unit: an image's patches, an audio's frames, a document's pages.
RATES = {"image": 1, "audio": 1, "document": 256}

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

#: First character, backslashes already there, rest of a control string.
_PLAIN = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"(<|\[)\\(\\*)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """A part list of one text."""
    part = F.struct(
        F.lit("text").alias("kind"),
        text.alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part)


def _kind(part: Column) -> Column:
    return F.lower(F.coalesce(part["kind"], F.lit("text")))


def _placeholder(part: Column) -> Column:
    """The kind between bars; one that is called like a control string has a dash more."""
    name = F.regexp_replace(_kind(part), "[^a-z0-9_]", "_")
    name = F.when(name.isin("turn", "body", "end"), F.concat(name, F.lit("_"))).otherwise(name)
    return F.concat(F.lit("<|"), name, F.lit("|>"))


def _stops(parts: Column) -> Column:
    """Where texts end: 0, the places from 1 of parts that are no text, one beyond the last."""
    at = F.transform(parts, lambda p, i: F.when(_kind(p) != "text", i + 1))
    return F.concat(F.array(F.lit(0)), F.array_compact(at), F.array(F.size(parts) + 1))


def _visit(parts: Column, stops: Column) -> Column:
    """Escaped text up to each stop, with the placeholder that stands there."""
    texts = F.transform(parts, lambda p: F.coalesce(p["text"], F.lit("")))

    def between(before: Column, k: Column) -> Column:
        stop = F.get(stops, k + 1)
        text = F.array_join(F.slice(texts, before + 1, stop - before - 1), "")
        mark = F.coalesce(_placeholder(F.get(parts, stop - 1)), F.lit(""))
        return F.concat(escape(text), F.when(stop > F.size(parts), "").otherwise(mark))

    return F.array_join(F.transform(F.slice(stops, 1, F.size(stops) - 1), between), "")


def _tokens(part: Column, rates: dict[str, int]) -> Column:
    rate = F.lit(1)
    for kind, tokens in rates.items():
        rate = F.when(_kind(part) == kind, F.lit(tokens)).otherwise(rate)
    return F.coalesce(part["units"], F.lit(1)) * rate


def format_conversations(
    messages: DataFrame,
    *,
    trained_role: str = "assistant",
    rates: dict[str, int] | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``loss_spans``,
    ``attachments`` and ``expanded_tokens``.

    ``loss_spans`` holds the trained turns' contents as code point ranges of ``formatted``,
    with the turn's index and the start inside the turn. The k-th attachment belongs to the
    k-th placeholder. Turns are flattened before the shuffle; offsets come from a running
    sum in turn order, so a conversation costs no more than sorting and joining its turns.
    """
    rates = RATES if rates is None else rates
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    turns = messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        parts.alias("parts"),
        _stops(parts).alias("stops"),
    )
    parts = F.col("parts")
    turns = turns.select(
        "conv_id",
        "turn",
        "role",
        _visit(parts, F.col("stops")).alias("content"),
        F.transform(
            F.filter(parts, lambda p: _kind(p) != "text"),
            lambda p: F.struct(
                _kind(p).alias("kind"),
                p["ref"].alias("ref"),
                _tokens(p, rates).cast("bigint").alias("tokens"),
            ),
        ).alias("attached"),
    )
    head = F.concat(F.lit(TURN), escape("role"), F.lit(BODY))
    turns = turns.select(
        "conv_id",
        "turn",
        "role",
        F.concat(head, "content", F.lit(END)).alias("piece"),
        F.char_length(head).alias("offset"),
        F.char_length("content").alias("length"),
        "attached",
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.select(
        "conv_id",
        F.struct(
            (F.row_number().over(order) - 1).alias("turn"),
            F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)).alias("start"),
            "piece",
            "offset",
            "length",
            (F.col("role") == trained_role).alias("trained"),
            "attached",
        ).alias("row"),
    )
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    attachments = F.flatten(
        F.transform(
            "rows",
            lambda r: F.transform(
                r["attached"],
                lambda a: F.struct(r["turn"].alias("turn"), a["kind"], a["ref"], a["tokens"]),
            ),
        )
    )
    spans = F.transform(
        F.filter("rows", lambda r: r["trained"]),
        lambda r: F.struct(
            (r["start"] + r["offset"]).alias("start"),
            (r["start"] + r["offset"] + r["length"]).alias("end"),
            r["turn"].alias("turn"),
            r["offset"].alias("in_turn"),
        ),
    )
    return gathered.select(
        "conv_id",
        F.size("rows").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(
            F.flatten(F.transform("rows", lambda r: F.transform(r["attached"], lambda a: a["tokens"]))),
            F.lit(0).cast("bigint"),
            lambda total, tokens: total + tokens,
        ).alias("expanded_tokens"),
    )


def pieces_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, markers but the last included."""
    pieces = F.split(formatted, r"<\|end\|>")
    return F.slice(pieces, 1, F.size(pieces) - 1)


def turn_of(piece: Column) -> Column:
    """Role and content of a turn, unescaped; placeholders stay as they are."""
    halves = F.split(F.substring(piece, len(TURN) + 1, 2**30), r"<\|body\|>")
    return F.struct(
        unescape(F.element_at(halves, 1)).alias("role"),
        unescape(F.element_at(halves, 2)).alias("content"),
    )


def masked_text(pieces: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    under = F.transform(
        loss_spans,
        lambda s: unescape(
            F.element_at(pieces, s["turn"] + 1).substr(
                s["in_turn"] + 1, (s["end"] - s["start"]).cast("int")
            )
        ),
    )
    return F.array_join(under, "")
