"""Conversations as training text with a loss mask, in Spark expressions only.

The rows of a conversation are collected as structs and sorted, adjacent rows of
one role become one turn, and turns are concatenated:

    ### role: text<next>text</turn>

``<next>`` stands between the texts of one turn, so that every row can be read
back. Texts and roles are escaped before they are collected: a backslash is
doubled, and one is put inside each control string. After that no text holds a
control string, and ``\\x`` reads as ``x``. The loss mask is a list of byte
spans of the UTF-8 output, one for each text of an assistant; neither headers
nor end marks are under it.

Work is linear in the length of a conversation. A conversation is one value of
the result, so it is one row of a task; Spark holds values up to 2 GB.

Defined results: a null text or role is empty, rows of equal turn are ordered by
role and text, null turns come first, equal rows are all kept, and the rows
without conversation id are one conversation. An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import let

#: Control strings of the template; ``HEADER_END`` ends the role.
HEADER, HEADER_END, NEXT, END = "### ", ": ", "<next>", "</turn>\n"
#: What a text must not hold, and what stands for it.
BROKEN_UP = (("\\", "\\\\"), ("</turn>", "<\\/turn>"), ("<next>", "<\\next>"), ("##", "#\\#"))
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """``text`` without control strings; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    for plain, safe in BROKEN_UP:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def escaped_role(role: Column) -> Column:
    """``role`` without control strings and without the end of a header."""
    return F.replace(escaped(role), F.lit(HEADER_END), F.lit(HEADER_END[0] + "\\" + HEADER_END[1:]))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _turns(rows: Column) -> Column:
    """Sorted rows with each run of one role merged: the role and the texts of the run."""

    def merged(rows: Column) -> Column:
        first = lambda r, i: (i == 0) | (r["role"] != F.get(rows, i - 1)["role"])
        marked = F.transform(rows, lambda r, i: F.when(first(r, i), i))
        texts = F.transform(rows, lambda r: r["text"])
        run = lambda starts, texts: F.transform(
            starts,
            lambda s, k: F.struct(
                F.get(rows, s)["role"].alias("role"),
                F.slice(texts, s + 1, F.coalesce(F.get(starts, k + 1), F.size(rows)) - s).alias("texts"),
            ),
        )
        return let(F.array_compact(marked), lambda starts: let(texts, lambda t: run(starts, t)))

    return let(rows, merged)


def _pieces(turns: Column) -> Column:
    """The output in order, cut into pieces that are wholly under the loss mask or not at all."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def of(turn: Column) -> Column:
        asked = turn["role"] == LOSS_ROLE
        texts = F.flatten(
            F.transform(
                turn["texts"],
                lambda t, i: F.array(piece(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), F.lit(False)), piece(t, asked)),
            )
        )
        head = piece(F.concat(F.lit(HEADER), turn["role"], F.lit(HEADER_END)), F.lit(False))
        return F.concat(F.array(head), texts, F.array(piece(F.lit(END), F.lit(False))))

    return F.flatten(F.transform(turns, of))


def _ends(sizes: Column) -> Column:
    """0 and the running sums of a filled array: summed in blocks, which are moved by the sums before them."""
    block = 256
    zero = F.array(F.lit(0))
    running = lambda xs: F.aggregate(xs, zero, lambda done, x: F.array_append(done, F.element_at(done, -1) + x))
    numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int"))
    inside = F.transform(numbers, lambda b: running(F.slice(sizes, b * block + 1, block)))
    moved = lambda parts, starts: F.flatten(
        F.transform(parts, lambda p, b: F.transform(F.slice(p, 2, block), lambda x: x + F.get(starts, b)))
    )
    totals = lambda parts: running(F.transform(parts, lambda p: F.element_at(p, -1)))
    return F.concat(zero, let(inside, lambda parts: let(totals(parts), lambda starts: moved(parts, starts))))


def _spans(pieces: Column, ends: Column) -> Column:
    """Start and size in bytes of the pieces under the mask."""
    span = lambda p, i: F.struct(F.get(ends, i).alias("start"), F.octet_length(p["text"]).alias("size"))
    return F.array_compact(F.transform(pieces, lambda p, i: F.when(p["loss"], span(p, i))))


def format_chats(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, and ``loss_spans``, the bytes of it under the loss mask."""
    row = F.struct(
        F.col(f"`{turn}`").alias("turn"), escaped_role(F.col(f"`{role}`")).alias("role"), escaped(F.col(f"`{text}`")).alias("text")
    )
    sorted_rows = (
        rows.select(F.col(f"`{conversation}`"), row.alias("__row"))
        .groupBy(f"`{conversation}`")
        .agg(F.sort_array(F.collect_list("__row")).alias("__rows"))
    )

    def output(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda p: F.octet_length(p["text"]))
        return F.struct(
            F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("formatted"),
            let(let(sizes, _ends), lambda ends: _spans(pieces, ends)).alias("loss_spans"),
        )

    made = let(_turns(F.col("__rows")), lambda turns: let(_pieces(turns), output))
    made = sorted_rows.select(F.col(f"`{conversation}`"), made.alias("__made"))
    return made.select(F.col(f"`{conversation}`"), "__made.formatted", "__made.loss_spans")


def read_turns(formatted: Column) -> Column:
    """Role and text of every row of a formatted conversation, in order."""

    def rows(turn: Column) -> Column:
        at = F.locate(HEADER_END, turn)
        role = unescaped(F.substring(turn, F.lit(len(HEADER) + 1), at - len(HEADER) - 1))
        texts = F.split(F.substring(turn, at + len(HEADER_END), F.char_length(turn)), NEXT)
        return let(role, lambda r: F.transform(texts, lambda t: F.struct(r.alias("role"), unescaped(t).alias("text"))))

    turns = F.split(formatted, END)
    return let(turns, lambda ts: F.flatten(F.transform(F.slice(ts, 1, F.size(ts) - 1), rows)))


def read_loss_texts(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    under = lambda utf8, s: unescaped(F.substring(utf8, s["start"] + 1, s["size"]).cast("string"))
    return let(formatted.cast("binary"), lambda utf8: F.transform(loss_spans, lambda s: under(utf8, s)))
