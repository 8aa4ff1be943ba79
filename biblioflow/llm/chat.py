"""Chat formatting with a grammar round trip, in DataFrame operations only.

    conversation := turn*        turn := "<turn>" role NEWLINE text "</turn>" NEWLINE

``parse`` is the deterministic parser of that grammar. Each turn is first rendered verbatim and parsed again; where
that does not give the same role and text, or the content holds a control string, it is rendered with the next way of
escaping until it does. The last way is one-to-one for any string (it leaves no "<" and marks every backslash), so the
search ends. A conversation is its turns' renderings in order, and what is read back is parsed from the whole of it.

Defined cases: a null role or text is empty; turns of one conversation are in the order of turn, role, text (nulls
first), and repeated rows are turns of their own; a null conv_id is a conversation; other columns, also of clashing names,
are left aside; an empty table gives no conversations. A conversation's text is one value, whatever its number of turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, NEWLINE = "<turn>", "</turn>", "\n"
LOSS_ROLE = "assistant"


def verbatim(value: Column) -> Column:
    return value


def escaped(value: Column) -> Column:
    """Backslash doubled, "<" as backslash and l, newline kept."""
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


#: Ways of escaping, tried in this order.
WAYS = (verbatim, escaped)


def one_line(value: Column) -> Column:
    """A role must not end its own line."""
    return F.replace(value, F.lit("\n"), F.lit("\\n"))


def unescaped(value: Column) -> Column:
    """Doubled backslashes part the string; between them stand the other two escapes."""
    parts = F.transform(F.split(value, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(NEWLINE))


def render(role: Column, text: Column) -> Column:
    return F.concat(header(role), text, F.lit(CLOSE + NEWLINE))


def parse(rendered: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; a turn that breaks the grammar is null."""
    pieces = F.split(rendered, CLOSE)

    def turn(piece: Column, at: Column) -> Column:
        own = F.when(at > 0, F.when(piece.startswith(NEWLINE), F.substring(piece, F.lit(2), F.length(piece)))).otherwise(piece)
        body = F.substring(own, F.lit(len(OPEN) + 1), F.length(own))
        role = F.substring_index(body, NEWLINE, 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        fine = own.startswith(OPEN) & body.contains(NEWLINE) & ~body.contains(OPEN)
        return F.when(fine, F.struct(unescaped(role).alias("role"), unescaped(text).alias("text")))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def rendered_turn(role: Column, text: Column) -> tuple[Column, Column]:
    """(escaped role, escaped text): by the first of WAYS that the parser gives back unchanged."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    tries = []
    for way in WAYS:
        r, t = way(role) if way is verbatim else one_line(way(role)), way(text)
        tries.append(F.when(parse(render(r, t)).eqNullSafe(source), F.struct(r.alias("role"), t.alias("text"))))
    found = F.coalesce(*tries)
    return found["role"], found["text"]


#: Code points in the blocks that ``under_mask`` cuts a conversation into.
BLOCK = 4096


def under_mask(formatted_: Column, spans: Column) -> Column:
    """What stands in ``formatted_`` under each of ``spans`` (start, length), read back from its escapes.

    The conversation is cut into blocks once, and a span touches its own blocks only, so many turns cost no more than one.
    """
    blocks = F.regexp_extract_all(formatted_, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def held(span: Column) -> Column:
        first = F.floor(span["start"] / BLOCK)
        last = F.floor((span["start"] + span["length"]) / BLOCK)
        some = F.array_join(F.slice(blocks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return unescaped(F.substring(some, (span["start"] - first * BLOCK + 1).cast("int"), span["length"].cast("int")))

    return F.transform(spans, held)


def formatted(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans, turns, identical): a row for each conversation.

    loss_spans: (start, length) in code points of the assistant's escaped texts in ``formatted``; turns: role and text
    as parsed back from it; identical: whether they are the source's.
    """
    source = F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), source.alias("source"))
    r, t = rendered_turn(F.col("source.role"), F.col("source.text"))
    rows = rows.select("conv_id", "turn", "source", F.struct(r.alias("role"), t.alias("text")).alias("own"))
    line = render(F.col("own.role"), F.col("own.text"))
    ahead = Window.partitionBy("conv_id").orderBy("turn", "source.role", "source.text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("line").cast("long")).over(ahead), F.lit(0)) + F.length(header(F.col("own.role")))
    span = F.when(F.col("source.role") == LOSS_ROLE, F.struct(start.alias("start"), F.length("own.text").cast("long").alias("length")))
    rows = rows.withColumn("line", line).select("conv_id", F.struct("turn", "source", "line", span.alias("span")).alias("row"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    out = whole.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda x: x["line"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.transform("rows", lambda x: x["source"]).alias("sources"),
    )
    return out.withColumn("turns", parse(F.col("formatted"))).select("conv_id", "formatted", "loss_spans", "turns", (F.col("turns") == F.col("sources")).alias("identical"))
