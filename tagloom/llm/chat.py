"""Chat formatting that can be read back: a template, its parser, and escapes where they would not agree.

Column expressions only. A turn is ``### role: text</turn>`` and a line feed. The parser cuts at every ``### ``, wants one
``</turn>`` at the end, takes what stands before the first ``: `` as the role and reads a backslash as the sign that the
next character is meant literally. A turn whose plain rendering the parser does not give back is rendered with escapes:
``\\`` as ``\\\\``, ``### `` as ``##\\# ``, ``</turn>`` as ``<\\/turn>``, and ``: `` in a role as ``:\\ ``; markers then stand
in no text. The whole rendering is parsed once more, and ``identical`` tells whether it gave the source.

Turns are ordered by turn (null first), then role, then text; repeated rows are turns of their own. Null roles and texts
read as empty; a null conversation id is a conversation. One conversation is one row, in memory as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, STOP = "### ", "</turn>"
LOSS_ROLE = "assistant"


def swap(x: Column, old: str, new: str) -> Column:
    return F.replace(x, F.lit(old), F.lit(new))


def escaped(x: Column) -> Column:
    return swap(swap(swap(x, "\\", "\\\\"), START, "##\\# "), STOP, "<\\/turn>")


def unescaped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?s)\\(.)", "$1")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(": "), text, F.lit(STOP + "\n"))


def pieces(formatted: Column) -> Column:
    """What follows each start marker: [role: text</turn>\\n]."""
    return F.filter(F.split(formatted, START, -1), lambda x, i: i > 0)


def role_of(piece: Column) -> Column:
    return F.substring_index(piece, ": ", 1)


def text_of(piece: Column) -> Column:
    """Between the role and the end marker."""
    head = F.length(role_of(piece)) + 2
    return piece.substr(head + 1, F.greatest(F.length(piece) - head - len(STOP) - 1, F.lit(0)))


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a rendering; null where it does not follow the grammar."""
    parts = pieces(formatted)
    sound = formatted.startswith(START) & F.forall(parts, lambda p: p.contains(": ") & p.endswith(STOP + "\n") & (F.size(F.split(p, STOP, -1)) == 2))
    turns = F.transform(parts, lambda p: F.struct(unescaped(role_of(p)).alias("role"), unescaped(text_of(p)).alias("text")))
    return F.when(sound | (formatted == ""), turns)


def loss_spans(formatted: Column) -> Column:
    """Start and end, in code points of the rendering, of every text that is learned from."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + len(START) + F.length(role_of(p)) + 2
        span = F.array(F.struct(begin.alias("start"), (begin + F.length(text_of(p))).alias("end")))
        out = F.when(unescaped(role_of(p)) == LOSS_ROLE, F.concat(acc["out"], span)).otherwise(acc["out"])
        return F.struct((acc["at"] + len(START) + F.length(p)).alias("at"), out.alias("out"))

    return F.aggregate(pieces(formatted), start, step, lambda acc: acc["out"])


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans, identical) per conversation of the rows ``turns``."""
    rows = turns.select(F.col(conv_id).alias("c"), F.col(turn).alias("n"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    plain = rendered(F.col("r"), F.col("t"))
    same = parsed(plain) == F.array(F.struct(F.col("r").alias("role"), F.col("t").alias("text")))
    safe = rendered(swap(escaped(F.col("r")), ": ", ":\\ "), escaped(F.col("t")))
    rows = rows.withColumn("s", F.when(F.coalesce(same, F.lit(False)), plain).otherwise(safe))
    whole = rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("n", "r", "t", "s"))).alias("rows"))
    whole = whole.select("c", "rows", F.array_join(F.transform("rows", lambda x: x["s"]), "").alias("formatted"))
    source = F.transform("rows", lambda x: F.struct(x["r"].alias("role"), x["t"].alias("text")))
    return whole.select(F.col("c").alias(conv_id), "formatted", loss_spans(F.col("formatted")).alias("loss_spans"),
                        F.coalesce(parsed(F.col("formatted")) == source, F.lit(False)).alias("identical"))
