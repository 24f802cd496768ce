"""Chat formatting: conversations rebuilt from event logs and rendered, in built-in functions alone.

Events of a conversation are sorted by sequence and folded: a `message` opens a turn
(or replaces it), a `delta` appends to it, an `edit` replaces its text, a
`regenerate` empties it for new deltas, a `delete` removes it. An edit or a
regeneration of a turn discards what earlier events said in later turns.

Control strings inside texts are escaped: the escape character starts a two-character
code for itself and for every control string, so none is left in a text and decoding
is exact. The result must hold a whole conversation as one string, so a conversation
is bounded by the 2 GB that Spark allows a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

ESC = "␛"
START, END = "<|im_start|>", "<|im_end|>"
#: Control strings and the second character of their codes.
CODES = {START: "a", END: "b", "<s>": "c", "</s>": "d", "[INST]": "f", "[/INST]": "g", "<<SYS>>": "h", "<</SYS>>": "i"}
EVENTS = ("message", "delta", "edit", "regenerate", "delete")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit(ESC), F.lit(f"{ESC}e"))
    for control, code in CODES.items():
        out = F.replace(out, F.lit(control), F.lit(ESC + code))
    return out


def unescape(text: Column) -> Column:
    out = text
    for control, code in CODES.items():
        out = F.replace(out, F.lit(ESC + code), F.lit(control))
    return F.replace(out, F.lit(f"{ESC}e"), F.lit(ESC))


def escape_role(role: Column) -> Column:
    """As a text, with line feeds coded too: a line feed ends the role in the output."""
    return F.replace(escape(role), F.lit("\n"), F.lit(f"{ESC}n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(f"{ESC}n"), F.lit("\n")))


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of a log (conv_id, seq, turn, event, role, text).

    Unknown or null events count as `message`; null texts and roles are empty. Events
    of equal sequence are taken in the order of turn, event, role and text, so repeated
    rows and reruns agree. A turn that has no event left, or whose last is a `delete`, is
    gone. The role is the last one stated. Extra columns are left out.
    """
    event = F.when(F.col("event").isin(*EVENTS), F.col("event")).otherwise(F.lit("message"))
    log = log.select("conv_id", "turn", "seq", event.alias("event"), F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["seq", "turn", "event", "role", "text"]
    later = W.Window.partitionBy("conv_id").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(W.Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("event").isin("edit", "regenerate"), F.col("turn"))).over(later)
    log = log.withColumn("cut", cut).where(F.col("cut").isNull() | F.col("turn").isNull() | (F.col("cut") >= F.col("turn")))
    events = F.sort_array(F.collect_list(F.struct(*order)))
    folded = log.groupBy("conv_id", "turn").agg(events.alias("events"))
    step = lambda a, e: F.struct(
        F.coalesce(e["role"], a["role"]).alias("role"),
        F.when(e["event"] == "delta", F.concat(a["parts"], F.array(e["text"]))).otherwise(F.array(e["text"])).alias("parts"),
        (e["event"] != "delete").alias("live"),
    )
    start = F.struct(F.lit(None).cast("string").alias("role"), F.array().cast("array<string>").alias("parts"), F.lit(False).alias("live"))
    last = folded.select("conv_id", "turn", F.aggregate("events", start, step).alias("m")).where("m.live")
    return last.select("conv_id", "turn", F.coalesce("m.role", F.lit("")).alias("role"), F.array_join("m.parts", "").alias("text"))


def messages_as_events(rows: DataFrame) -> DataFrame:
    """A log in which every row of (conv_id, turn, role, text) is a message of its own, ordered by turn (null first), role and text.

    Repeated rows are messages each; null conversations are one; an empty table gives an empty log; extra columns are left out.
    """
    order = W.Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("turn"), "role", "text").select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("event"), "role", "text"
    )


def render(messages: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss_mask (per turn: where its text starts in `formatted`, from 0, how long it is, whether it is trained on).

    Messages come in the order of their turn, then role and text. Assistant texts are
    under the mask, without the marks around them. A conversation without messages has
    no row; an empty table gives none.
    """
    head = F.concat(F.lit(START), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    pieces = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), head.alias("head"), body.alias("body"))
    turn = F.struct("turn", "role", "body", "head")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(f"{END}\n"))), "")
    tail = len(END) + 1
    # From the last span on: (end of the turn, span).
    spans = F.aggregate(
        F.transform("turns", lambda t: F.struct(F.length(t["head"]).alias("h"), F.length(t["body"]).alias("b"), (t["role"] == "assistant").alias("loss"))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int,loss:boolean>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + t["h"] + t["b"] + tail).alias("at"),
            F.concat(a["spans"], F.array(F.struct((a["at"] + t["h"]).alias("start"), t["b"].alias("length"), t["loss"].alias("loss")))).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return whole.select("conv_id", text.alias("formatted"), spans.alias("loss_mask"))


def masked_texts(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(F.filter(loss_mask, lambda s: s["loss"]), lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a rendered conversation holds, in order."""
    parts = F.split(formatted, "\\Q" + START + "\\E")
    marked = F.slice(parts, F.lit(2), F.size(parts))
    body = lambda t: F.substr(t, F.lit(1), F.length(t) - len(END) - 1)
    cut = lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substr(t, F.locate("\n", t) + 1)).alias("text"),
    )
    return F.transform(marked, lambda t: cut(body(t)))
