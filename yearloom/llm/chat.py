"""Chat formatting from an event log (DataFrame functions only).

A log row is one event of a conversation: (conv_id, seq, message, op, role, text).
Events are partitioned by conversation and folded in order of ``seq``:

* ``message``     the message starts, with its role and first text
* ``delta``       text is appended to the message
* ``edit``        the message's text is replaced
* ``regenerate``  the message starts afresh, and later messages that were written
                  before this event are dropped

Each final message is rendered between control strings; control strings inside
roles and texts are escaped reversibly, so the rendered text can be parsed back.
The loss mask is the list of spans (start, length in code points) of assistant
texts in the rendered text.

Defined results: null text counts as empty, a null role as an empty role; a null
conversation id is a conversation of its own; events with the same ``seq`` are
ordered by message, op, role and text; a message without an opening event takes
the first role its events name; an empty log gives no rows; other columns of the
log are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TAIL = END + "\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def turn_events(turns: DataFrame, delta_chars: int = 256, drafts: bool = False) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): every row
    is a message that starts empty and is streamed in deltas. Rows are ordered by
    turn, rows of one turn by role and text; null turns come last. With ``drafts``
    two of three messages are streamed wrong at first (their beginning backwards):
    the second of each three is then edited to its right beginning, the third
    regenerated, and the rest is streamed."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = turns.select("conv_id", F.col("turn"), "role", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "message", F.row_number().over(order).cast("long"))
    parts = F.ceil(F.length("text") / F.lit(delta_chars)).cast("int")
    chunk = lambda i: F.substring(F.col("text"), (i - 1) * delta_chars + 1, F.lit(delta_chars))
    event = lambda op, text: F.struct(F.lit(op).alias("op"), text.alias("text"))
    deltas = F.transform(F.when(parts > 0, F.sequence(F.lit(1), parts)).otherwise(F.array().cast("array<int>")), lambda i: event("delta", chunk(i)))
    log = F.concat(F.array(event("message", F.lit(""))), deltas)
    if drafts:
        start, draft = F.substring("text", 1, delta_chars), event("delta", F.reverse(F.substring("text", 1, delta_chars)))
        opened = F.array(event("message", F.lit("")), draft)
        log = (F.when(F.col("message") % 3 == 2, F.concat(opened, F.array(event("edit", start)), F.slice(deltas, 2, F.greatest(parts, F.lit(1)))))
               .when(F.col("message") % 3 == 0, F.concat(opened, F.array(event("regenerate", F.lit(""))), deltas)).otherwise(log))
    return rows.select("conv_id", "message", "role", F.posexplode(log).alias("part", "e")).select(
        "conv_id", F.struct("message", F.col("part").cast("long").alias("part")).alias("seq"), "message",
        F.col("e")["op"].alias("op"), "role", F.col("e")["text"].alias("text"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, role, text."""
    e = events.select("conv_id", "message", F.struct("seq", "op", "role", F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    lists = e.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list("e")).alias("log"))
    opens = F.filter(F.col("log"), lambda x: x["op"] != "delta")
    last = F.try_element_at(opens, F.lit(-1))["seq"]
    after = F.filter(F.col("log"), lambda x: F.when(F.size(opens) > 0, (x["seq"] >= last)).otherwise(F.lit(True)))
    starts = F.filter(after, lambda x: x["op"] != "delta")
    body = F.concat(F.coalesce(F.try_element_at(F.transform(starts, lambda x: x["text"]), F.lit(-1)), F.lit("")),
                    F.array_join(F.transform(F.filter(after, lambda x: x["op"] == "delta"), lambda x: x["text"]), ""))
    named = F.filter(F.concat(F.filter(F.col("log"), lambda x: x["op"] == "message"), F.col("log")), lambda x: x["role"].isNotNull())
    folded = lists.select(
        "conv_id", "message", body.alias("text"), F.coalesce(F.get(named, 0)["role"], F.lit("")).alias("role"),
        F.try_element_at(F.col("log"), F.lit(1))["seq"].alias("_first"), F.coalesce(last, F.try_element_at(F.col("log"), F.lit(1))["seq"]).alias("_open"),
        F.try_element_at(F.filter(F.col("log"), lambda x: x["op"] == "regenerate"), F.lit(-1))["seq"].alias("_again"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    return (folded.withColumn("_cut", F.max("_again").over(before))
            .where(F.col("_cut").isNull() | (F.col("_cut") < F.col("_open"))).select("conv_id", "message", "role", "text"))


def render(messages: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss (array of (start, length),
    start counted from 0 in code points)."""
    m = messages.withColumn("_role", escape_role(F.col("role"))).withColumn("_text", escape(F.col("text")))
    m = m.withColumn("_out", F.concat(F.lit(START), F.col("_role"), F.lit("\n"), F.col("_text"), F.lit(TAIL)))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("_at", F.coalesce(F.sum(F.length("_out")).over(before), F.lit(0)) + len(START) + F.length("_role") + 1)
    lists = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "role", "_out", "_at", F.length("_text").alias("_n")))).alias("m"))
    spans = F.transform(F.filter(F.col("m"), lambda x: x["role"] == LOSS_ROLE),
                        lambda x: F.struct(x["_at"].alias("start"), x["_n"].cast("long").alias("length")))
    return lists.select("conv_id", F.array_join(F.transform(F.col("m"), lambda x: x["_out"]), "").alias("formatted"), spans.alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse rendered conversations: conv_id, turns (array of role, text) and
    loss_text, the unescaped texts under the loss mask, one after the other."""
    parts = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    bodies = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.substring(x, F.lit(len(START) + 1), F.length(x)))
    turns = F.transform(bodies, lambda x: F.struct(
        unescape_role(F.substring(x, F.lit(1), F.instr(x, "\n") - 1)).alias("role"),
        unescape(F.substring(x, F.instr(x, "\n") + 1, F.length(x))).alias("text")))
    under = F.transform(F.col("loss"), lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return rendered.select("conv_id", "formatted", turns.alias("turns"), F.array_join(under, "").alias("loss_text"))


def format_turns(turns: DataFrame, delta_chars: int = 256, drafts: bool = False) -> DataFrame:
    """Event log of a table of turns, folded and rendered."""
    return render(fold(turn_events(turns, delta_chars, drafts)))
