"""Chat formatting (operator 1): event-sourced reconstruction; DataFrame functions only.

A log holds events of conversations. Events are dealt by conversation and chunk of CHUNK messages, so
that no conversation has to fit one task, sorted by message and sequence, and folded into final messages:
`message` sets a new message, `delta` appends to it, `edit` and `regenerate` start its text anew, `delete`
takes it away. Messages are then rendered in a template with marked turns. Control strings inside texts are
escaped reversibly, so the rendered text reads back without loss; the loss mask is given as spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

START, END = "<|im_start|>", "<|im_end|>"
CHUNK = 32
#: Events that append; all other kinds start the text of their message anew.
APPENDS = "delta"


def escape(text: Column) -> Column:
    """Puts one backslash more between < and |, so that no control string is left; unescape() takes it away."""
    return F.regexp_replace(text, "<(\\\\*)\\|", "<\\\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "<\\\\(\\\\*)\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on one line: line ends (and the sign that marks them) are written as %0A (%25)."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, chunk, turns (array of role and text in order): final messages, in chunks of each conversation.

    events: conv_id, msg (order of the message in its conversation), seq (order of the event), kind
    (message, delta, edit, regenerate, delete; null: message; any other starts the text anew, as edit does), role, text;
    more columns are left out. A null msg
    or seq comes first; events that tie go by kind, role and text; a repeated message event gives a message of
    its own. Null texts and roles are empty; the last role that is given counts. A null conv_id is a
    conversation of its own."""
    e = events.select("conv_id", F.col("msg").cast("long").alias("msg"), F.col("seq").cast("long").alias("seq"), F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    e = e.withColumn("chunk", F.coalesce(F.floor(F.col("msg") / CHUNK), F.lit(-(1 << 62)))).repartition("conv_id", "chunk")
    order = W.partitionBy("conv_id", "chunk", "msg").orderBy("seq", "kind", "role", "text")
    e = e.withColumn("run", F.sum((F.col("kind") == "message").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    log = F.sort_array(F.collect_list(F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), "text")))
    m = e.groupBy("conv_id", "chunk", "msg", "run").agg(log.alias("log"))
    since = F.coalesce(F.array_max(F.transform("log", lambda x, i: F.when(x["kind"] != APPENDS, i))), F.lit(0))
    m = m.withColumn("live", F.slice("log", since + 1, F.size("log")))
    m = m.filter(F.element_at("live", 1)["kind"] != "delete")
    roles = F.filter("log", lambda x: x["role"] != "")
    m = m.select("conv_id", "chunk", "msg", "run", F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"), F.array_join(F.transform("live", lambda x: x["text"]), "").alias("text"))
    turns = F.sort_array(F.collect_list(F.struct("msg", "run", "role", "text")))
    return m.groupBy("conv_id", "chunk").agg(F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def render(chunks: DataFrame, train_on: str = "assistant") -> DataFrame:
    """conv_id, chunk, n_turns, formatted, loss_spans (array of start and end, code points of the chunk's text).

    A conversation's text is that of its chunks in order. Spans cover the texts of turns of role `train_on`."""
    pieces = F.transform("turns", lambda t: F.struct((t["role"] == train_on).alias("loss"), F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body")))
    p = chunks.select("conv_id", "chunk", pieces.alias("pieces"))
    tail = f"{END}\n"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(a: Column, x: Column) -> Column:
        start = a["at"] + F.length(x["head"])
        end = start + F.length(x["body"])
        spans = F.when(x["loss"], F.array_append(a["spans"], F.struct(start.alias("start"), end.alias("end")))).otherwise(a["spans"])
        return F.struct((end + len(tail)).alias("at"), spans.alias("spans"))

    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "")
    return p.select("conv_id", "chunk", F.size("pieces").cast("long").alias("n_turns"), text.alias("formatted"), F.aggregate("pieces", empty, add, lambda a: a["spans"]).alias("loss_spans"))


def read_back(formatted: DataFrame, *more: str) -> DataFrame:
    """conv_id, chunk, turns (array of role and text), loss_text: what render() was given, from its output alone; and more columns."""
    parts = F.filter(F.split("formatted", "<\\|im_end\\|>\n", -1), lambda x: x != "")
    head = len(START) + 1
    turn = lambda x: F.struct(unescape_role(F.substring(F.substring_index(x, "\n", 1), head, 1 << 30)).alias("role"), unescape(F.substring(x, F.instr(x, "\n") + 1, F.length(x))).alias("text"))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", "chunk", F.transform(parts, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"), *more)


def conversation_events(rows: DataFrame) -> DataFrame:
    """Rows of a conversation table (conv_id, turn, role, text) as events: each a whole message."""
    return rows.select("conv_id", F.col("turn").alias("msg"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """A row for each conversation, with digests of what reads back from its formatted chunks.

    A digest is over the whole conversation, so its texts meet in one row: one conversation must fit a task here, though
    not in what comes before."""
    back = read_back(formatted, "formatted")
    each = F.struct("chunk", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"), F.col("loss_text").alias("loss"))
    one = back.groupBy("conv_id").agg(F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum(F.length("loss_text")).cast("long").alias("loss_chars"), F.sum(F.length("formatted")).cast("long").alias("formatted_chars"), F.sort_array(F.collect_list(each)).alias("c"))
    digest = lambda field: F.sha2(F.array_join(F.transform("c", lambda x: x[field]), ""), 256)
    return one.select("conv_id", "n_turns", digest("turns").alias("turns_sha256"), "loss_chars", digest("loss").alias("loss_sha256"), "formatted_chars")
