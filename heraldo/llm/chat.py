"""Chat formatting by event-sourced reconstruction, with DataFrame functions only.

A log holds events of messages: a start, an edit or a regeneration sets a message's text anew, a delta appends to it.
Events are grouped by message and folded in order of seq: the text is what came since the latest event that sets it, the
role the latest one given. Messages become blocks, `### role: text </turn>` and a new line, and a conversation is its
blocks in order. Inside roles and texts `\\`, `#` and `<` are escaped (and `:` in roles), so that no control string can
stand there, and `unescape` gives back what was there.

A conversation's blocks are joined in two steps, first in runs of CHUNK turns: a very long conversation is put together
from its runs, and the fold and the escaping never see more than one message.

Defined cases: null roles and texts are empty; null conv_ids and turns are keys like others, nulls first; an event log
without rows gives no conversation; a message whose log begins with a delta starts empty; events with equal seq are
ordered by kind and text; columns beyond those named are ignored. A conversation is one string at the end, so one of
more than two gigabytes can't be formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

HEAD, COLON, END = "### ", ": ", " </turn>\n"
CHUNK = 256
LOSS_ROLE = "assistant"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(text: Column) -> Column:
    part = lambda x: F.replace(F.replace(F.replace(x, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<")), F.lit("\\c"), F.lit(":"))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")).otherwise(text)


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, sub, role, text): final messages of a log (conv_id, turn, sub, seq, kind, role, text).

    kind is start, delta, edit or regenerate. turn and sub number a conversation's messages.
    """
    sets = F.col("kind").isin("start", "edit", "regenerate")
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), sets.alias("sets"), "role")
    log = events.groupBy("conv_id", "turn", "sub").agg(F.array_sort(F.collect_list(event)).alias("log"))
    last = F.coalesce(F.array_max(F.transform("log", lambda e, i: F.when(e.sets, i))), F.lit(0))
    roles = F.filter("log", lambda e: e.role.isNotNull())
    return log.withColumn("last", last).select(
        "conv_id", "turn", "sub",
        F.coalesce(F.try_element_at(roles, F.lit(-1)).getField("role"), F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter("log", lambda e, i: i >= F.col("last")), lambda e: e.text), "").alias("text"),
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss): each conversation's blocks in order, and the spans a model is trained on.

    A span is (block, start, end): code points start to end, exclusive, of the block with that number.
    """
    lead = F.concat(F.lit(HEAD), escape(F.col("role"), role=True), F.lit(COLON))
    body = escape(F.col("text"))
    blocks = messages.select("conv_id", "turn", "sub", F.concat(lead, body, F.lit(END)).alias("block"), F.when(F.col("role") == loss_role, F.struct(F.length(lead).alias("start"), (F.length(lead) + F.length(body)).alias("end"))).alias("span"))
    runs = blocks.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("run")).agg(F.array_sort(F.collect_list(F.struct("turn", "sub", "block", "span"))).alias("b"))
    runs = runs.select("conv_id", "run", F.array_join("b.block", "").alias("text"), F.col("b.span").alias("spans"))
    whole = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "text", "spans"))).alias("r")).select("conv_id", F.array_join("r.text", "").alias("formatted"), F.flatten("r.spans").alias("spans"))
    numbered = F.transform("spans", lambda s, i: F.struct(i.alias("block"), s.start.alias("start"), s.end.alias("end")))
    return whole.select("conv_id", "formatted", F.filter(numbered, lambda s: s.start.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts): roles and texts parsed from the formatted text, and the texts under the loss mask."""
    pieces = F.split("formatted", END)
    out = formatted.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(HEAD) + 1, F.length(piece))
        at = F.instr(rest, COLON)
        return F.struct(unescape(F.substring(rest, F.lit(1), at - 1)).alias("role"), unescape(F.substring(rest, at + len(COLON), F.length(rest))).alias("text"))

    masked = lambda s: unescape(F.substring(F.element_at("pieces", s.block + 1), s.start + 1, s.end - s.start))
    return out.select("conv_id", F.transform("pieces", turn).alias("turns"), F.transform("loss", masked).alias("loss_texts"), F.length("formatted").alias("chars"))


def events_of(rows: DataFrame) -> DataFrame:
    """A table of (conv_id, turn, role, text) as the log of a chat that streamed it; rows of one turn follow each other by role and text.

    Each message starts with a draft that grows by a delta and is then set aside: in even turns by a regeneration, which
    streams the text in three parts, in odd and null turns by an edit, to which the last part is added. Only the fold in
    order of seq gives the text back; roles stand in the first event alone.
    """
    tied = rows.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("role", "text"))).alias("rows"))
    row = tied.select("conv_id", "turn", F.posexplode("rows").alias("sub", "row")).select("conv_id", "turn", "sub", "row.role", F.coalesce("row.text", F.lit("")).alias("text"))
    third = F.floor(F.length("text") / 3).cast("int")
    part = lambda begin, size: F.substring(F.col("text"), begin + 1, size)
    event = lambda seq, kind, text, role=None: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), (F.lit(None).cast("string") if role is None else role).alias("role"), text.alias("text"))
    draft = [event(0, "start", part(third, third), F.col("role")), event(1, "delta", F.lit(" (draft)"))]
    last = event(4, "delta", part(2 * third, F.length("text")))
    again = F.array(last, *draft, event(3, "delta", part(third, third)), event(2, "regenerate", part(F.lit(0), third)))
    edited = F.array(last, *draft, event(3, "edit", part(F.lit(0), 2 * third)))
    log = row.select("conv_id", "turn", "sub", F.explode(F.when(F.col("turn") % 2 == 0, again).otherwise(edited)).alias("e"))
    return log.select("conv_id", "turn", "sub", "e.*")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    read = read_back(render(fold_messages(events_of(rows.unionByName(probe)))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.col("chars").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m AS (SELECT *, length(text) + length(role) + 15 + length(regexp_replace(text || role, '[^\\#<]', '', 'g')) + length(regexp_replace(role, '[^:]', '', 'g')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM m GROUP BY 1
"""
