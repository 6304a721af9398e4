"""Chat formatting: fold event logs into messages, render them with a template, read the output back. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """`{head}{role}{sep}{text}{end}` per turn. The control strings inside texts and roles become escapes."""

    head: str = "### "
    sep: str = ":\n"
    end: str = "\n</turn>\n"
    controls: tuple[tuple[str, str], ...] = (("### ", "h"), ("</turn>", "t"))

    def escape(self, c: Column) -> Column:
        """Reversible: after it a backslash is always followed by a code letter, and no control string is left."""
        c = F.replace(c, F.lit("\\"), F.lit("\\s"))
        for string, code in self.controls:
            c = F.replace(c, F.lit(string), F.lit("\\" + code))
        return c

    def unescape(self, c: Column) -> Column:
        for string, code in self.controls:
            c = F.replace(c, F.lit("\\" + code), F.lit(string))
        return F.replace(c, F.lit("\\s"), F.lit("\\"))

    def escape_role(self, c: Column) -> Column:
        return F.replace(self.escape(c), F.lit("\n"), F.lit("\\n"))

    def unescape_role(self, c: Column) -> Column:
        return self.unescape(F.replace(c, F.lit("\\n"), F.lit("\n")))


TEMPLATE = ChatTemplate()
#: Message positions that one rendered part covers.
PART = 128


def fold_events(events: DataFrame) -> DataFrame:
    """events(conv_id, position, message_id, seq, kind, role, text) to messages(conv_id, position, message_id, role, text).

    Within a message events count by seq. kind `message`, `edit` and `regenerate` set the text (a regeneration mostly
    to the empty text, which deltas then fill), `delta` appends, `delete` drops the message unless a later event sets
    it again. The role is the last one given. Null text: empty; null seq: first; unknown or null kind: as `delta`.
    Events with one seq stand in order of (kind, role, text). Grouping is by message, so that a long conversation is
    spread over tasks.
    """
    e = F.struct(F.col("seq"), F.coalesce(F.col("kind"), F.lit("delta")).alias("kind"), F.col("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    log = events.groupBy("conv_id", "position", "message_id").agg(F.sort_array(F.collect_list(e)).alias("log"))
    resets = F.transform("log", lambda x, i: F.when(x["kind"].isin("message", "edit", "regenerate", "delete"), i + 1))
    log = log.withColumn("since", F.greatest(F.coalesce(F.array_max(resets), F.lit(1)), F.lit(1)))
    log = log.withColumn("live", F.slice("log", F.col("since"), F.size("log")))
    roles = F.filter(F.transform("log", lambda x: x["role"]), lambda r: r.isNotNull())
    log = log.where(~((F.size("live") == 1) & (F.col("live")[0]["kind"] == "delete")))
    text = F.array_join(F.transform(F.filter("live", lambda x: x["kind"] != "delete"), lambda x: x["text"]), "")
    return log.select("conv_id", "position", "message_id", F.try_element_at(roles, F.lit(-1)).alias("role"), text.alias("text"))


def render(messages: DataFrame, template: ChatTemplate = TEMPLATE, train_role: str = "assistant") -> DataFrame:
    """messages to parts(conv_id, part, formatted, mask): the formatted text of PART positions each, in order, and the
    spans of formatted code points (start, length) whose text a model is trained on: the train_role's texts.

    A conversation's output is its parts end to end; so no task holds a long conversation's rows. Messages of one
    position stand in order of (role, text). Null role: empty.
    """
    m = F.struct("position", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    part = F.floor(F.col("position") / F.lit(PART))
    parts = messages.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(m)).alias("ms"))

    def piece(x: Column) -> Column:
        before = F.concat(F.lit(template.head), template.escape_role(x["role"]), F.lit(template.sep))
        return F.struct(before.alias("before"), template.escape(x["text"]).alias("text"), (x["role"] == train_role).alias("train"))

    parts = parts.withColumn("ps", F.transform("ms", piece))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start, size = acc["at"] + F.length(x["before"]), F.length(x["text"])
        spans = F.when(x["train"], F.array_append(acc["spans"], F.struct(start.alias("start"), size.alias("length")))).otherwise(acc["spans"])
        return F.struct((start + size + len(template.end)).alias("at"), spans.alias("spans"))

    formatted = F.array_join(F.transform("ps", lambda x: F.concat(x["before"], x["text"], F.lit(template.end))), "")
    return parts.select("conv_id", "part", formatted.alias("formatted"), F.aggregate("ps", empty, step)["spans"].alias("mask"))


def read_back(parts: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """parts with turns (array of role and text, unescaped) and loss_text (the text under the mask, unescaped)."""
    segments = F.split("formatted", "\\Q" + template.end + "\\E")

    def turn(s: Column) -> Column:
        role = F.substring_index(s, template.sep, 1)
        text = F.substring(s, F.length(role) + len(template.sep) + 1, F.length(s))
        return F.struct(template.unescape_role(F.substring(role, F.lit(len(template.head) + 1), F.length(role))).alias("role"), template.unescape(text).alias("text"))

    turns = F.transform(F.slice(segments, F.lit(1), F.size(segments) - 1), turn)
    loss = F.transform("mask", lambda s: template.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return parts.withColumns({"turns": turns, "loss_text": F.array_join(loss, "")})


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Rows of conversations(conv_id, turn, role, text), a complete message each, as parts of formatted text.

    Null conv_id: one conversation; null turn: before all others; repeated rows: messages of their own; an empty table
    gives no parts; further columns are not read.
    """
    events = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("position"), F.monotonically_increasing_id().alias("message_id"),
        F.lit(0).alias("seq"), F.lit("message").alias("kind"), "role", "text")
    return render(fold_events(events))


def op7_chat_format(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    parts = read_back(format_conversations(table.unionByName(extra)))
    parts = parts.select(
        "conv_id", "part", F.size("turns").cast("long").alias("n"), F.length("formatted").cast("long").alias("chars"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"), "loss_text")
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sum(F.length("loss_text").cast("long")).alias("loss_chars"),
        F.sort_array(F.collect_list(F.struct("part", "said", "loss_text"))).alias("ps"))
    digest = lambda field: F.sha2(F.array_join(F.transform("ps", lambda p: p[field]), ""), 256)
    return whole.select("conv_id", "n_turns", digest("said").alias("turns_sha256"), "loss_chars", digest("loss_text").alias("loss_sha256"), "formatted_chars")


OP7_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(replace(replace(replace(replace(role, '\', '\s'), '### ', '\h'), '</turn>', '\t'), chr(10), '\n'))
             + length(replace(replace(replace(text, '\', '\s'), '### ', '\h'), '</turn>', '\t')) + 15 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
