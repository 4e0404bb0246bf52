"""Quotation linking and reply-ordered conversations, on DataFrame functions.

The quote level of a line is the number of ``>`` it begins with.  Normalised
(quote marks off, white space as one space, lower case), each quoted line, and
the lines of a level taken together, are hashed and joined to the lines and
whole unquoted bodies of the conversation's messages; the original is the
earliest message that has the passage, if it is earlier than the quoting one.
A message answers the latest original of its lowest quote level that links.
Messages that answer one another are a thread, named after its first message;
ordered by (thread, turn), each reply follows what it answers.

Defined results: a null text is empty; a message without a link answers nothing
and begins a thread of its own; rows with a null conversation or turn are kept
and never link; rows of the same conversation and turn share their links; blank
lines link with nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import checkpoint

MARKS = r"^(?:[ \t]*>)+"  # fixed value: the quote marks of a line


def level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\r\f]+", " ")))


def parsed(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Messages with their lines' levels and normalised bodies."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    rows = messages.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), lines.alias("lines"))
    rows = rows.withColumn("units", F.transform("lines", lambda x, i: F.struct(
        i.alias("i"), level(x).alias("level"), normal(x).alias("body"), x.alias("raw"))))
    own = F.filter("units", lambda u: u["level"] == 0)
    return (rows.withColumn("text", F.array_join(F.transform(own, lambda u: u["raw"]), "\n"))
            .withColumn("said", F.filter("units", lambda u: u["body"] != "")).drop("lines", "units"))


def whole(said: str, at: Column) -> Column:
    """The passage of a level: its lines as one."""
    return F.array_join(F.transform(F.filter(said, lambda u: u["level"] == at), lambda u: u["body"]), " ")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message row: conversation, ``thread``, turn, role,
    ``reply_to``, ``depth`` (deepest quote level), ``n_quoted`` and ``n_linked``
    lines, and the text without quotes."""
    rows = parsed(messages, conv, turn, role, text)
    quoted_rows = rows.where(F.exists("said", lambda u: u["level"] > 0)).where("conv IS NOT NULL AND turn IS NOT NULL")
    levels = F.array_distinct(F.transform(F.filter("said", lambda u: u["level"] > 0), lambda u: u["level"]))
    quoted = F.concat(
        F.transform(F.filter("said", lambda u: u["level"] > 0), lambda u: F.struct(
            u["level"].alias("level"), u["i"].alias("i"), F.xxhash64(u["body"]).alias("h"))),
        F.transform(levels, lambda n: F.struct(n.alias("level"), (-n).alias("i"), F.xxhash64(whole("said", n)).alias("h"))))
    quoted = quoted_rows.select("conv", "turn", F.explode(F.array_distinct(quoted)).alias("q")).select("conv", "turn", "q.*").distinct()
    quoted = checkpoint(quoted)
    own = F.transform(F.filter("said", lambda u: u["level"] == 0), lambda u: F.xxhash64(u["body"]))
    own = F.array_distinct(F.concat(own, F.array(F.xxhash64(whole("said", F.lit(0))))))
    # only passages that are quoted somewhere; the earliest message that has them
    original = (rows.where("conv IS NOT NULL AND turn IS NOT NULL").where(F.exists("said", lambda u: u["level"] == 0))
                .select("conv", "turn", F.explode(own).alias("h"))
                .join(quoted.select("conv", "h").distinct(), ["conv", "h"], "left_semi")
                .groupBy("conv", "h").agg(F.min("turn").alias("origin")))
    linked = (quoted.join(original, ["conv", "h"]).where("origin < turn")
              .groupBy("conv", "turn", "level").agg(F.max("origin").alias("origin"), F.count_if(F.col("i") >= 0).alias("n_linked"))
              .groupBy("conv", "turn").agg(F.min(F.struct("level", "origin"))["origin"].alias("reply_to"), F.sum("n_linked").alias("n_linked")))
    linked = checkpoint(linked)
    # threads: follow the replies to their beginnings, doubling the steps
    jump = linked.select("conv", "turn", F.col("reply_to").alias("thread"))
    while True:
        up = jump.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        step = checkpoint(jump.join(up, ["conv", "thread"], "left").select(
            "conv", "turn", F.coalesce("above", "thread").alias("thread"), F.col("above").isNotNull().alias("moved")))
        jump = step.select("conv", "turn", "thread")
        if step.where("moved").isEmpty():
            break
    links = linked.join(jump, ["conv", "turn"])
    depth = F.coalesce(F.array_max(F.transform("said", lambda u: u["level"])), F.lit(0))
    n_quoted = F.size(F.filter("said", lambda u: u["level"] > 0)).cast("long")
    return (rows.withColumn("depth", depth).withColumn("n_quoted", n_quoted).join(links, ["conv", "turn"], "left")
            .select(F.col("conv").alias(conv), F.coalesce("thread", "turn").alias("thread"), F.col("turn").alias(turn),
                    F.col("role").alias(role), "reply_to", "depth", "n_quoted",
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), F.col("text").alias(text)))


SQL = r"""
WITH RECURSIVE ln AS (
    SELECT conv_id, turn, role, i, line,
           length(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
           lower(trim(regexp_replace(regexp_replace(line, '^([ \t]*>)+', ''), '[ \t\r\f]+', ' ', 'g'), ' ')) AS body
    FROM (SELECT *, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i
          FROM (SELECT conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations) a) b),
own AS (
    SELECT conv_id, turn, body FROM ln WHERE level = 0 AND body <> ''
    UNION SELECT conv_id, turn, string_agg(body, ' ' ORDER BY i) FROM ln WHERE level = 0 AND body <> '' GROUP BY ALL),
quoted AS (
    SELECT conv_id, turn, level, i, body FROM ln WHERE level > 0 AND body <> ''
    UNION SELECT conv_id, turn, level, -level, string_agg(body, ' ' ORDER BY i) FROM ln WHERE level > 0 AND body <> ''
    GROUP BY conv_id, turn, level),
origin AS (SELECT conv_id, body, min(turn) AS origin FROM own GROUP BY conv_id, body),
per_level AS (
    SELECT conv_id, turn, level, max(origin) AS origin, count(*) FILTER (WHERE i >= 0) AS n
    FROM quoted JOIN origin USING (conv_id, body) WHERE origin < turn GROUP BY ALL),
linked AS (
    SELECT conv_id, turn, arg_min(origin, level) AS reply_to, sum(n) AS n_linked FROM per_level GROUP BY conv_id, turn),
up AS (
    SELECT conv_id, turn, reply_to AS thread FROM linked
    UNION SELECT up.conv_id, up.turn, linked.reply_to FROM up JOIN linked ON linked.conv_id = up.conv_id AND linked.turn = up.thread)
SELECT conv_id, coalesce(min(t.thread), turn) AS thread, turn, role, any_value(reply_to) AS reply_to,
       any_value(depth) AS depth, any_value(n_quoted) AS n_quoted,
       coalesce(any_value(n_linked), 0)::BIGINT AS n_linked, any_value(kept) AS text
FROM (SELECT conv_id, turn, role, coalesce(max(level) FILTER (WHERE body <> ''), 0)::INT AS depth,
             count(*) FILTER (WHERE level > 0 AND body <> '') AS n_quoted,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0), '') AS kept
      FROM ln GROUP BY conv_id, turn, role) m
LEFT JOIN linked USING (conv_id, turn) LEFT JOIN up t USING (conv_id, turn)
GROUP BY conv_id, turn, role
"""
