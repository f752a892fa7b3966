"""Conversations ordered by reply, with quotations linked and taken out; SQL functions only.

The lines of a message have a quote level, the number of ``>`` they begin with. Lines of one level
without a blank line between them are a passage. Passages are normalised (letters and digits, lower
case) and hashed. A quoted passage is joined to the first message of its conversation that holds
the passage in its own words, if that is an earlier one; at the first level the message quoted most
(of several the latest) is what the message replies to, deeper levels give further links. Without
a linked quotation a message replies to the one with the turn number before its own.

A message that is the first reply to another continues its thread, other replies start threads of
their own; thread, by the turn of its first message, and position in it order a conversation so
that replies follow what they answer. Threads are found by pointer doubling: no conversation is
gathered in one task, however long it is.

Quoted lines and the line that introduces them (ending in ``wrote:``) do not stay in the text.
Null texts are empty and link nothing. Rows with a null conversation or turn reply to nothing and
are threads of their own. Rows with one conversation and turn are one message: of several parents
the latest counts, and each row is returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packwright.llm.components import stored

_QUOTE = r"^(([ \t]*>)+)"
_KEY = ["conv", "turn"]


def level(line: Column) -> Column:
    """How many quote signs a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _QUOTE, 1), "[^>]", ""))


def lines(text: Column) -> Column:
    """The lines of a text; null is empty."""
    return F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), "\n")


def unquoted(text: Column) -> Column:
    """A text without quoted lines and what introduces them."""
    all_lines = lines(text)

    def own(line, i):
        introduces = line.rlike(r"wrote:[ \t]*$") & (level(F.get(all_lines, i + 1)) > 0)
        return (level(line) == 0) & ~F.coalesce(introduces, F.lit(False))

    return F.regexp_replace(F.array_join(F.filter(all_lines, own), "\n"), r"^[ \t\n]+|[ \t\n]+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """``(conv, turn, level, code)``: every passage of every message, by the hash of its words; repeated rows count once."""
    distinct = messages.withColumn("mark", F.xxhash64("text")).dropDuplicates([*_KEY, "mark"])
    each = distinct.select(*_KEY, "mark", F.posexplode(lines(F.col("text"))).alias("at", "line"))
    each = each.withColumn("level", level(F.col("line"))).withColumn("line", F.regexp_replace(F.regexp_replace("line", _QUOTE, ""), r"^[ \t]+|[ \t]+$", ""))
    order = Window.partitionBy(*_KEY, "mark").orderBy("at")
    breaks = (F.col("level") != F.lag("level").over(order)) | (F.lag("line").over(order) == "")
    each = each.withColumn("run", F.sum(F.when(breaks, 1).otherwise(0)).over(order))
    whole = each.groupBy(*_KEY, "mark", "run", "level").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), " ").alias("words"))
    plain = F.trim(F.regexp_replace(F.lower("words"), r"[^\p{L}\p{N}]+", " "))
    return whole.select(*_KEY, "level", plain.alias("words")).where("words != ''").select(*_KEY, "level", F.xxhash64("words").alias("code"))


def quote_links(messages: DataFrame) -> DataFrame:
    """``(conv, turn, level, code, origin)``: quoted passages with the turn they come from."""
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>"))
    talks = quoting.select("conv").distinct()
    found = passages(messages.join(talks, "conv", "left_semi"))
    origins = found.where("level = 0").groupBy("conv", "code").agg(F.min("turn").alias("origin"))
    quoted = found.where("level > 0").groupBy(*_KEY, "level", "code").agg(F.count("*").alias("times"))
    return quoted.join(origins, ["conv", "code"]).where("origin < turn").select(*_KEY, "level", "code", "times", "origin")


def _threads(parents: DataFrame) -> DataFrame:
    """``(conv, turn, parent, thread, position)`` from ``(conv, turn, parent)``.

    Every message that goes on a thread points at one before it in the thread, at first at its
    parent; each round doubles the distance, for those that do not point at the first one yet.
    """
    eldest = parents.where("parent is not null").groupBy("conv", "parent").agg(F.min("turn").alias("turn"))
    eldest = eldest.select("conv", "turn", F.lit(True).alias("goes_on"))
    steps = stored(parents.join(eldest, _KEY, "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False))))
    firsts = steps.where("not goes_on").select("conv", F.col("turn").alias("thread"), F.lit(True).alias("done"))
    going = steps.where("goes_on").select(*_KEY, "parent", F.col("parent").alias("thread"), F.lit(1).cast("bigint").alias("position"))
    going = stored(going.join(firsts, ["conv", "thread"], "left").select(*_KEY, "parent", "thread", "position", F.coalesce("done", F.lit(False)).alias("done")))
    while not (open_ := going.where("not done").drop("done")).isEmpty():
        ahead = going.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("position").alias("more"), "done")
        moved = open_.join(ahead, ["conv", "thread"])
        moved = moved.select(*_KEY, "parent", F.col("next").alias("thread"), (F.col("position") + F.col("more")).alias("position"), "done")
        going = stored(going.where("done").unionByName(moved))
    alone = steps.where("not goes_on").select(*_KEY, "parent", F.col("turn").alias("thread"), F.lit(0).cast("bigint").alias("position"))
    return alone.unionByName(going.drop("done"))


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for every message, in reply order by ``thread`` and ``position``.

    ``(conv_id, turn, role, reply_to, thread, position, n_quotes, text, formatted)``: ``text`` has
    no quotations, ``formatted`` wraps it in markers of the role; ``n_quotes`` counts linked passages.
    """
    messages = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    keyed = messages.where("conv is not null and turn is not null")
    links = stored(quote_links(keyed))
    votes = links.where("level = 1").groupBy(*_KEY, "origin").agg(F.sum("times").alias("votes"))
    replies = votes.groupBy(*_KEY).agg(F.max(F.struct("votes", "origin"))["origin"].alias("quoted"))
    quotes = links.groupBy(*_KEY).agg(F.sum("times").alias("n_quotes"))
    turns = keyed.select(*_KEY).distinct()
    before = turns.select("conv", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("before"))
    parents = turns.join(before, _KEY, "left").join(replies, _KEY, "left").select(*_KEY, F.coalesce("quoted", "before").alias("parent"))
    placed = messages.join(_threads(parents), _KEY, "left").join(quotes, _KEY, "left")
    placed = placed.withColumn("text", unquoted(F.col("text")))
    return placed.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.col("parent").alias("reply_to"),
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("position", F.lit(0)).alias("position"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.col("text").alias(text_col),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "text", F.lit("<|end|>\n")).alias("formatted"),
    )


#: DuckDB SQL for :func:`conversations` over the table ``conversations``; unlike it, the SQL loses links of repeated rows.
SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn::BIGINT AS turn, role, text, string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)) AS ls FROM conversations),
e AS (SELECT conv_id, turn, md5(coalesce(text, '')) AS mark, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM m)),
l AS (
  SELECT conv_id, turn, mark, i, length(regexp_replace(regexp_extract(line, '^(([ \t]*>)+)', 1), '[^>]', '', 'g')) AS level,
    regexp_replace(regexp_replace(line, '^(([ \t]*>)+)', ''), '^[ \t]+|[ \t]+$', '', 'g') AS line FROM e),
b AS (
  SELECT *, CASE WHEN level != lag(level) OVER w OR lag(line) OVER w = '' THEN 1 ELSE 0 END AS brk FROM l
  WINDOW w AS (PARTITION BY conv_id, turn, mark ORDER BY i)),
r AS (SELECT *, sum(brk) OVER (PARTITION BY conv_id, turn, mark ORDER BY i) AS run FROM b),
p AS (
  SELECT * FROM (
    SELECT conv_id, turn, level, trim(regexp_replace(lower(string_agg(line, ' ' ORDER BY i)), '[^\p{L}\p{N}]+', ' ', 'g')) AS words
    FROM r GROUP BY conv_id, turn, mark, run, level) WHERE words != ''),
o AS (SELECT conv_id, words, min(turn) AS origin FROM p WHERE level = 0 GROUP BY ALL),
k AS (SELECT p.conv_id, p.turn, p.level, origin, count(*) AS times FROM p JOIN o USING (conv_id, words) WHERE p.level > 0 AND origin < p.turn GROUP BY ALL),
v AS (SELECT conv_id, turn, origin, sum(times) AS votes FROM k WHERE level = 1 GROUP BY ALL),
q AS (SELECT conv_id, turn, origin AS quoted FROM v QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY votes DESC, origin DESC) = 1),
n AS (SELECT conv_id, turn, sum(times)::BIGINT AS n_quotes FROM k GROUP BY ALL),
t AS (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (
  SELECT t.conv_id, t.turn, coalesce(quoted, z.turn) AS parent FROM t LEFT JOIN q USING (conv_id, turn)
  LEFT JOIN t z ON z.conv_id = t.conv_id AND z.turn = t.turn - 1),
f AS (SELECT *, parent IS NOT NULL AND turn = min(turn) OVER (PARTITION BY conv_id, parent) AS goes_on FROM a),
h AS (
  SELECT conv_id, turn, parent, turn AS thread, 0::BIGINT AS position FROM f WHERE NOT goes_on
  UNION ALL SELECT f.conv_id, f.turn, f.parent, h.thread, h.position + 1 FROM f JOIN h ON f.conv_id = h.conv_id AND f.parent = h.turn AND f.goes_on),
c AS (
  SELECT conv_id, turn, role, regexp_replace(array_to_string([ls[i] FOR i IN range(1, len(ls) + 1)
    IF length(regexp_replace(regexp_extract(ls[i], '^(([ \t]*>)+)', 1), '[^>]', '', 'g')) = 0
    AND NOT (regexp_matches(ls[i], 'wrote:[ \t]*$') AND i < len(ls) AND length(regexp_extract(ls[i + 1], '^(([ \t]*>)+)', 1)) > 0)], chr(10)),
    '^[ \t\n]+|[ \t\n]+$', '', 'g') AS text FROM m)
SELECT c.conv_id, c.turn, c.role, h.parent AS reply_to, coalesce(h.thread, c.turn) AS thread, coalesce(h.position, 0) AS position,
  coalesce(n.n_quotes, 0) AS n_quotes, c.text, '<|' || coalesce(c.role, 'unknown') || '|>' || chr(10) || c.text || '<|end|>' || chr(10) AS formatted
FROM c LEFT JOIN h USING (conv_id, turn) LEFT JOIN n USING (conv_id, turn)"""
