r"""Quotation linking: replies are joined to the messages that they quote.

A line whose start matches ``([ \t]*>)+`` is quoted; the number of ``>`` is
its level, however deep.  The passages of a level are its lines and its paragraphs (lines
between blank lines or lines of other levels, joined by a space), normalised
(lower case, white space made one space, trimmed) and hashed.  A passage that
equals a line or paragraph of the body of an earlier message of the same
conversation refers to that message, the latest where there are several.  A
message replies to the message that its outermost linked level quotes most
(ties: the latest).  Bodies are what is left without quoted lines and without
a line such as "On ..., X wrote:" before a quote.

Messages that quote nothing known start a thread of their own.  The result is
ordered by conversation, first turn of the thread, turn: a reply stands after
what it answers, and threads stay together.  Nothing is collected by
conversation, so one with a third of all messages is spread like any other.

Null texts are empty bodies; null roles stay null.  A text of any length or
depth of quotes is read in one pass, in the memory of its row.  Messages of a null
conversation form one conversation, null turns sort first and are neither
quoted nor linked.  Repeated rows each get their row.  Extra columns are
ignored, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

QUOTED = r"^[ \t>]*>"
ATTRIBUTION = r"(?i)(?:wrote|writes|schrieb|a écrit|escribió)[ \t]*:[ \t]*$"
#: Turns of one conversation are looked up in ranges of so many.
TURNS = 512


def _lines(text: Column) -> Column:
    """Lines as (level, body), attribution lines before a quote with level -1."""
    marked = F.transform(
        F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, QUOTED, 0), "[ \t]", "")).alias("level"), F.regexp_replace(x, QUOTED, "").alias("body")
        ),
    )
    return F.transform(
        F.array(marked),
        lambda m: F.transform(
            m,
            lambda x, i: F.when(
                (x["level"] == 0) & (i < F.size(m) - 1) & (m[F.least(i + 1, F.size(m) - 1)]["level"] > 0) & x["body"].rlike(ATTRIBUTION),
                F.struct(F.lit(-1).alias("level"), x["body"].alias("body")),
            ).otherwise(x),
        ),
    )[0]


def _body(lines: Column) -> Column:
    kept = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["body"])
    return F.btrim(F.array_join(kept, "\n"), F.lit(" \t\n\x0b\x0c\r"))


def _units(text: Column) -> Column:
    """Hashes of the normalised lines and paragraphs of a text."""
    spread = F.split(text, r"\n[ \t]*(?:\n[ \t]*)+")
    parts = F.concat(spread, F.split(text, "\n"))
    tidy = F.transform(parts, lambda x: F.lower(F.btrim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " "))))
    return F.transform(F.array_distinct(F.filter(tidy, lambda x: x != "")), lambda x: F.md5(x))


def _quoted_units(lines: Column) -> Column:
    """(level, hash) of the passages of each quote level: those of the runs of
    lines of one level, so work grows with the lines, whatever their levels."""
    n = F.size(lines)
    level = lambda i: F.get(lines, i)["level"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))
    runs = F.zip_with(starts, F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(n)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    quoted = F.filter(F.filter(runs, lambda r: r["b"].isNotNull()), lambda r: level(r["a"]) > 0)
    return F.array_distinct(
        F.flatten(
            F.transform(
                quoted,
                lambda r: F.transform(
                    _units(F.array_join(F.transform(F.slice(lines, r["a"] + 1, r["b"] - r["a"]), lambda x: x["body"]), "\n")),
                    lambda h: F.struct(level(r["a"]).alias("level"), h.alias("hash")),
                ),
            )
        )
    )


def _latest_before(quotes: DataFrame, originals: DataFrame, scratch: Scratch) -> DataFrame:
    """Each quoted passage with ``orig``, the latest earlier turn that has it.

    An as-of join by union and running maximum.  Turns are cut into ranges;
    the maximum runs within a range, and what earlier ranges end with is
    carried over, so a passage that a huge conversation repeats in every
    message is spread and no pairs are made.
    """
    both = (
        originals.select("conv", "hash", "turn", F.lit(None).cast("string").alias("msg"), F.lit(None).cast("int").alias("level"), F.col("turn").alias("at"))
        .unionByName(quotes.select("conv", "hash", "turn", "msg", "level", F.lit(None).cast("long").alias("at")))
        .withColumn("range", F.floor(F.col("turn") / TURNS))
    )
    both = scratch.save(both, "passages")
    ends = both.groupBy("conv", "hash", "range").agg(F.max("at").alias("end"))
    earlier = Window.partitionBy("conv", "hash").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("conv", "hash", "range", F.max("end").over(earlier).alias("before"))
    inside = Window.partitionBy("conv", "hash", "range").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("inside", F.max("at").over(inside)).filter("msg IS NOT NULL").join(ends, ["conv", "hash", "range"])
    return found.select("conv", "msg", "turn", "level", "hash", F.coalesce("inside", "before").alias("orig"))


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, root) of every linked turn, by pointer doubling: rounds
    grow with the logarithm of the longest chain of replies."""
    step, at = links.select("conv", "turn", F.col("parent").alias("root")), 0
    while True:
        up = step.select(F.col("conv").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("root").alias("up"))
        wide = step.join(up, (F.col("conv") == F.col("u_conv")) & (F.col("root") == F.col("u_turn")), "left")
        wide = scratch.save(wide.select("conv", "turn", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), f"roots{at}")
        more = wide.filter("moved").limit(1).count()
        if at:
            scratch.drop(f"roots{at - 1}")
        step, at = wide.select("conv", "turn", "root"), at + 1
        if not more:
            return step


def link(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conversation, turn, role, ``text`` (its body),
    ``reply_to`` (a turn or null), ``thread`` (the first turn of its thread),
    ``n_passages`` quoted and ``n_linked`` of them, sorted in reply order.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "chat")
    lines = messages.select(
        F.col(conversation).alias("c"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("whole"), F.inline(F.array(F.struct(_lines(F.col(text)).alias("lines")))),
    )
    parsed = lines.select("c", F.coalesce(F.concat(F.lit("="), F.col("c").cast("string")), F.lit("")).alias("conv"), "turn", "role", F.md5("whole").alias("msg"), _body(F.col("lines")).alias("body"),
                          F.when(F.exists("lines", lambda x: x["level"] > 0), F.col("lines")).alias("lines"))
    parsed = scratch.save(parsed, "parsed")
    quoting = parsed.filter(F.col("lines").isNotNull() & F.col("turn").isNotNull()).dropDuplicates(["conv", "turn", "msg"])
    quotes = quoting.select("conv", "turn", "msg", F.inline(_quoted_units(F.col("lines"))))
    # only conversations that quote need their bodies hashed
    asked = quoting.select("conv").distinct()
    bodies = parsed.filter(F.col("turn").isNotNull()).join(asked, "conv", "left_semi")
    originals = bodies.select("conv", "turn", F.explode(_units(F.col("body"))).alias("hash")).distinct()
    found = scratch.save(_latest_before(quotes, originals, scratch), "found")
    votes = found.groupBy("conv", "turn", "msg", "level", "orig").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("orig").isNotNull()
    reply = votes.groupBy("conv", "turn", "msg").agg(
        F.max_by("orig", F.when(known, F.struct(-F.col("level"), F.col("n"), F.col("orig")))).alias("reply_to"),
        F.sum("n").alias("n_passages"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_linked"),
    )
    reply = scratch.save(reply, "replies")
    links = reply.filter("reply_to IS NOT NULL").groupBy("conv", "turn").agg(F.min("reply_to").alias("parent"))
    roots = _roots(links, scratch).select("conv", F.col("turn").alias("reply_to"), F.col("root").alias("up"))
    reply = reply.join(roots, ["conv", "reply_to"], "left").withColumn("root", F.coalesce("up", "reply_to"))
    out = parsed.join(reply.drop("up"), ["conv", "turn", "msg"], "left").select(
        F.col("c").alias(conversation), "turn", "role", F.col("body").alias("text"), "reply_to", F.coalesce("root", "turn").alias("thread"),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    return out.orderBy(conversation, "thread", "turn", "text")


def oracle(table: str = "conversations") -> str:
    """The same in DuckDB's SQL."""

    def units(text: str) -> str:
        tidy = "lower(trim(regexp_replace(x, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '))"
        parts = f"list_concat(regexp_split_to_array({text}, '\\n[ \\t]*(?:\\n[ \\t]*)+'), string_split({text}, chr(10)))"
        return f"list_distinct(list_filter(list_transform({parts}, lambda x: {tidy}), lambda x: x <> ''))"

    return f"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rn, conv_id, coalesce('=' || conv_id, '') AS conv, turn::BIGINT AS turn, role, md5(coalesce(text, '')) AS msg,
  string_split(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), chr(10)) AS ls FROM {table}),
x AS (SELECT rn, i, ls[i] AS line FROM (SELECT rn, ls, unnest(range(1, len(ls) + 1)) AS i FROM m)),
p AS (SELECT rn, i, length(regexp_replace(regexp_extract(line, '{QUOTED}'), '[ \\t]', '', 'g')) AS level, regexp_replace(line, '{QUOTED}', '') AS body FROM x),
q AS (SELECT rn, i, body, CASE WHEN level = 0 AND lead(level) OVER (PARTITION BY rn ORDER BY i) > 0 AND regexp_matches(body, '{ATTRIBUTION}') THEN -1 ELSE level END AS level FROM p),
b AS (SELECT rn, trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (WHERE level = 0), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, max(level) AS top FROM q GROUP BY rn),
msgs AS (SELECT DISTINCT conv, turn, msg, first(rn) OVER (PARTITION BY conv, turn, msg ORDER BY rn) AS rn FROM m WHERE turn IS NOT NULL),
levels AS (SELECT s.conv, s.turn, s.msg, s.rn, unnest(range(1, b.top + 1)) AS level FROM msgs s JOIN b USING (rn) WHERE b.top > 0),
quoted AS (SELECT v.conv, v.turn, v.msg, v.level, string_agg(CASE WHEN q.level = v.level THEN q.body ELSE '' END, chr(10) ORDER BY q.i) AS t FROM levels v JOIN q USING (rn) GROUP BY ALL),
passages AS (SELECT conv, turn, msg, level, unnest({units("t")}) AS u FROM quoted),
originals AS (SELECT DISTINCT m.conv, m.turn, unnest({units("b.body")}) AS u FROM m JOIN b USING (rn) WHERE m.turn IS NOT NULL),
found AS (SELECT p.conv, p.turn, p.msg, p.level, p.u, max(o.turn) AS orig FROM passages p LEFT JOIN originals o ON o.conv = p.conv AND o.u = p.u AND o.turn < p.turn GROUP BY ALL),
votes AS (SELECT conv, turn, msg, level, orig, count(*) AS n FROM found GROUP BY ALL),
reply AS (SELECT conv, turn, msg, first(orig ORDER BY level, n DESC, orig DESC) FILTER (WHERE orig IS NOT NULL) AS reply_to, sum(n)::BIGINT AS n_passages,
  coalesce(sum(n) FILTER (WHERE orig IS NOT NULL), 0)::BIGINT AS n_linked FROM votes GROUP BY ALL),
links AS (SELECT conv, turn, min(reply_to) AS parent FROM reply WHERE reply_to IS NOT NULL GROUP BY ALL),
up AS (SELECT conv, turn, parent AS place FROM links UNION ALL SELECT up.conv, up.turn, l.parent FROM up JOIN links l ON l.conv = up.conv AND l.turn = up.place),
roots AS (SELECT conv, turn, min(place) AS root FROM up GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, b.body AS text, r.reply_to, coalesce(o.root, r.reply_to, m.turn) AS thread, coalesce(r.n_passages, 0)::BIGINT AS n_passages, coalesce(r.n_linked, 0)::BIGINT AS n_linked
FROM m JOIN b USING (rn) LEFT JOIN reply r ON r.conv = m.conv AND r.turn = m.turn AND r.msg = m.msg LEFT JOIN roots o ON o.conv = r.conv AND o.turn = r.reply_to"""
