"""Chat formatting by quotation linking (operator 1).

Lines that begin with quote marks belong to an earlier message: one ``>`` per
level.  A message is parsed into passages, runs of lines of one level; a
passage's normal form (white space collapsed, lower case) is hashed.  Quoted
passages are joined by two hashes to the messages of the same conversation whose
own text holds them; a passage's source is the latest such message before the
quoting one, which is the one that a reply most likely answers.  The parent of a message is the source of its
shallowest quoted passage (of several, the latest source).  Following parents
to the top gives each message its thread; a conversation in reply order lists
its threads by their first message and, in a thread, messages by turn, so that
a message always follows the one it answers.  The text that remains has no
quotes.

A quote may hold a whole message, or some of its paragraphs or lines, so a
message offers its own text, its own passages (what it says between quotes), the
paragraphs in them and their lines.  A quoted passage that no earlier message
offers as a whole is taken apart: its source is, by the same rule, the latest
earlier message that offers each of its paragraphs, whole or line by line.  Such
messages are found by stepping back: the bound on a passage's source falls to the last message
before it that can still hold all, until it stays, in as many rounds as the
pieces of a passage lead to different messages.

Cases: a null text has no passages and an empty remaining text; a message with
quotes only remains with an empty text; a quote with no source makes no link;
texts of any length are taken whole; a message can't answer itself or a later
one; equal rows (conversation, turn) that say the same are one message, those
that differ in text are ordered by role and text; null conversation and turn are
values like any other, a null turn comes first; an empty table gives no rows;
extra columns do not clash, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, dealt_join, key_join, let, numbered
from strata.operators.rank import global_row_number

BLANKS = " \t\r\n"
MARKS = r"^[ \t]*>[ \t>]*"

ID = ["conv_id", "turn", "role", "text"]


def level(line: Column) -> Column:
    """Number of quote marks that a line begins with."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passages(text: Column) -> Column:
    """Array of (level, text) in order; blank lines do not end a quote's level."""
    marked = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("line")),
    )

    def runs(lines: Column) -> Column:
        def begins(i: Column) -> Column:
            return (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"])

        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), begins)

        def run(a: Column, end: Column) -> Column:
            own = F.transform(F.slice(lines, a + 1, end - a), lambda x: x["line"])
            return F.struct(F.get(lines, a)["level"].alias("level"), F.concat_ws("\n", own).alias("text"))

        return let(starts, lambda s: F.transform(s, lambda a, k: run(a, F.coalesce(F.get(s, k + 1), F.size(lines)))))

    return let(marked, runs)


def own_text(parsed: Column) -> Column:
    """What remains without quotes."""
    kept = F.transform(F.filter(parsed, lambda p: p["level"] == 0), lambda p: F.btrim(p["text"], F.lit(BLANKS)))
    return F.concat_ws("\n", F.filter(kept, lambda t: t != ""))


def _paragraphs(text: Column) -> Column:
    return F.split(text, r"\n[ \t]*\n")


def _offers(parsed: Column) -> Column:
    """Normal forms of the own text, the own passages, their paragraphs and lines."""

    def parts(text: Column) -> Column:
        return F.concat(F.array(text), _paragraphs(text), F.split(text, "\n"))

    passages = F.flatten(F.transform(F.filter(parsed, lambda p: p["level"] == 0), lambda p: parts(p["text"])))
    both = F.concat(let(own_text(parsed), parts), passages)
    return F.array_distinct(F.filter(F.transform(both, normal), lambda t: t != ""))


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, message (its number in the conversation), parsed."""
    rows = messages.select(*ID).distinct()
    ordered = numbered(rows, ["conv_id", "turn"], ["role", "text"], "tie")
    return cut(ordered.withColumn("parsed", passages(F.col("text"))))


KEY = ["conv_id", "turn", "tie"]


def _at() -> Column:
    return F.struct("turn", "tie")


HASHES = ["hash_1", "hash_2"]


def _hashes(form: Column) -> list[Column]:
    return [F.xxhash64(form).alias("hash_1"), F.xxhash64(F.lit(1), form).alias("hash_2")]


PASSAGE = ["conv_id", *HASHES]

# Messages of a conversation whose holders of one piece are looked through together.
RANGE = 4_096


def _latest(holders: DataFrame, probes: DataFrame) -> DataFrame:
    """PASSAGE, bound, found: the last message up to ``bound`` that holds the
    piece, -1 for none.  A piece held by many messages is split by their numbers."""
    asked = probes.select(*PASSAGE, F.col("bound").alias("no"), F.lit(False).alias("holds")).distinct()
    rows = holders.select(*PASSAGE, "no", F.lit(True).alias("holds")).unionByName(asked)
    rows = rows.withColumn("range", F.floor(F.col("no") / RANGE))
    held = F.max(F.when(F.col("holds"), F.col("no")))
    upto = Window.partitionBy(*PASSAGE, "range").orderBy("no").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tops = rows.groupBy(*PASSAGE, "range").agg(held.alias("top"))
    ahead = Window.partitionBy(*PASSAGE).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("before", F.max("top").over(ahead)).drop("top")
    near = rows.withColumn("near", held.over(upto)).filter(~F.col("holds"))
    found = key_join(near, tops, [*PASSAGE, "range"])
    return found.select(*PASSAGE, F.col("no").alias("bound"), F.coalesce("near", "before", F.lit(-1).cast("long")).alias("found"))


def _holders(offered: DataFrame, wanted: DataFrame, numbers: DataFrame) -> DataFrame:
    """PASSAGE, no: the messages that offer a passage of ``wanted``."""
    held = dealt_join(offered, wanted.select(*PASSAGE).distinct(), PASSAGE, ["turn", "tie"])
    return cut(key_join(held, numbers, KEY).select(*PASSAGE, "no"))


def _in_parts(parsed: DataFrame, offered: DataFrame, missed: DataFrame, numbers: DataFrame) -> DataFrame:
    """KEY, level, source of the passages ``missed`` (KEY, place) whose pieces
    one earlier message offers."""
    texts = parsed.select(*KEY, F.posexplode("parsed").alias("place", "passage"))
    texts = key_join(key_join(texts, missed, [*KEY, "place"]), numbers, KEY)
    texts = texts.select("conv_id", "no", "place", "passage.level", F.posexplode(_paragraphs(F.col("passage.text"))).alias("paragraph", "text"))
    kinds = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("text"))),
        F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text"))),
    )
    own = ["no", "place", "level"]
    pieces = texts.select("conv_id", *own, "paragraph", F.explode(kinds).alias("x"))
    pieces = pieces.select("conv_id", *own, "paragraph", "x.whole", normal(F.col("x.text")).alias("form")).filter(F.col("form") != "")
    pieces = cut(pieces.select("conv_id", *own, "paragraph", "whole", *_hashes(F.col("form"))).distinct())
    holders = _holders(offered, pieces, numbers)
    state = cut(pieces.select(*own).distinct().withColumns({"bound": F.col("no") - 1, "moves": F.lit(True)}))
    while not state.filter("moves").isEmpty():
        probes = key_join(pieces, state.filter("moves").drop("moves"), own)
        found = dealt_join(probes, _latest(holders, probes), [*PASSAGE, "bound"], ["no", "place"])
        lines, whole = F.min(F.when(~F.col("whole"), F.col("found"))), F.max(F.when(F.col("whole"), F.col("found")))
        found = found.groupBy(*own, "paragraph", "bound").agg(F.greatest(lines, whole).alias("found"))
        found = found.groupBy(*own, "bound").agg(F.min("found").alias("found"))
        moved = found.select(*own, F.col("found").alias("bound"), ((F.col("found") >= 0) & (F.col("found") < F.col("bound"))).alias("moves"))
        state = cut(state.filter("NOT moves").unionByName(moved))
    hits = key_join(state.filter("bound >= 0").drop("moves"), numbers, ["no"])
    return _named(hits.withColumnRenamed("bound", "found"), numbers).select(*KEY, "level", "source")


def _named(hits: DataFrame, numbers: DataFrame) -> DataFrame:
    """``hits`` with the source (turn, tie) of the message that each has ``found``."""
    source = numbers.select(F.col("no").alias("found"), _at().alias("source"))
    return dealt_join(hits, source, ["found"], ["no"])


def parents(parsed: DataFrame) -> DataFrame:
    """KEY, source (turn, tie), level, for every message with a source."""
    # Numbered over all conversations: a message's source has a smaller number.
    numbers = cut(global_row_number(parsed.select(*KEY), KEY, "no"))
    quoted = parsed.select(*KEY, F.posexplode("parsed").alias("place", "passage")).filter(F.col("passage.level") > 0)
    quoted = quoted.select(*KEY, "place", F.col("passage.level").alias("level"), normal(F.col("passage.text")).alias("form"))
    quoted = quoted.filter(F.col("form") != "").select(*KEY, "place", "level", *_hashes(F.col("form")))
    quoted = cut(key_join(quoted, numbers, KEY).withColumn("bound", F.col("no") - 1))
    offered = parsed.select(*KEY, F.explode(_offers(F.col("parsed"))).alias("form"))
    offered = offered.select(*KEY, *_hashes(F.col("form")))
    nearest = _latest(_holders(offered, quoted, numbers), quoted)
    tried = cut(dealt_join(quoted, nearest, [*PASSAGE, "bound"], ["no", "place"]))
    found = _named(tried.filter("found >= 0"), numbers).select(*KEY, "level", "source")
    missed = tried.filter("found < 0").select(*KEY, "place")
    if not missed.isEmpty():
        found = found.unionByName(_in_parts(parsed, offered, missed, numbers))
    best = F.min(F.struct("level", (-F.col("source.turn")).alias("late"), (-F.col("source.tie")).alias("later"), "source"))
    return found.groupBy(*KEY).agg(best.alias("best")).select(*KEY, "best.source", "best.level")


def threads(parsed: DataFrame, linked: DataFrame) -> DataFrame:
    """KEY, root (turn, tie), depth of every message.

    Each round every message that does not hang on a root yet takes over the
    parent of its parent, so a chain of n answers needs log2 n rounds, and
    short threads leave the rounds early.
    """
    start = key_join(parsed.select(*KEY), linked.select(*KEY, "source"), KEY, "left")
    answer = F.col("source").isNotNull()
    state = cut(start.select(*KEY, F.coalesce("source", _at()).alias("up"), answer.cast("long").alias("depth"), answer.alias("moves")))
    while not state.filter("moves").isEmpty():
        above = state.select("conv_id", _at().alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = dealt_join(state.filter("moves").drop("moves"), above, ["conv_id", "up"], ["turn", "tie"])
        # A message whose parent is a root adds 0 and stays there.
        moved = moved.select(*KEY, F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moves"))
        state = cut(state.filter("NOT moves").unionByName(moved))
    return state.drop("moves").withColumnRenamed("up", "root")


def link(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position (reply order, from 0), turn, role,
    text (without quotes), parent_turn, quote_level, thread_turn, depth."""
    parsed = parse(messages)
    linked = cut(parents(parsed))
    placed = threads(parsed, linked)
    rows = key_join(parsed, linked.withColumnRenamed("level", "quote_level"), KEY, "left")
    rows = key_join(rows, placed, KEY).select(*KEY, "role", "source", "quote_level", "root", "depth", own_text(F.col("parsed")).alias("own"))
    # Numbered over all conversations at once: a long one is split over tasks.
    order = ["conv_id", "root", "turn", "tie"]
    rows = cut(global_row_number(rows, order, "no"))
    first = cut(rows.groupBy("conv_id").agg(F.min("no").alias("first_no")))
    return dealt_join(rows, first, ["conv_id"], ["no"]).select(
        "conv_id",
        (F.col("no") - F.col("first_no")).alias("position"),
        "turn",
        "role",
        F.col("own").alias("text"),
        F.col("source.turn").alias("parent_turn"),
        "quote_level",
        F.col("root.turn").alias("thread_turn"),
        "depth",
    )


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn under its own text quotes the message it
    answers, and below that the message that one answered, a level deeper.

    Turn 2, 5, 8... answers two turns up, the others one.
    """
    own = conversations.select(*ID).withColumn("text", F.coalesce("text", F.lit("")))
    answers = lambda t: F.when(t % 3 == 2, t - 2).otherwise(t - 1)
    first = answers(F.col("turn"))
    rows = own.withColumns({"one": first, "two": answers(first)})
    told = own.groupBy("conv_id", "turn").agg(F.min("text").alias("told"))

    def marked(text: Column, marks: str) -> Column:
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))

    for name, marks in (("one", "> "), ("two", "> > ")):
        rows = key_join(rows, told.select("conv_id", F.col("turn").alias(name), F.col("told").alias(f"{name}_told")), ["conv_id", name], "left")
        rows = rows.withColumn(f"{name}_told", marked(F.col(f"{name}_told"), marks))
    return rows.select("conv_id", "turn", "role", F.concat_ws("\n", "text", "one_told", "two_told").alias("text"))
