"""Quality rules by cross-document line frequency (operator 3).

Base rules look at one text: words, symbols, repeated lines, repeated 5-word
windows.  The cross-document rule hashes the normalised lines (lower case,
white space collapsed), counts for each host the distinct documents that hold a
line, removes lines above the host's limit and rejects documents of which too
little is left.  Copies of one text on a host are one document, whatever their
ids: otherwise a text would be rejected for being copied.

The limit of a host is ``MAX_SHARE`` of its documents, ``MIN_TEXTS`` at least and
``MAX_TEXTS`` at most, so that on a very large host, too, a line in more
documents than that goes.  Everything is counted over all rows; only DataFrame
functions are used.  Counts are aggregated before each shuffle, joins on
(host, line) are salted.

Cases: a null text has no words and no lines, like an empty one; a null host
is a host of its own; texts of any length are taken whole; equal rows get equal
results; an empty table gives no rows; a line equal to another in one document
is removed wherever it stands; a line that stands in exactly the limit's number
of documents stays, and a document with exactly the least share of words is kept; columns of the table keep their names, the
added ones replace columns of the same name in ``judge`` and are left out in
``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, key_join, let, salted_join

# White space of the word rule, and the separator pattern.
BLANKS = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

MIN_TEXTS = 20
MAX_TEXTS = 10_000
MAX_SHARE = 0.02
MIN_KEPT_PERCENT = 40


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) != ""


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur at least twice."""

    def covered(windows: Column) -> Column:
        """From the sorted places of repeated windows: each adds up to 5 words."""
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            def twin(x: Column, j: Column) -> Column:
                before, after = F.get(s, j - 1)["h"], F.get(s, j + 1)["h"]
                return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == after, F.lit(False))

            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, n: a + n)

        return let(let(placed, places), total)

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(windows))

    def windows_of(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    several = let(hashed, lambda h: let(windows_of(h), counted))
    return F.when(F.size(words) > WINDOW, several).otherwise(F.lit(0).cast("long"))


def base_rules(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    packed = text
    for blank in BLANKS:
        packed = F.replace(packed, F.lit(blank), F.lit(""))
    lines = F.filter(F.split(text, "\n"), has_word)
    repeats = let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own)))
    counts = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )
    return F.struct(
        counts.alias("counts"),
        F.length(packed).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        repeats.cast("long").alias("n_dup_lines"),
    )


def normal_line(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), GAP, " "))


KEY = ["id", "text_1", "text_2", "host"]


def _keyed(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """id, two hashes of the text, host, text: rows alike in these are one."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(body).alias("text_1"),
        F.xxhash64(F.lit(1), body).alias("text_2"),
        F.col(host).alias("host"),
        body.alias("text"),
    )


def _lines(keyed: DataFrame) -> DataFrame:
    """Each line with a word: KEY, its place, the hash of its normal form, its words."""
    split = F.transform(
        F.split("text", "\n"),
        lambda own, i: F.when(
            has_word(own),
            F.struct(
                i.alias("place"),
                F.xxhash64(normal_line(own)).alias("line"),
                F.size(F.split(F.btrim(own, F.lit(BLANKS)), GAP)).cast("long").alias("words"),
            ),
        ),
    )
    return keyed.select(*KEY, F.explode(F.filter(split, lambda x: x.isNotNull())).alias("x")).select(*KEY, "x.*")


def frequent_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """host, line (hash), texts: lines above the limit of their host."""
    keyed = _keyed(docs, doc_id, text, host)
    held = _lines(keyed).select("host", "line", "text_1", "text_2").distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > MIN_TEXTS)
    hosts = keyed.select("host", "text_1", "text_2").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_texts"))
    both = salted_join(counts, hosts, ["host"], ["line"])
    limit = F.least(MAX_SHARE * F.col("all_texts"), F.lit(float(MAX_TEXTS)))
    return both.filter(F.col("texts") > limit).select("host", "line", "texts")


def _hits(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """The lines to remove: KEY, place, words."""
    lines = _lines(_keyed(docs, doc_id, text, host))
    found = salted_join(lines, frequent_lines(docs, doc_id, text, host), ["host", "line"], ["id", "text_1"])
    return found.select(*KEY, "place", "words").dropDuplicates([*KEY, "place"])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: its id, the counts, both verdicts."""
    keyed = _keyed(docs, doc_id, text, host).withColumn("base", base_rules(F.col("text"))).drop("text")
    removed = _hits(docs, doc_id, text, host).groupBy(*KEY).agg(F.sum("words").alias("n_frequent_words"))
    both = key_join(keyed, removed, KEY, "left")
    n_words, repeated = F.col("base.counts.n_words"), F.col("base.counts.n_repeat_words")
    gone = F.coalesce("n_frequent_words", F.lit(0).cast("long"))
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
    depleted = 100 * (n_words - gone) < MIN_KEPT_PERCENT * n_words
    return both.select(
        F.col("id").alias(doc_id),
        n_words.alias("n_words"),
        F.col("base.word_chars").alias("word_chars"),
        F.col("base.n_symbols").alias("n_symbols"),
        F.col("base.n_dup_lines").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        gone.alias("n_frequent_words"),
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that both rules keep, without their frequent lines.

    Columns as in ``docs``; an ``n_chars`` column follows the new text.
    """
    removed = _hits(docs, doc_id, text, host).groupBy(*KEY).agg(
        F.sum("words").alias("gone"), F.collect_list("place").alias("places")
    )
    own = fresh(docs, "k_text_1", "k_text_2", "k_base", "k_gone", "k_places")
    one, two, base, gone, places = own
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({one: F.xxhash64(body), two: F.xxhash64(F.lit(1), body), base: base_rules(F.col(text))})
    removed = removed.select(*KEY, "gone", "places").toDF(doc_id, one, two, host, gone, places)
    both = key_join(keyed, removed, [doc_id, one, two, host], "left")
    n_words, repeated = F.col(f"{base}.counts.n_words"), F.col(f"{base}.counts.n_repeat_words")
    left = n_words - F.coalesce(F.col(gone), F.lit(0))
    good = (n_words >= MIN_WORDS) & (100 * repeated <= MAX_REPEATED_PERCENT * n_words)
    kept = both.filter(good & (100 * left >= MIN_KEPT_PERCENT * n_words))

    def without(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places))
        return F.concat_ws("\n", F.transform(stay, lambda i: F.get(lines, i)))

    new = F.when(F.col(places).isNull(), F.col(text)).otherwise(let(F.split(F.col(text), "\n"), without))
    out = kept.withColumn(text, new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(places).isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind)))
    return out.select(*docs.columns)
