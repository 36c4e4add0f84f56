"""Line dedup by content-defined line chunks (operator 8).

A rolling hash over the hashes of ``SPAN`` successive lines ends a chunk after
a line where it is 0 modulo ``DIVISOR``.  A boundary depends on the lines just
before it alone, so the chunks of a shared passage are the same wherever it
stands.  A chunk of at least two lines with text that occurs again anywhere is
kept at its first place (smallest doc_id, then place in the text) and removed
from the others, after a comparison of its bytes.

Hashes of all chunks are counted first; only texts of chunks whose hash occurs
again are moved for the comparison, once: grouping compares their bytes, and each
occurrence finds its group by the SHA-256 of its text.  Hot chunks are aggregated
before the shuffle and salted in the joins.  Whole rows travel as one column, so
that a pass and the removal share one shuffle of the texts.  Only DataFrame
functions are used.

Chunks miss what stands between a passage's ends and its nearest shared
boundaries, and chunks with one line of text.  With ``pairs`` an exact pass follows
the chunks: it compares the pairs of successive lines with text (and the blank lines
between them) that do not lie within a removed chunk, so every passage of two or
more such lines that stands in an earlier place is found, whatever surrounds it.
Nothing is lost by leaving out the others: a pair within a removed chunk stands
earlier too, so it is nobody's first place.  Pairs overlap, so a line is removed if
one of its pairs is; a line's first place of all is never removed.  A pair that
overlaps its own first place (a line three times in a row) stays, and so do blank
lines at the ends of a removed chunk.  Which chunks go is checkpointed between the
passes.

Cases: a null text stays null and has no chunks; an empty text stays; texts of
any length are taken whole; rows alike in id and text are one occurrence and
get equal results; rows alike in text only are two, and the copy keeps just
its single-line chunks; equal chunks within one text are told apart by their
place; null ids come first; an empty table gives no rows;
other columns are passed through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, fresh, key_join, let, release, salted_join

SPAN = 2
DIVISOR = 3

# Rows of one chunk that a task takes in the comparison.
ROWS_PER_PART = 2_000

KEY = ["id", "text_1", "text_2"]


def _ends(line_hashes: Column) -> Column:
    """Places of the lines that end a chunk."""

    def at_end(i: Column) -> Column:
        rolled = F.md5(F.concat(*[F.get(line_hashes, i - k) for k in reversed(range(SPAN))]).cast("binary"))
        return F.conv(F.substring(rolled, 1, 8), 16, 10).cast("long") % DIVISOR == 0

    return F.filter(F.sequence(F.lit(0), F.size(line_hashes) - 1), lambda i: (i >= SPAN - 1) & F.coalesce(at_end(i), F.lit(False)))


def _opens(lines: Column) -> Column:
    """Places of the lines that open a chunk."""
    hashes = F.transform(lines, lambda x: F.md5(x.cast("binary")))
    # First place of each chunk; the last end opens none after the last line.
    opens = let(hashes, lambda h: F.concat(F.array(F.lit(0)), F.transform(_ends(h), lambda i: i + 1)))
    return F.filter(opens, lambda i: i < F.size(lines))


def chunks_of(text: Column) -> Column:
    """The chunks of a text, in order: arrays of lines."""

    def cut_lines(lines: Column) -> Column:
        return let(
            _opens(lines),
            lambda s: F.transform(s, lambda a, k: F.slice(lines, a + 1, F.coalesce(F.get(s, k + 1), F.size(lines)) - a)),
        )

    return let(F.split(text, "\n"), cut_lines)


def _worded(lines: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Places of the lines with text, from ``start`` and before ``end``."""
    places = F.sequence(F.lit(0) if start is None else start, (F.size(lines) if end is None else end) - 1)
    return F.filter(places, lambda i: F.trim(F.get(lines, i)) != "")


# The number of a pair: the place of its first line, then that of its second in
# the lower half.
HALF = 1 << 32


def _first_line(no: Column) -> Column:
    return F.shiftright(no, 32).cast("int")


def _second_line(no: Column) -> Column:
    return no.bitwiseAND(F.lit(HALF - 1)).cast("int")


def _pairs(worded: Column) -> Column:
    """The numbers of the pairs of successive places."""

    def numbers(w: Column) -> Column:
        firsts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))
        return F.transform(firsts, lambda a, k: a.cast("long") * HALF + F.get(w, k + 1))

    return let(worded, numbers)


def _pairs_within(lines: Column, chunks: Column) -> Column:
    """The pairs that lie within the chunks of these numbers."""

    def inner(opens: Column) -> Column:
        one = lambda k: _pairs(_worded(lines, F.get(opens, k), F.coalesce(F.get(opens, k + 1), F.size(lines))))
        return F.flatten(F.transform(chunks, one))

    return let(_opens(lines), inner)


def joined(lines: Column) -> Column:
    return F.concat_ws("\n", lines)


def several(lines: Column) -> Column:
    """At least two lines with text."""
    return F.size(F.filter(lines, lambda x: F.trim(x) != "")) >= 2


def _keyed(docs: DataFrame, doc_id: str, text: str, one: str, two: str, row: str) -> DataFrame:
    """The id, two hashes of the text (rows alike in id and hashes are one) and
    ``row``, an array of the whole row alone.

    Spark reuses a shuffle only for readers of the same columns; beside ``row``, no
    reader takes fewer of them than another.
    """
    hashes = [F.xxhash64(F.col(text)).alias(one), F.xxhash64(F.lit(1), F.col(text)).alias(two)]
    return docs.select(doc_id, *hashes, F.array(F.struct(*docs.columns)).alias(row))


def _text_of(row: str, text: str) -> Column:
    """The text in a ``row`` of ``_keyed``.  The lambda keeps the row whole."""
    return F.transform(F.col(row), lambda r: r[text]).getItem(0)


def _place() -> Column:
    return F.struct(F.col("id").alias("id"), F.col("text_1"), F.col("text_2"), F.col("no"))


def _chunk_hashes(text: Column) -> Column:
    """no, hash of the chunks of at least two lines with text."""
    hashed = F.transform(
        chunks_of(text), lambda c, k: F.when(several(c), F.struct(k.alias("no"), F.xxhash64(joined(c)).alias("hash")))
    )
    return F.filter(hashed, lambda x: x.isNotNull())


def _pair_hashes(text: Column, gone: Column) -> Column:
    """no, hash of the pairs that do not lie within the chunks ``gone``."""

    def hashed(lines: Column) -> Column:
        every = _pairs(_worded(lines))
        left = F.when(gone.isNull(), every).otherwise(F.array_except(every, _pairs_within(lines, gone)))
        return F.transform(left, lambda no: F.struct(no.alias("no"), F.xxhash64(_pair_text(lines, no)).alias("hash")))

    return let(F.split(text, "\n"), hashed)


def _pair_text(lines: Column, no: Column) -> Column:
    return joined(F.slice(lines, _first_line(no) + 1, _second_line(no) - _first_line(no) + 1))


def repeats(keyed: DataFrame, key: list[str], text: Column, gone: str | None = None) -> DataFrame:
    """KEY and no of every chunk that stands at a later place than its first; with
    ``gone``, the column of the chunks removed, of every pair outside them.

    ``keyed`` comes from ``_keyed``; the caller joins it again by the same key,
    so that Spark can use one shuffle of the texts for both.
    """
    own_key = [F.col(c).alias(k) for c, k in zip(key, KEY)]
    hashed = _pair_hashes(text, F.col(gone)) if gone else _chunk_hashes(text)
    own = keyed.select(*own_key, F.explode(hashed).alias("x")).select(*KEY, "x.*")
    again = own.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > 1)
    # The pieces to compare, by document; then their texts.
    suspects = salted_join(own, again, ["hash"], ["id", "text_1", "no"])
    wanted = suspects.groupBy(*KEY).agg(F.collect_set(F.struct("no", "times")).alias("wanted"))
    want, = fresh(keyed, "k_wanted")
    held = key_join(keyed, wanted.toDF(*key, want), key)
    piece = (lambda ps, no: _pair_text(ps, no)) if gone else (lambda ps, no: joined(F.get(ps, no)))
    picked = let(
        F.split(text, "\n") if gone else chunks_of(text),
        lambda ps: F.transform(
            F.col(want), lambda w: F.struct(w["no"].alias("no"), w["times"].alias("times"), piece(ps, w["no"]).alias("chunk"))
        ),
    )
    found = held.select(*own_key, F.explode(picked).alias("x")).select(*KEY, "x.*").withColumn("hash", F.xxhash64("chunk"))
    # Grouping on the piece itself compares its bytes; its digest stands for it in the
    # join, so that its text moves once.
    firsts = found.groupBy("hash", "chunk").agg(F.min(_place()).alias("first"), F.max("times").alias("times"))
    digest = F.unhex(F.sha2(F.col("chunk").cast("binary"), 256)).alias("digest")
    parts = F.ceil(F.col("times") / ROWS_PER_PART).cast("long")
    firsts = firsts.select("hash", digest, "first", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    found = found.select(*KEY, "no", "hash", digest, F.pmod(F.xxhash64(*KEY, "no"), parts).alias("part"))
    both = found.join(firsts, ["hash", "digest", "part"])
    later = both.filter(_place() != F.col("first"))
    if gone:
        same = [F.col(c).eqNullSafe(F.col(f"first.{c}")) for c in KEY]
        overlap = _first_line(F.col("no")) == _second_line(F.col("first.no"))
        later = later.filter(~(same[0] & same[1] & same[2] & overlap))
    return later.select(*KEY, "no").distinct()


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str | None = None, pairs: bool = False) -> DataFrame:
    """``docs`` without repeated chunks; all rows and columns stay.  With ``pairs``
    also without the repeated pairs of lines outside the chunks removed.

    An ``n_chars`` column follows the new text.  ``removed`` names a column
    that is to hold the number of chunks (and pairs) taken out.
    """
    one, two, row, out, rest = fresh(docs, "k_text_1", "k_text_2", "k_row", "k_drops", "k_rest")
    key = [doc_id, one, two]

    def by_document(found: DataFrame, name: str) -> DataFrame:
        return found.groupBy(*KEY).agg(F.collect_set("no").alias("drops")).toDF(*key, name)

    keyed, whole = _keyed(docs, doc_id, text, one, two, row), _text_of(row, text)
    drops = by_document(repeats(keyed, key, whole), out)
    if pairs:
        drops = cut(drops)
        release(drops)
    both = key_join(keyed, drops, key, "left")
    taken = [F.col(out)]
    if pairs:
        both = key_join(both, by_document(repeats(both, key, whole, out), rest), key, "left")
        taken.append(F.col(rest))
    both = both.select(F.inline(row), *taken)

    def without(chunks: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), F.col(out))
        return joined(F.transform(stay, lambda k: joined(F.get(chunks, k))))

    def unpaired(lines: Column) -> Column:
        none = F.array().cast("array<bigint>")
        numbers = F.concat(F.coalesce(_pairs_within(lines, F.col(out)), none), F.coalesce(F.col(rest), none))
        gone = F.flatten(F.transform(numbers, lambda no: F.sequence(_first_line(no), _second_line(no))))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return joined(F.transform(stay, lambda i: F.get(lines, i)))

    touched = taken[0].isNotNull() | taken[-1].isNotNull()
    left = let(F.split(F.col(text), "\n"), unpaired) if pairs else let(chunks_of(F.col(text)), without)
    new = {text: F.when(touched, left).otherwise(F.col(text))}
    result = both.withColumns(new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        result = result.withColumn("n_chars", F.when(touched, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    sizes = [F.when(c.isNotNull(), F.size(c)).otherwise(F.lit(0)) for c in taken]
    extra = [(sizes[0] + sizes[1] if pairs else sizes[0]).alias(removed)] if removed else []
    return result.select(*docs.columns, *extra)
