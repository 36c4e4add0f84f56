"""Which rows of a large table hold a key of a batch, without moving the table.

The batch's keys become a blocked Bloom filter: a key's hash picks one of
``WORDS`` words of 64 bits and a few bits in it; the words that have a bit are
the rows of a small table, built by one aggregate.  ``split`` joins it to the
table as a broadcast on the word number, so each row is judged where it is read:
no exchange and no sort over the table.  There are at most ``WORDS`` rows of two
numbers, whatever the batch holds (64 MiB in memory), so the broadcast is
bounded and there is one plan at every size.

A row that holds a key of the batch is always found.  Some rows that hold none
are found too (about one in 100 when the batch has 8 million keys, hardly any for
a small batch): a merge must leave such rows as they are, and then its result is
exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 21
PROBES = 4


def _word(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("word"), *keys), F.lit(WORDS))


def _mask(keys: Sequence[str]) -> Column:
    """The bits of a key: 6 bits of one hash say each."""
    hashed = F.xxhash64(F.lit("bits"), *keys)
    out = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def key_words(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The words that hold a bit of a key of ``changes``: ``_word``, ``_bits``."""
    return changes.groupBy(_word(keys).alias("_word")).agg(F.bit_or(_mask(keys)).alias("_bits"))


def split(target: DataFrame, changes: DataFrame, keys: Sequence[str], within: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(touched, rest): the rows of ``target`` that may hold a key of ``changes``,
    and all others.  ``within`` limits the touched rows to those that fulfil it.

    Null keys are keys like any other.
    """
    # Hashes depend on the type.
    words = key_words(changes.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys]), keys)
    marked = target.join(F.broadcast(words), _word(keys) == F.col("_word"), "left")
    mask = _mask(keys)
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    if within is not None:
        hit = hit & F.coalesce(within, F.lit(False))
    return marked.filter(hit).select(*target.columns), marked.filter(~hit).select(*target.columns)
