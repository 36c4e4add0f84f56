"""SimHash near-dedup by covering locality-sensitive hashing (operator 10).

Fingerprints of 64 bits link when at most ``radius`` bits differ.  Every bit
gets a non-zero vector of radius + 1 bits; table v (any non-zero vector) looks
at the bits whose vectors have an odd product with v.  The vectors of at most
``radius`` differing bits leave some v that is orthogonal to all of them, so
every linked pair agrees on all the bits that this table looks at: no link is
lost.  There are 2 ** (radius + 1) - 1 tables.

Equal fingerprints are one node.  Each node enters each table once; the tasks
read the buckets in order and link their members by exact bit distance.  A
bucket emits a spanning forest, not its pairs.  Buckets over ``BLOCK`` members
go on to a second pass that compares them block by block in many tasks, so no
bucket has to fit a task and none is cut short.  Components come from
alternating large-star and small-star steps on the links.

Cases: null, empty and blank texts have fingerprint zero and link like any
other; texts of any length are taken whole; equal rows share a component; a
null doc_id is smaller than any other, and a component of null ids only has the
id null; an empty table gives no rows; extra columns do not clash, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, dealt_join, key_join, salted_join, small_batches

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK = 4096

# Stands for a null doc_id inside the operator: smaller than any id.
NO_ID = -(1 << 63)


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    text = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    spans = zip(starts, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(text))]
    ones, total = np.zeros(BITS, np.int64), max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in spans), np.uint64, total)
    for at in range(0, total, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """Replace ``text`` by its fingerprint, a signed long called ``name``."""
    at = docs.columns.index(text)
    others = [f for f in docs.schema if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], f"`{name}` long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, batch.num_rows)
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in kept], pa.array(prints.view(np.int64))], [*[batch.schema.names[i] for i in kept], name]
            )

    return small_batches(docs).mapInArrow(run, schema)


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bits that each table looks at, as signed longs."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    looked = [sum(1 << i for i, f in enumerate(vectors) if (f & v).bit_count() & 1) for v in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in looked]


def forest(prints: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(smallest index, other indexes) of each linked set of two or more."""
    rest = np.arange(len(prints))
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front, members = np.array([root]), []
        while len(front) and len(rest):
            near = np.zeros(len(rest), bool)
            for at in range(0, len(front), 256):
                apart = np.bitwise_count(prints[front[at : at + 256], None] ^ prints[None, rest])
                near |= (apart <= radius).any(axis=0)
            front, rest = rest[near], rest[~near]
            members.append(front)
        found = np.concatenate(members) if members else front[:0]
        if len(found):
            yield int(root), found


LINKS = "print long, root long"
OVER = ", mask_no int, seen long, block int"


def _links(keys: list[str], radius: int, block: int | None):
    """Reads rows sorted by ``keys``, then print, one bucket after another.

    Yields links; with ``block``, the members of larger buckets are yielded as
    rows with a block number instead (their root is null).
    """
    names = ["print", "root"] + (["mask_no", "seen", "block"] if block else [])

    def table(columns) -> pa.RecordBatch:
        kinds = [pa.int64()] * 2 + ([pa.int32(), pa.int64(), pa.int32()] if block else [])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def links(prints, lo, hi) -> Iterator[pa.RecordBatch]:
        """Links of the buckets that span rows lo[i] to hi[i]."""
        a, b = [], []
        size, unsigned = hi - lo, prints.view(np.uint64)
        two = lo[size == 2]
        two = two[np.bitwise_count(unsigned[two] ^ unsigned[two + 1]) <= radius]
        a.append(two)
        b.append(two + 1)
        for x, y in zip(lo[size > 2], hi[size > 2]):
            for root, found in forest(unsigned[x:y], radius):
                a.append(np.full(len(found), x + root))
                b.append(x + found)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            empty = [pa.nulls(len(a), t) for t in (pa.int32(), pa.int64(), pa.int32())] if block else []
            yield table([prints[b], prints[a], *empty])

    def over(key, prints, no) -> pa.RecordBatch:
        n = len(prints)
        return table([prints, pa.nulls(n, pa.int64()), np.full(n, key[0]), np.full(n, key[1]), np.full(n, no)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = None, 0  # rows of the bucket that may go on; its blocks so far
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            new = [part[c].to_numpy() for c in (*keys, "print")]
            rows = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            prints = rows[-1]
            n = len(prints)
            starts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in rows[:-1]], axis=0)) + 1
            starts = np.concatenate([[0], starts])
            lo, hi = starts[:-1], starts[1:]
            if blocks and len(lo):  # the large bucket before these ends here
                yield over([k[0] for k in rows[:2]], prints[: hi[0]], blocks)
                lo, hi, blocks = lo[1:], hi[1:], 0
            if block:
                for x, y in zip(lo[hi - lo > block], hi[hi - lo > block]):
                    for no, at in enumerate(range(x, y, block)):
                        yield over([k[x] for k in rows[:2]], prints[at : min(y, at + block)], no)
                small = hi - lo <= block
                lo, hi = lo[small], hi[small]
            yield from links(prints, lo, hi)
            at = starts[-1]
            while block and n - at > block:
                yield over([k[at] for k in rows[:2]], prints[at : at + block], blocks)
                at, blocks = at + block, blocks + 1
            held = [r[at:] for r in rows]
        if held is not None:
            if blocks:
                yield over([k[0] for k in held[:2]], held[-1], blocks)
            else:
                yield from links(held[-1], np.array([0]), np.array([len(held[-1])]))

    return run


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links print - root (the smaller of the two) that join all linked prints.

    ``nodes``: print, one row per fingerprint.
    """
    tables = F.array(*[F.lit(m).cast("long") for m in masks(radius)])
    entries = nodes.select("print", F.posexplode(tables).alias("mask_no", "mask"))
    entries = entries.select("mask_no", F.col("print").bitwiseAND(F.col("mask")).alias("seen"), "print")
    key = ["mask_no", "seen"]
    ordered = entries.repartition(*key).sortWithinPartitions(*key, "print")
    found = cut(ordered.mapInArrow(_links(key, radius, block), LINKS + OVER))
    large = found.filter(F.col("block").isNotNull()).select(*key, "block", "print")
    blocks = large.groupBy(*key).agg(F.max("block").alias("last"))
    cells = salted_join(large, blocks, key, ["print"])
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    cells = cells.select(*key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "print")
    pair = [*key, "low", "high"]
    more = cells.repartition(*pair).sortWithinPartitions(*pair, "print").mapInArrow(_links(pair, radius, None), LINKS)
    small = found.filter(F.col("block").isNull()).select("print", "root")
    return small.unionByName(more).distinct()


def components(found: DataFrame) -> DataFrame:
    """print, root for every linked print, roots too; the root is the smallest.

    Large-star hangs the larger neighbours of a print on its smallest one,
    small-star the smaller ones, until every print hangs on a root.  The
    smallest neighbours are aggregated before the shuffle, hot prints are split in
    the join.
    """
    edges = cut(found.select(F.col("print").alias("u"), F.col("root").alias("v")))

    def stars(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return dealt_join(pairs, least, ["u"], ["v"])

    def settled(pairs: DataFrame) -> bool:
        """Every print hangs on one other, which hangs on none."""
        ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("hung"), F.lit(0).alias("holds"))
        ends = ends.unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("hung"), F.lit(1).alias("holds")))
        ends = ends.groupBy("x").agg(F.sum("hung").alias("hung"), F.max("holds").alias("holds"))
        return ends.filter(F.col("hung") + F.col("holds") > 1).isEmpty()

    while not settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        small = stars(large)  # every u of large is above its v
        hung = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = cut(hung.filter(F.col("u") != F.col("v")).distinct())
    roots = edges.select("v").distinct()
    return edges.unionByName(roots.select(F.col("v").alias("u"), "v")).toDF("print", "root")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """row_1, row_2 (hashes of the whole row), doc, print, root, root_doc.

    One row per row of ``docs``; ``root`` names the component, ``root_doc`` is
    its smallest id.
    """
    hashed = [F.struct(*[F.col(f"`{c}`") for c in docs.columns])]
    rows = docs.select(
        F.xxhash64(*hashed).alias("row_1"),
        F.xxhash64(F.lit(1), *hashed).alias("row_2"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col(text).alias("text"),
    )
    rows = cut(with_fingerprint(rows, "text", "print", shingle), by=["row_1", "doc"])
    nodes = rows.groupBy("print").agg(F.min("doc").alias("first"))
    sets = components(links(nodes.select("print"), radius))
    lowest = key_join(sets, nodes, ["print"]).groupBy("root").agg(F.min("first").alias("root_doc"))
    named = key_join(nodes, dealt_join(sets, lowest, ["root"], ["print"]), ["print"], "left")
    named = named.select("print", F.coalesce("root", "print").alias("root"), F.coalesce("root_doc", "first").alias("root_doc"))
    return dealt_join(rows, named, ["print"], ["row_1", "doc"])


def id_or_null(column: str) -> Column:
    """An id of the operator's inside as it stood in the table."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, one each."""
    found = near_duplicates(docs, text, doc_id, shingle, radius)
    first = F.min(F.struct("doc", "row_1", "row_2")).alias("first")
    winners = found.groupBy("root").agg(first).select("first.*")
    names = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    hashed = [F.struct(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])]
    keyed = plain.select(
        "*",
        F.xxhash64(*hashed).alias("row_1"),
        F.xxhash64(F.lit(1), *hashed).alias("row_2"),
        F.coalesce(F.col(names[docs.columns.index(doc_id)]).cast("long"), F.lit(NO_ID)).alias("doc"),
    )
    key = ["doc", "row_1", "row_2"]
    kept = key_join(keyed, winners, key)
    return kept.dropDuplicates(key).select(*names).toDF(*docs.columns)
