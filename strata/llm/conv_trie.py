"""Conversation prefix trie by whole-sequence collapse (operator 12).

Turns are numbered in their conversations and each conversation is rebuilt (see
``rebuild``).  A turn's digest, hashed with its position, gives a few lanes of 32
bits; the sums of the lanes over the first d turns are the key of that sequence,
so keys follow from running sums, which split, instead of from arrays, which do
not.  Identical rebuilt conversations become one weighted sequence, whose end
list holds the ids of all of them.  A sequence is a leaf if the anti-join with
the proper prefixes of all sequences keeps it.  The prefixes of the weighted
sequences, aggregated by key, are the nodes.

What a subtree saves is summed without walking it: every node is owned by the
sequence of its smallest member; a prefix row carries what its sequence owns from
its depth on, and the sum of these over a node's rows is the sum over its
subtree.

Long conversations are cut into parts of ``ROWS`` turns for running sums, so none
is a task of its own; conversations of any length are keyed by (id, part).
Copies of one conversation meet only in aggregates that tasks begin before the
shuffle; an end list is written by many tasks in id order and hashed as a stream.

Cases: rows without a conversation id are left out; turns are ordered by turn
(null first), then role, then text by its first 64 characters, then by digest;
repeated rows are turns of their own; a null role or text is empty; texts of any
length are hashed whole; a conversation that is rebuilt without any turn is the
root's member; a block base that does not exist gives no head; an empty table
gives no rows; extra columns do not clash, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

LANES = 4
# Turns of one conversation whose running sums are taken together.
ROWS = 65_536
# Conversations of a block share the first turns of its base.
BLOCK = 100
HEADS = 5
# Ids of an end list joined into one text.
IDS = 100_000

KEY = ["k0", "k1"]


def _sums(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(LANES)]


def _lanes() -> dict[str, Column]:
    """Lanes of a turn: hashes of its position and digest, 32 bits each."""
    hashed = [F.xxhash64(F.lit(i), F.col("pos"), F.col("digest")) for i in range(LANES)]
    return {name: F.shiftrightunsigned(h, 32) for name, h in zip(_sums("l"), hashed)}


def _key(sums: list[Column], depth: Column, names: list[str] | None = None) -> list[Column]:
    return [F.xxhash64(F.lit(i), depth, *sums).alias(n) for i, n in enumerate(names or KEY)]


# --- turns -----------------------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, k (from 1), digest, chars of every turn, in order.

    Rows are range-partitioned on the order, so that a conversation of any
    length is spread over tasks; a partition's first conversation goes on from
    the count that the partitions before it have reached.
    """
    checkpoint_dir(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.substring(role, 1, 64).alias("role"),
        F.substring(text, 1, 64).alias("text"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ["conv_id", "turn", "role", "text", "digest"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The position is kept in mid, which rises inside a partition.
    rows = rows.select("conv_id", "digest", "chars", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")).checkpoint()

    counts = rows.groupBy("pid", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    held = F.struct("conv_id", "n")
    edges = counts.groupBy("pid").agg(F.min("conv_id").alias("first"), F.max(held).alias("last"))
    upto = Window.partitionBy("last.conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = edges.select("pid", "first", F.struct(F.col("last.conv_id").alias("conv_id"), F.sum("last.n").over(upto).alias("n")).alias("last"))
    edges = edges.withColumn("before", F.lag("last").over(Window.orderBy("pid")))
    goes_on = F.col("before.conv_id") == F.col("first")
    edges = edges.select("pid", "first", F.coalesce(F.when(goes_on, F.col("before.n")), F.lit(0)).alias("ahead"))
    # One row per range partition.
    place = F.row_number().over(Window.partitionBy("pid", "conv_id").orderBy("mid"))
    ahead = F.when(F.col("conv_id") == F.col("first"), F.col("ahead")).otherwise(F.lit(0))
    numbered = rows.withColumn("k0", place).join(F.broadcast(edges), "pid")
    return numbered.select("conv_id", (F.col("k0") + ahead).cast("long").alias("k"), "digest", "chars")


def rebuild(numbered: DataFrame) -> DataFrame:
    """conv_id, pos, digest, chars of every rebuilt turn, with a row at pos 0 (the
    root) for every conversation.

    A conversation c takes the first h turns of the base of its block,
    c - c % ``BLOCK``, and its own turns after its first h;
    h = crc32(decimal c) % (``HEADS`` + 1).
    """
    convs = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEADS + 1)).cast("int").alias("h"),
    )
    first = numbered.filter((F.col("k") <= HEADS) & (F.col("conv_id") % BLOCK == 0))
    # At most HEADS turns per base, without their texts.
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("k", "digest", "chars"))).alias("head"))
    taken = F.filter(F.col("head"), lambda x: x["k"] <= F.col("h"))
    plan = convs.join(heads.hint("merge"), "base", "left").select("conv_id", "h", F.coalesce(taken, F.array()).alias("head"))
    root = F.array(F.struct(F.lit(0).cast("long").alias("k"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")))
    begun = plan.select("conv_id", F.explode(F.concat(root, "head")).alias("x")).select("conv_id", F.col("x.k").alias("pos"), "x.digest", "x.chars")
    # A long conversation is split by the skew join; the other side has one row per conversation.
    own = numbered.join(plan.select("conv_id", "h", F.size("head").alias("m")).hint("merge"), "conv_id").filter(F.col("k") > F.col("h"))
    return begun.unionByName(own.select("conv_id", (F.col("k") - F.col("h") + F.col("m")).alias("pos"), "digest", "chars"))


# --- sequences -------------------------------------------------------------------


def _running(rows: DataFrame, values: list[str], names: list[str], backwards: bool = False) -> DataFrame:
    """Running sums of ``values`` over a sequence's rows (rep, pos), this one
    included, from the front or from the back; sums of whole parts come from a
    table with one row per part, of the sequences with several."""
    way, outer = (F.desc, F.desc) if backwards else (F.asc, F.asc)
    inside = Window.partitionBy("rep", "part").orderBy(way("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("rep").orderBy(outer("part")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.filter(F.col("len") >= ROWS).groupBy("rep", "part").agg(*[F.sum(v).alias(f"{n}_part") for v, n in zip(values, names)])
    totals = totals.select("rep", "part", *[F.coalesce(F.sum(f"{n}_part").over(ahead), F.lit(0)).alias(f"{n}_ahead") for n in names])
    out = rows.withColumns({n: F.sum(v).over(inside) for v, n in zip(values, names)})
    out = out.join(totals, ["rep", "part"], "left")
    return out.select(*rows.columns, *[(F.col(n) + F.coalesce(f"{n}_ahead", F.lit(0))).alias(n) for n in names])


@dataclass
class Trie:
    """``nodes``: k0, k1 (the node's key), conv_id (smallest member), depth, chars
    (of the last text), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.
    ``ends``: k0, k1, conv_id of every conversation that ends at a node."""

    nodes: DataFrame
    ends: DataFrame


def collapse(rebuilt: DataFrame) -> Trie:
    """The prefix trie of conversations given as ``rebuild`` returns them."""
    checkpoint_dir(rebuilt.sparkSession)
    zero = {name: F.when(F.col("pos") > 0, lane).otherwise(F.lit(0).cast("long")) for name, lane in _lanes().items()}
    rows = rebuilt.withColumns(zero).select("conv_id", "pos", "chars", *_sums("l")).checkpoint()

    # Whole sequences: identical conversations have the same key and are one.
    whole = rows.groupBy("conv_id").agg(F.max("pos").alias("len"), *[F.sum(n).alias(n) for n in _sums("l")])
    ends = whole.select("conv_id", "len", *_key([F.col(n) for n in _sums("l")], F.col("len"))).checkpoint()
    sequences = ends.groupBy(*KEY, "len").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight"))

    # Their prefixes, one row per sequence and depth.
    own = rows.withColumnRenamed("conv_id", "rep").join(sequences.select("rep", "len", "weight").hint("merge"), "rep")
    own = own.withColumn("part", F.floor(F.col("pos") / ROWS))
    own = _running(own, _sums("l"), _sums("s"))
    above = [F.col(s) - F.col(v) for s, v in zip(_sums("s"), _sums("l"))]
    prefixes = own.select(
        "rep", "pos", "part", "len", "weight", "chars",
        *_key([F.col(n) for n in _sums("s")], F.col("pos")),
        *_key(above, F.col("pos") - 1, ["p0", "p1"]),
    ).checkpoint()

    # Leaves: sequences that are no proper prefix of another.
    proper = prefixes.filter(F.col("pos") < F.col("len")).select(*KEY).distinct()
    leaves = prefixes.filter(F.col("pos") == F.col("len")).join(proper.hint("merge"), KEY, "left_anti").select("rep", F.lit(1).alias("leaf"))

    nodes = prefixes.groupBy(*KEY).agg(
        F.min("rep").alias("conv_id"),
        F.min("pos").alias("depth"),
        F.min("chars").alias("chars"),
        F.min("p0").alias("p0"),
        F.min("p1").alias("p1"),
        F.sum("weight").alias("n_convs"),
    ).checkpoint()
    # What a node saves stands with its owner; rows (rep, pos) meet one node at most.
    saved = nodes.select(F.col("conv_id").alias("rep"), F.col("depth").alias("pos"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saves"))
    owned = prefixes.select("rep", "pos", "part", "len", *KEY).join(saved.hint("merge"), ["rep", "pos"], "left")
    owned = owned.withColumn("saves", F.coalesce("saves", F.lit(0)))
    owned = _running(owned, ["saves"], ["onward"], backwards=True)
    owned = owned.select("rep", *KEY, "onward").join(leaves.hint("merge"), "rep", "left")
    below = owned.groupBy(*KEY).agg(F.sum("onward").alias("saved_tokens"), F.count("leaf").alias("n_leaves"))

    children = nodes.filter("depth > 0").groupBy(F.col("p0").alias("k0"), F.col("p1").alias("k1")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("conv_id").alias("parent"))
    # A parent of many children is split by the skew join; parents have one row per key.
    found = nodes.join(parents.hint("merge"), ["p0", "p1"], "left")
    found = found.join(below.hint("merge"), KEY).join(children.hint("merge"), KEY, "left")
    return Trie(
        found.select(
            *KEY,
            "conv_id",
            "depth",
            "chars",
            F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves",
            "saved_tokens",
        ),
        ends.select(*KEY, "conv_id"),
    )


def list_digests(ends: DataFrame) -> DataFrame:
    """k0, k1, ends_sha256 of every node where a conversation ends: the SHA-256 of
    the ids, ascending, in decimal, joined by commas.

    Ids are range-partitioned by (node, id), so the ids of a node with very many
    are joined into texts by many tasks; the hash of a list has to be taken in
    order, so one task reads these texts, as a stream.
    """
    order = [*KEY, "conv_id"]
    sorted_ids = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, no, held, node = TaskContext.get().partitionId(), 0, [], None
        out: list[tuple] = []

        def flush() -> None:
            nonlocal no, held
            if held:
                out.append((*node, task, no, ",".join(map(str, held))))
                no, held = no + 1, []

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
            columns = list(zip(*out)) or [()] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*KEY, "task", "no", "ids"])

        for batch in batches:
            for k0, k1, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (k0, k1) != node or len(held) >= IDS:
                    flush()
                    node = (k0, k1)
                held.append(conv)
            if out:
                yield batch_of()
        flush()
        yield batch_of()

    pieces = sorted_ids.mapInArrow(joined, "k0 long, k1 long, task int, no int, ids string")
    pieces = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "task", "no")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string()])], [*KEY, "ends_sha256"])

        for batch in batches:
            out = []
            for k0, k1, _, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k0, k1) == node:
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (k0, k1), hashlib.sha256()
                state.update(ids.encode())
            yield done(out)
        if node is not None:
            yield done([(*node, state.hexdigest())])

    return pieces.mapInArrow(hashed, "k0 long, k1 long, ends_sha256 string")


NO_ENDS = hashlib.sha256(b"").hexdigest()


def with_digests(trie: Trie) -> DataFrame:
    """The nodes with the digest of their end lists."""
    found = trie.nodes.join(list_digests(trie.ends).hint("merge"), KEY, "left")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
