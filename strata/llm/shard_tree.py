"""Sharding by a hierarchical weighted hash tree (operator 2).

A tree holds regions, racks and shards, each shard with a weight; a node
weighs what its shards weigh.  A row descends from the root: at each level
every child draws ``-ln(u) / weight``, with u from a hash of the row's key and
the child's name, and the smallest draw wins.  A child is chosen in proportion
to its weight, and its draw depends on nothing but the key, its name and its
weight.  So when the weight of one shard changes, only the draws of that shard,
its rack and its region change: rows move only into (or out of) these
subtrees.  A shard that opens a region of its own takes rows only into itself.

The work for a row follows regions + racks + shards of one rack, not the number
of shards, and needs no shuffle.

Cases: a null key is one key of its own; repeated rows and rows with equal
keys meet in one shard; an empty table gives no rows; a text plays no part, so
its length and content do not matter; of equal draws the child listed first wins;
columns whose names clash with the added ones are replaced by them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, numbered

NODE_DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree: its number, its place, its weight."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Shard]:
    """Shards 0..n-1 of weight 1 in regions of equal build."""
    per_region = racks_per_region * shards_per_rack
    return [Shard(i, f"g{i // per_region}", f"k{i % per_region // shards_per_rack}") for i in range(shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, alone in the rack of a region of its own."""
    new = max(s.shard for s in tree) + 1
    return [*tree, Shard(new, f"g+{new}", "k0", weight)]


def _draw(key: Column, child: Column) -> Column:
    """-ln(u) / weight for one child; u in (0, 1) from the first 52 bits of md5."""
    hashed = F.md5(F.concat(key, child["path"]).cast("binary"))
    number = F.conv(F.substring(hashed, 1, NODE_DIGITS), 16, 10).cast("double")
    return -F.log((number + F.lit(0.5)) / F.lit(float(1 << 4 * NODE_DIGITS))) / child["weight"]


def _winner(key: Column, children: Column) -> Column:
    """The ``node`` of the child with the smallest draw."""
    drawn = F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c["node"].alias("node")))
    return F.array_min(drawn)["node"]


def _node(path: str, weight: float, node: int) -> Column:
    return F.struct(F.lit(path).alias("path"), F.lit(float(weight)).alias("weight"), F.lit(node).alias("node"))


def _levels(shards: list[Shard]) -> tuple[Column, Column, Column]:
    """Children of the root, of each region and of each rack, as arrays."""
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in shards:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    top, middle, low = [], [], []
    for i, (region, racks) in enumerate(regions.items()):
        top.append(_node(f"/{region}", sum(s.weight for own in racks.values() for s in own), i))
        row = []
        for rack, own in racks.items():
            row.append(_node(f"/{region}/{rack}", sum(s.weight for s in own), len(low)))
            low.append(F.array(*[_node(f"/{region}/{rack}/{s.shard}", s.weight, s.shard) for s in own]))
        middle.append(F.array(*row))
    return F.array(*top), F.array(*middle), F.array(*low)


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The shard of a row; ``key`` is any column, null being a key of its own.

    Shards of weight 0 or less take no rows.
    """
    live = [s for s in tree if s.weight > 0]
    if not live:
        raise ValueError("a tree needs a shard of positive weight")
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    top, middle, low = _levels(live)

    def descend(name: Column) -> Column:
        rack = let(_winner(name, top), lambda region: _winner(name, F.get(middle, region)))
        return let(rack, lambda k: _winner(name, F.get(low, k)))

    return let(text, descend).cast("int")


def assign(df: DataFrame, key: str, tree: list[Shard], shard: str = "shard") -> DataFrame:
    """Add the shard of each row (no shuffle)."""
    return df.withColumn(shard, shard_of(F.col(key), tree))


def slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """Add each row's gapless place from 0 within its shard.

    Places follow the first hex digits of md5 of the first ``order`` column,
    then ``order``.
    """
    digits = F.substring(F.md5(F.coalesce(F.col(order[0]).cast("string"), F.lit("")).cast("binary")), 1, 3)
    return numbered(df, [shard], order, slot, deal=F.conv(digits, 16, 10).cast("int"))
