"""Approximate nearest neighbours by NN-descent (operator 9).

Equal vectors are one node, with the smallest ids that any answer can need.  A
first neighbour graph comes from blocks of nodes that random hyperplanes put
side by side.  Then each round joins, for every node, its neighbours with each
other (its own list and those that list it): a neighbour of a neighbour that
is nearer than the last one of a list takes its place.  Rounds go on until one
renews few of the links.  Queries walk the graph
greedily: of each query's best nodes, those not opened yet are opened, their
neighbours are measured, the best are kept; the walk ends when all of them are
open.  The answer is measured in double precision on the original vectors.

Nearness is the inner product.  The graph is built on vectors made equally long
by one more component, for which the largest inner product with a query is the
smallest angle.  Directions travel as float16, lengths beside them in double
precision; distances are taken from differences, so that a very long vector does
not round the others away.

Nodes, lists and pools stand in buckets by a hash of the node.  A round is four
exchanges between them (lists and who lists, asked neighbours, their vectors,
offers), a step of the walks four as well; each sends arrays of records, so rows
follow buckets and bytes, and no exchange sorts or joins links one by one.

Every row is indexed.  Lists have ``WIDTH`` neighbours; of the nodes that list a
node as many are joined in a round, first those that were not joined there
before, then by a hash; this is where the search is approximate.

Cases: rows with a null id, and vectors that are null, empty, zero or hold null
or non-finite components, take no part; if lengths differ, the most frequent
one counts; repeated rows are one; ties go to the smaller id; fewer candidates
than asked for are all returned; an empty table gives no rows; extra columns
are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut_per_core as cut
from strata.llm.common import key_join, let, release, salted_join

WIDTH = 32
TREES = 24
LEAF = 256
BLOCK = 512
SETTLED = 0.02  # a round that renews a smaller share of the links is the last
POOL = 100  # nodes that a query keeps
OPENED = 25  # of them opened at a time
ENTRIES = 8  # where every walk may begin besides the query's own node

# Nodes live in buckets.  What one bucket tells another travels as arrays in binary
# rows (bucket, kind, data), not as a row per link: a task sends a bucket one row
# per kind for each ``LETTERS`` bytes that it has to send.
FEW, MANY, FULL = 256, 1024, 16_384  # nodes of a bucket, buckets, nodes beyond which buckets grow in number again
LETTERS = 8 << 20
AROUND = 64  # centres joined at a time
STEP = 1 << 16  # pairs measured at a time
MAIL = "bucket int, kind int, data binary"


@dataclass
class Index:
    """nodes: node, vec_1, vec_2 (hashes of the vector), ids, vec (double), packed
    (its direction in float16, ``width`` numbers), norm (its length as a share of
    the longest); graph: src, dst, sim, fresh (not
    joined among the neighbours of src yet), back (nor among those of dst);
    rows: id and vector hashes of every indexed row."""

    nodes: DataFrame
    graph: DataFrame
    rows: DataFrame
    width: int


def _unpack(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of packed directions as a matrix, of length 1 again."""
    rows = np.frombuffer(b"".join(column.to_pylist()), "<f2").reshape(-1, width).astype("f4")
    return rows / np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), np.finfo("f4").tiny)[:, None]


def _nearness(rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Minus the squared distances between all vectors, each with one more
    component that makes it as long as the longest."""
    n, rest = norms[:, None], np.sqrt((1 - norms) * (1 + norms))
    both = np.maximum(rest[:, None] + rest[None, :], np.finfo(float).tiny)
    gap, step = n - n.T, (n - n.T) * (n + n.T) / both
    return -(gap * gap + 2 * n * n.T * (1 - (rows @ rows.T).astype(float)) + step * step)


SHORT = 0.1  # a vector shorter than this share of the longest is ranked in double precision


def _nearest(ids: np.ndarray, rows: np.ndarray, norms: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` nearest rows of each row and their nearness, -inf for its own node."""
    n = min(n, len(rows))
    if exact := norms.min() < SHORT:
        rank = _nearness(rows, norms)
    else:
        dots, short, rest = rows @ rows.T, norms.astype(np.float32), np.sqrt((1 - norms) * (1 + norms)).astype(np.float32)
        rank = dots * short[:, None] * short + np.outer(rest, rest)
    rank[ids[:, None] == ids] = -np.inf
    best = np.argpartition(rank, len(rows) - n, axis=1)[:, len(rows) - n :]
    sims = np.take_along_axis(rank, best, 1)
    if not exact:
        sims = np.where(np.isfinite(sims), _apart(np.take_along_axis(dots, best, 1), norms[:, None], norms[best]), -np.inf)
    return best, sims


def _apart(dots: np.ndarray, norms: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``_nearness`` of pairs, from the products of their directions and their lengths."""
    gap, rest = norms - others, np.sqrt((1 - norms) * (1 + norms)) + np.sqrt((1 - others) * (1 + others))
    step = gap * (norms + others) / np.maximum(rest, np.finfo(float).tiny)
    return -(gap * gap + 2 * norms * others * (1 - dots.astype(float)) + step * step)


def _pack(rows: DataFrame, numbers: str, name: str) -> DataFrame:
    """Replace an array column by its numbers in float16: half the bytes in
    every shuffle.  The walk only ranks by them; answers are measured anew."""
    at = rows.columns.index(numbers)
    kept = [f for f in rows.schema if f.name != numbers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.asarray(v.values, "<f2").tobytes() for v in batch.column(at)]
            others = [batch[f.name] for f in kept]
            yield pa.RecordBatch.from_arrays([*others, pa.array(packed, pa.binary())], [*[f.name for f in kept], name])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{name}` binary"])
    return rows.mapInArrow(run, schema)


def _best(rows: DataFrame, group: str, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of each group (map tasks send no more than these)."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= n).drop("place")


HASHES = ["vec_1", "vec_2"]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id, vec (double), vec_1, vec_2 of the rows that take part, each once."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    # Adding 0 makes -0 and 0 one value.
    rows = rows.filter(F.exists("vec", lambda x: x != 0)).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    sizes = rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    if sizes:
        rows = rows.filter(F.size("vec") == sizes["n"])
    return rows.withColumns({"vec_1": F.xxhash64("vec"), "vec_2": F.xxhash64(F.lit(1), "vec")})


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """node, vec_1, vec_2, ids (the ``keep`` smallest, in order), vec of each vector."""
    ranked = rows.select("id", *HASHES).distinct()
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy(*HASHES).orderBy("id"))).filter(F.col("place") <= keep)
    ids = ranked.groupBy(*HASHES).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vecs = rows.groupBy(*HASHES).agg(F.first("vec").alias("vec"))
    return cut(key_join(ids, vecs, HASHES).withColumn("node", F.monotonically_increasing_id()))


def _direction(vec: Column) -> Column:
    """Struct of length and unit (the vector at length 1); no square over- or underflows."""

    def of(peak: Column) -> Column:
        small = F.transform(vec, lambda x: x / peak)
        length = F.sqrt(F.aggregate(small, F.lit(0.0), lambda a, x: a + x * x))
        return let(length, lambda n: F.struct((n * peak).alias("length"), F.transform(small, lambda x: x / n).alias("unit")))

    return let(F.array_max(F.transform(vec, F.abs)), of)


def _packed(nodes: DataFrame) -> DataFrame:
    """Add the packed direction and the length as a share of the longest."""
    own = nodes.withColumn("own", _direction(F.col("vec")))
    longest = own.agg(F.max("own.length")).first()[0] or 1.0
    norm = F.least(F.lit(1.0), F.col("own.length") / F.lit(longest))
    return _pack(own.select("node", *HASHES, "ids", "vec", norm.alias("norm"), F.col("own.unit").cast("array<float>").alias("unit")), "unit", "packed")


LINK = "src long, dst long, sim double, fresh boolean, back boolean"
LINKS = np.dtype([("src", "<i8"), ("dst", "<i8"), ("sim", "<f8"), ("fresh", "?"), ("back", "?")])
LISTS = np.dtype([("src", "<i8"), ("dst", "<i8", (WIDTH,)), ("sim", "<f4", (WIDTH,))])
LISTED = np.dtype([("node", "<i8"), ("other", "<i8"), ("fresh", "?"), ("draw", "<i8")])
ASKED = np.dtype([("node", "<i8"), ("centre", "<i8"), ("fresh", "?"), ("listed", "?")])
PAIRS = np.dtype([("query", "<i8"), ("node", "<i8")])
FOUND = np.dtype([("query", "<i8"), ("node", "<i8"), ("sim", "<f8")])

Letter = tuple[int, np.ndarray, np.ndarray]  # kind, buckets, a record for each


def _vectors(width: int) -> np.dtype:
    return np.dtype([("node", "<i8"), ("norm", "<f8"), ("last", "<f8"), ("vec", "<f2", (width,))])


def _queries(width: int) -> np.dtype:
    return np.dtype([("query", "<i8"), ("vec", "<f2", (width,))])


def _states(width: int) -> np.dtype:
    return np.dtype([("query", "<i8"), ("vec", "<f2", (width,)), ("node", "<i8", (POOL,)), ("sim", "<f8", (POOL,)), ("open", "?", (POOL,))])


def _buckets(count: int) -> int:
    return max(1, min(-(-count // FEW), MANY), -(-count // FULL))


def _home(nodes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each node."""
    mixed = nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _records(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(next(iter(columns.values()))), kind)
    for name, values in columns.items():
        out[name] = values
    return out


def _post(letters: Iterator[Letter]) -> Iterator[pa.RecordBatch]:
    """The letters as rows of ``MAIL``, those to one bucket together."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    sizes: dict[int, int] = {}

    def row(kind: int) -> pa.RecordBatch:
        to, what = (np.concatenate(x) for x in zip(*held.pop(kind)))
        sizes.pop(kind)
        order = np.argsort(to, kind="stable")
        to, what = to[order], what[order]
        starts = _starts(to)
        ends = np.append(starts, len(to)) * what.itemsize
        data = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(what.tobytes())])
        columns = [pa.array(to[starts], pa.int32()), pa.array(np.full(len(starts), kind), pa.int32()), data]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "data"])

    for kind, to, what in letters:
        # A batch of Arrow holds less than 2 GB.
        step = max(1, (1 << 30) // what.itemsize)
        for at in range(0, len(what), step):
            held.setdefault(kind, []).append((to[at : at + step], what[at : at + step]))
            sizes[kind] = sizes.get(kind, 0) + held[kind][-1][1].nbytes
            if sizes[kind] >= LETTERS:
                yield row(kind)
    for kind in list(held):
        yield row(kind)


def _mail(rows: DataFrame, letters: Callable[[pa.RecordBatch], Iterator[Letter]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _post(letter for batch in batches if batch.num_rows for letter in letters(batch))

    return rows.mapInArrow(run, MAIL)


class Box:
    """All that reached one bucket."""

    def __init__(self, bucket: int, data: dict[int, list[bytes]]):
        self.bucket, self.data = bucket, data

    def read(self, kind: int, dtype: np.dtype) -> np.ndarray:
        return np.frombuffer(b"".join(self.data.pop(kind, [])), dtype)

    def keep(self, kind: int, records: np.ndarray) -> Letter:
        """A letter to the same bucket."""
        return kind, np.full(len(records), self.bucket, np.int32), records


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[Box]:
    """The boxes of a task, whose rows come in the order of their buckets."""
    bucket, data = None, {}
    for batch in batches:
        for to, kind, row in zip(batch["bucket"].to_pylist(), batch["kind"].to_pylist(), batch["data"]):
            if to != bucket and data:
                yield Box(bucket, data)
                data = {}
            bucket = to
            data.setdefault(kind, []).append(row.as_buffer())
    if data:
        yield Box(bucket, data)


def _met(mail: DataFrame) -> DataFrame:
    return mail.repartition("bucket").sortWithinPartitions("bucket")


def _at_buckets(mail: DataFrame, letters: Callable[[Box], Iterator[Letter]]) -> DataFrame:
    """What each bucket sends on when it has read its mail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _post(letter for box in _boxes(batches) for letter in letters(box))

    return _met(mail).mapInArrow(run, MAIL)


def _graph_of(mail: DataFrame, links: Callable[[Box], np.ndarray]) -> DataFrame:
    """The links that each bucket makes of its mail, one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for box in _boxes(batches):
            rows = links(box)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c])) for c in LINKS.names], list(LINKS.names))

    return _met(mail).mapInArrow(run, LINK)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))


def _places(keys: np.ndarray) -> np.ndarray:
    """Each row's place in its run of equal keys."""
    starts = _starts(keys)
    return np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))


def _codes(*columns: np.ndarray) -> list[np.ndarray]:
    """Small numbers in the order of the values, the same for all columns."""
    values, codes = np.unique(np.concatenate(columns), return_inverse=True)
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of codes, in the order of the pairs."""
    return a.astype(np.int64) * (int(b.max()) + 1 if len(b) else 1) + b


def _leading(group: np.ndarray, sim: np.ndarray, n: int) -> np.ndarray:
    """Rows with the ``n`` largest ``sim`` of each group, in order; ties as they stand."""
    order = np.argsort(-sim, kind="stable")
    order = order[np.argsort(group[order], kind="stable")]
    return order[_places(group[order]) < n]


def first_graph(nodes: DataFrame, count: int, width: int) -> DataFrame:
    """Links inside blocks of nodes that random hyperplanes put together."""
    bits = min(40, max(0, math.ceil(math.log2(max(1, count) / LEAF))))
    buckets = _buckets(count)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _unpack(batch["packed"], width)
            for tree in range(TREES):
                planes = np.random.default_rng(tree).standard_normal((width, bits + 1)).astype("f4")
                side = rows @ planes
                leaf = ((side[:, :bits] > 0) @ (1 << np.arange(bits))).astype(np.int64) if bits else np.zeros(len(rows), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), tree, np.int32)), pa.array(leaf), pa.array(side[:, bits].astype(np.float64)), batch["node"], batch["packed"], batch["norm"]],
                    ["tree", "leaf", "along", "node", "packed", "norm"],
                )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[Letter]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch.select(["node", "packed", "norm"])])
            whole = table.num_rows // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                yield block(table.slice(at, BLOCK))
            held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield block(pa.Table.from_batches(held))

    def block(table: pa.Table) -> Letter:
        ids, rows, norms = table["node"].to_numpy(), _unpack(table["packed"], width), table["norm"].to_numpy()
        best, sims = _nearest(ids, rows, norms, WIDTH)
        lists = np.zeros(len(ids), LISTS)
        lists["src"], lists["sim"] = ids, -np.inf
        lists["dst"][:, : best.shape[1]], lists["sim"][:, : best.shape[1]] = ids[best], sims
        return 0, _home(ids, buckets), lists

    def merged(box: Box) -> np.ndarray:
        lists = box.read(0, LISTS)
        lists = lists[np.argsort(lists["src"], kind="stable")]
        starts, place = _starts(lists["src"]), _places(lists["src"])
        row = np.cumsum(place == 0) - 1
        dst = np.zeros((len(starts), place.max() + 1, WIDTH), np.int64)
        sim = np.full(dst.shape, -np.inf, np.float32)
        dst[row, place], sim[row, place] = lists["dst"], lists["sim"]
        dst, sim = dst.reshape(len(starts), -1), sim.reshape(len(starts), -1)
        order = np.argsort(dst, axis=1)
        dst, sim = np.take_along_axis(dst, order, 1), np.take_along_axis(sim, order, 1)
        # Of a link that several blocks made, the nearest stays.
        first = np.ones(dst.shape, bool)
        first[:, 1:] = dst[:, 1:] != dst[:, :-1]
        nearest = np.full(sim.shape, -np.inf, np.float32)
        nearest[first] = np.maximum.reduceat(sim.ravel(), np.flatnonzero(first.ravel()))
        best = np.argpartition(-nearest, WIDTH - 1, axis=1)[:, :WIDTH]
        dst, sim = np.take_along_axis(dst, best, 1), np.take_along_axis(nearest, best, 1)
        found = np.isfinite(sim)
        src = np.broadcast_to(lists["src"][starts][:, None], dst.shape)
        yes = np.ones(int(found.sum()), bool)
        return _records(LINKS, src=src[found], dst=dst[found], sim=sim[found], fresh=yes, back=yes)

    blocks = nodes.select("node", "packed", "norm").mapInArrow(placed, "tree int, leaf long, along double, node long, packed binary, norm double")
    blocks = blocks.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "along", "node")
    return _graph_of(blocks.mapInArrow(lambda batches: _post(linked(batches)), MAIL), merged)


def _listing(graph: DataFrame, salt: int) -> DataFrame:
    """node, other, fresh: at most ``WIDTH`` nodes that list the node."""
    back = graph.select(F.col("dst").alias("node"), F.col("src").alias("other"), F.col("back").alias("fresh"))
    return _best(back, "node", WIDTH, [F.desc("fresh"), F.xxhash64(F.lit(salt), "node", "other"), F.col("other")])


def _graph_mail(graph: DataFrame, buckets: int, salt: int) -> DataFrame:
    """Links to the buckets of their nodes: kind 0 of those that list, kind 1 (as
    ``LISTED``, the first ``WIDTH`` of each node in a letter) of those listed."""
    draw = F.xxhash64(F.lit(salt), F.col("dst"), F.col("src"))  # as in ``_listing``

    def letters(batch: pa.RecordBatch) -> Iterator[Letter]:
        c = {n: batch[n].to_numpy(zero_copy_only=False) for n in batch.schema.names}
        yield 0, _home(c["src"], buckets), _records(LINKS, **{n: c[n] for n in LINKS.names})
        listed = _first_listed(_records(LISTED, node=c["dst"], other=c["src"], fresh=c["back"], draw=c["draw"]))
        yield 1, _home(listed["node"], buckets), listed

    return _mail(graph.select(*LINKS.names, draw.alias("draw")), letters)


def _first_listed(listed: np.ndarray) -> np.ndarray:
    """The rows of ``_listing``, of those that one place knows."""
    listed = listed[np.lexsort((listed["other"], listed["draw"], ~listed["fresh"], listed["node"]))]
    return listed[_places(listed["node"]) < WIDTH]


def _vector_mail(nodes: DataFrame, width: int, buckets: int) -> DataFrame:
    """Directions and lengths to the buckets of their nodes, as kind 2."""

    def letters(batch: pa.RecordBatch) -> Iterator[Letter]:
        vec = np.frombuffer(b"".join(batch["packed"].to_pylist()), "<f2").reshape(-1, width)
        rows = _records(_vectors(width), node=batch["node"].to_numpy(), norm=batch["norm"].to_numpy(), vec=vec)
        yield 2, _home(rows["node"], buckets), rows

    return _mail(nodes.select("node", "packed", "norm"), letters)


def _neighbours(links: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """As ``ASKED``, by centre: each list and the nodes that list the centre (listed)."""
    no, yes = np.zeros(len(links), bool), np.ones(len(listed), bool)
    ahead = _records(ASKED, centre=links["src"], node=links["dst"], fresh=links["fresh"], listed=no)
    back = _records(ASKED, centre=listed["node"], node=listed["other"], fresh=listed["fresh"], listed=yes)
    both = np.concatenate([ahead, back])
    pair = _paired(*[_codes(both[c])[0] for c in ("centre", "node")])
    order = np.argsort(pair, kind="stable")
    starts = _starts(pair[order])
    out = both[order][starts]
    for flag in ("fresh", "listed"):
        out[flag] = np.logical_or.reduceat(both[flag][order], starts) if len(starts) else out[flag]
    return out


def _units(vec: np.ndarray) -> np.ndarray:
    rows = vec.astype("f4")
    return rows / np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), np.finfo("f4").tiny)[:, None]


SLACK = 1e-5  # more than a product of two unit vectors in single precision is off


def _offers(vectors: np.ndarray, pairs: np.ndarray) -> Iterator[np.ndarray]:
    """Links between the neighbours of each centre, as ``LINKS``."""
    vectors = vectors[np.argsort(vectors["node"])]
    pairs = pairs[np.lexsort((pairs["node"], pairs["centre"]))]
    units, norm, last = _units(vectors["vec"]), vectors["norm"], vectors["last"]
    rest = np.sqrt((1 - norm) * (1 + norm))
    # One more row for the places that a centre with fewer neighbours leaves empty.
    equal = np.zeros((len(units) + 1, units.shape[1] + 1), np.float32)
    equal[:-1, :-1], equal[:-1, -1] = units * norm[:, None], rest
    bar = np.append(1 + last / 2 - SLACK, np.inf).astype(np.float32)
    starts = _starts(pairs["centre"])
    sizes = np.diff(np.append(starts, len(pairs)))
    at = np.searchsorted(vectors["node"], pairs["node"])
    place = _places(pairs["centre"])
    for a in range(0, len(starts), AROUND):
        n, rows = sizes[a : a + AROUND], slice(starts[a], starts[a] + sizes[a : a + AROUND].sum())
        where = np.full((len(n), n.max()), len(units))
        fresh = np.zeros(where.shape, bool)
        centre = np.repeat(np.arange(len(n)), n)
        where[centre, place[rows]], fresh[centre, place[rows]] = at[rows], pairs["fresh"][rows]
        near = equal[where]
        # At least one of the two is fresh, and it beats the end of the list.
        fine = near @ near.transpose(0, 2, 1) > bar[where][:, :, None]
        fine &= fresh[:, :, None] | fresh[:, None, :]
        fine &= (where < len(units))[:, None, :]
        c, i, j = np.nonzero(fine)
        other = i != j
        src, dst, row = where[c[other], i[other]], where[c[other], j[other]], (c[other] * where.shape[1] + i[other])
        dots = np.concatenate([np.zeros(0, np.float32), *[np.einsum("ij,ij->i", units[src[y : y + STEP]], units[dst[y : y + STEP]]) for y in range(0, len(src), STEP)]])
        sim = _apart(dots, norm[src], norm[dst])
        better = np.flatnonzero(sim > last[src])
        # A list has no place for more of them.
        better = better[_leading(row[better], sim[better], WIDTH)]
        yes = np.ones(len(better), bool)
        yield _records(LINKS, src=vectors["node"][src[better]], dst=vectors["node"][dst[better]], sim=sim[better], fresh=yes, back=yes)


def improved(graph: DataFrame, nodes: DataFrame, width: int, salt: int) -> DataFrame:
    """One round: neighbours of each node are offered to each other."""
    buckets, vectors = _buckets(nodes.count()), _vectors(width)

    def ask(box: Box) -> Iterator[Letter]:
        """Each centre asks its neighbours for their vectors."""
        links, listed, own = box.read(0, LINKS), _first_listed(box.read(1, LISTED)), box.read(2, vectors).copy()
        own["last"] = -np.inf
        src, node = _codes(links["src"], own["node"])
        lowest, count = np.full(len(links) + len(own), np.inf), np.bincount(src, minlength=len(links) + len(own))
        np.minimum.at(lowest, src, links["sim"])
        full = count[node] >= WIDTH
        own["last"][full] = lowest[node[full]]
        yield box.keep(0, links)
        yield box.keep(2, own)
        met = _neighbours(links, listed)
        # Nodes with no fresh neighbour have nothing new to join.
        met = met[np.isin(met["centre"], met["centre"][met["fresh"]])]
        yield 3, _home(met["node"], buckets), met

    def answer(box: Box) -> Iterator[Letter]:
        links, own, met = box.read(0, LINKS).copy(), box.read(2, vectors), box.read(3, ASKED)
        # Each list was joined whole; of the others just the nodes that were listed.
        tried = met[met["listed"]]
        src, node = _codes(links["src"], tried["node"])
        dst, centre = _codes(links["dst"], tried["centre"])
        pair = _paired(np.concatenate([src, node]), np.concatenate([dst, centre]))
        links["fresh"], links["back"] = False, links["back"] & ~np.isin(pair[: len(links)], pair[len(links) :])
        yield box.keep(0, links)
        own = own[np.argsort(own["node"])]
        to = _home(met["centre"], buckets)
        once = np.unique(np.searchsorted(own["node"], met["node"]) * buckets + to)
        yield 2, (once % buckets).astype(np.int32), own[once // buckets]
        yield 3, to, met

    def join(box: Box) -> Iterator[Letter]:
        yield box.keep(0, box.read(0, LINKS))
        for offers in _offers(box.read(2, vectors), box.read(3, ASKED)):
            yield 1, _home(offers["src"], buckets), offers

    def merge(box: Box) -> np.ndarray:
        both = np.concatenate([box.read(0, LINKS), box.read(1, LINKS)])
        src = _codes(both["src"])[0]
        pair = _paired(src, _codes(both["dst"])[0])
        order = np.argsort(pair, kind="stable")
        starts = _starts(pair[order])
        out = both[order][starts]
        out["sim"] = np.maximum.reduceat(both["sim"][order], starts)
        for flag in ("fresh", "back"):
            out[flag] = np.logical_and.reduceat(both[flag][order], starts)
        return out[_leading(src[order][starts], out["sim"], WIDTH)]

    mail = _graph_mail(graph, buckets, salt).unionByName(_vector_mail(nodes, width, buckets))
    for letters in (ask, answer, join):
        mail = _at_buckets(mail, letters)
    return _graph_of(mail, merge)


def build(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", keep: int = 21) -> Index:
    """Index every usable row; ``keep`` is one more than the answers asked for."""
    rows = usable(vectors, vec_id, embedding)
    nodes = cut(_packed(distinct_vectors(rows, keep)))
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    width = size["width"] or 0
    lean = cut(nodes.select("node", "packed", "norm"))  # what the rounds read of them
    graph = cut(first_graph(lean, size["n"], width))
    # Sums of nearness only grow, so the rounds end.
    renewed, i = math.inf, 0
    while renewed > SETTLED * WIDTH * size["n"]:
        graph = cut(improved(graph, lean, width, i))
        release(rows)
        renewed, i = graph.filter("fresh").count(), i + 1
    return Index(nodes, graph, rows.select("id", *HASHES), width)


def search(index: Index, wanted: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of every indexed row
    for which ``wanted`` (over column id) holds, the row itself left out."""
    nodes, width = index.nodes, index.width
    # Rows with one vector share one walk.
    owners = index.rows.filter(wanted).select("id", *HASHES).distinct()
    owners = cut(salted_join(owners, nodes.select("node", *HASHES), HASHES, ["id"]).select("id", "node"))
    own = owners.select("node").distinct()
    asked = key_join(own, nodes.select("node", "vec"), ["node"]).withColumnRenamed("node", "query")
    asked = asked.withColumn("unit", _direction(F.col("vec"))["unit"].cast("array<float>"))
    asked = cut(_pack(asked, "unit", "wanted"))
    entries = nodes.select("node", F.xxhash64("node").alias("draw")).orderBy("draw", "node").limit(ENTRIES).collect()
    first = np.array([r["node"] for r in entries], np.int64)
    walk = Walk(nodes, index.graph, asked.count(), width)
    state = cut(walk.begun(asked, first))
    while not state.filter("to_open > 0").isEmpty():
        state = cut(walk.step(state))
        release(state)
    return _answers(walk.pools(state), nodes, asked, owners, k)


class Walk:
    """The greedy walks.  A query's pool stands in the query's bucket; each step its
    best nodes not opened yet name their neighbours, and those not in the pool are
    measured where they live."""

    STATE = f"{MAIL}, to_open long"

    def __init__(self, nodes: DataFrame, graph: DataFrame, queries: int, width: int):
        count = nodes.count()
        self.width, self.buckets, self.homes = width, _buckets(count), _buckets(queries)
        self.vectors = cut(_vector_mail(nodes, width, self.buckets))
        buckets = self.buckets

        def around(box: Box) -> Iterator[Letter]:
            met = _neighbours(box.read(0, LINKS), _first_listed(box.read(1, LISTED)))
            yield box.keep(0, _records(PAIRS, query=met["centre"], node=met["node"]))

        self.lists = cut(_at_buckets(_graph_mail(graph, buckets, 0), around))

    def begun(self, asked: DataFrame, first: np.ndarray) -> DataFrame:
        """The state when each query's own node and the entries are measured."""
        width, homes = self.width, self.homes

        def letters(batch: pa.RecordBatch) -> Iterator[Letter]:
            query = batch["query"].to_numpy()
            vec = np.frombuffer(b"".join(batch["wanted"].to_pylist()), "<f2").reshape(-1, width)
            state = _records(_states(width), query=query, vec=vec)
            state["sim"], state["open"] = -np.inf, True
            yield 0, _home(query, homes), state
            node = np.concatenate([query, np.tile(first, len(query))])
            pairs = _records(PAIRS, query=np.concatenate([query, np.repeat(query, len(first))]), node=node)
            yield 1, _home(pairs["query"], homes), pairs

        mail = _mail(asked.select("query", "wanted"), letters)
        state = mail.filter("kind = 0")
        return self._measured(state, mail.filter("kind = 1"))

    def step(self, state: DataFrame) -> DataFrame:
        buckets, homes, kind = self.buckets, self.homes, _states(self.width)
        state = state.select("bucket", "kind", "data")

        def opened(batch: pa.RecordBatch) -> Iterator[Letter]:
            rows = np.frombuffer(b"".join(batch["data"].to_pylist()), kind)
            i, j = np.nonzero(_now(rows))
            pairs = _records(PAIRS, query=rows["query"][i], node=rows["node"][i, j])
            yield 1, _home(pairs["node"], buckets), pairs

        def named(box: Box) -> Iterator[Letter]:
            lists, pairs = box.read(0, PAIRS), box.read(1, PAIRS)
            lists = lists[np.argsort(lists["query"], kind="stable")]
            for a in range(0, len(pairs), 16_384):
                some = pairs[a : a + 16_384]
                low, high = (np.searchsorted(lists["query"], some["node"], side) for side in ("left", "right"))
                n = high - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                query = np.repeat(some["query"], n)
                yield 1, _home(query, homes), _records(PAIRS, query=query, node=lists["node"][at])

        reached = _at_buckets(self.lists.unionByName(_mail(state, opened)), named)
        return self._measured(state, reached)

    def _measured(self, state: DataFrame, reached: DataFrame) -> DataFrame:
        """The state with what was reached in the pools, and what was opened marked."""
        width, buckets, homes, kind = self.width, self.buckets, self.homes, _states(self.width)

        def ask(box: Box) -> Iterator[Letter]:
            rows, pairs = box.read(0, kind), box.read(1, PAIRS)
            rows = rows[np.argsort(rows["query"])]
            i = np.searchsorted(rows["query"], pairs["query"])
            held = np.isfinite(rows["sim"])
            new, old = _codes(pairs["node"], rows["node"][held])
            both = _paired(np.concatenate([i, np.nonzero(held)[0]]), np.concatenate([new, old]))
            once, at = np.unique(both[: len(pairs)], return_index=True)
            at = at[~np.isin(once, both[len(pairs) :])]
            pairs, i = pairs[at], i[at]
            to = _home(pairs["node"], buckets)
            sent = np.unique(i * buckets + to)
            yield 0, (sent % buckets).astype(np.int32), _records(_queries(width), query=rows["query"][sent // buckets], vec=rows["vec"][sent // buckets])
            yield 1, to, pairs

        def measure(box: Box) -> Iterator[Letter]:
            queries, pairs, own = box.read(0, _queries(width)), box.read(1, PAIRS), box.read(2, _vectors(width))
            queries, own = queries[np.argsort(queries["query"])], own[np.argsort(own["node"])]
            wanted, rows = _units(queries["vec"]), _units(own["vec"])
            for a in range(0, len(pairs), STEP):
                some = pairs[a : a + STEP]
                i, j = np.searchsorted(queries["query"], some["query"]), np.searchsorted(own["node"], some["node"])
                sim = own["norm"][j] * np.einsum("ij,ij->i", rows[j], wanted[i])
                yield 1, _home(some["query"], homes), _records(FOUND, query=some["query"], node=some["node"], sim=sim)

        def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for box in _boxes(batches):
                rows, found = box.read(0, kind).copy(), box.read(1, FOUND)
                rows = rows[np.argsort(rows["query"])]
                rows["open"] |= _now(rows)
                i, j = np.nonzero(np.isfinite(rows["sim"]))
                query = np.concatenate([i, np.searchsorted(rows["query"], found["query"])])
                node, sim, opened = (np.concatenate([rows[c][i, j], x]) for c, x in (("node", found["node"]), ("sim", found["sim"]), ("open", np.zeros(len(found), bool))))
                order = np.argsort(node, kind="stable")
                order = order[_leading(query[order], sim[order], POOL)]
                query, place = query[order], _places(query[order])
                rows["node"], rows["sim"], rows["open"] = 0, -np.inf, True
                rows["node"][query, place], rows["sim"][query, place], rows["open"][query, place] = node[order], sim[order], opened[order]
                columns = [pa.array([x], t) for x, t in ((box.bucket, pa.int32()), (0, pa.int32()), (rows.tobytes(), pa.binary()), (int((~rows["open"]).sum()), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "data", "to_open"])

        asks = _at_buckets(state.unionByName(reached), ask)
        found = _at_buckets(asks.unionByName(self.vectors), measure)
        return _met(state.unionByName(found)).mapInArrow(settled, self.STATE)

    def pools(self, state: DataFrame) -> DataFrame:
        """query, node of all pools."""
        kind = _states(self.width)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = np.frombuffer(b"".join(batch["data"].to_pylist()), kind)
                i, j = np.nonzero(np.isfinite(rows["sim"]))
                yield pa.RecordBatch.from_arrays([pa.array(rows["query"][i]), pa.array(rows["node"][i, j])], ["query", "node"])

        return state.select("data").mapInArrow(run, "query long, node long")


def _now(rows: np.ndarray) -> np.ndarray:
    """Which nodes of each pool are opened next; pools stand in order."""
    return ~rows["open"] & (np.cumsum(~rows["open"], axis=1) <= OPENED)


def _answers(pool: DataFrame, nodes: DataFrame, asked: DataFrame, owners: DataFrame, k: int) -> DataFrame:
    """The nearest rows of each owner, measured in double precision."""
    pairs = key_join(pool.select("query", "node"), nodes.select("node", "ids", "vec"), ["node"])
    pairs = key_join(pairs, asked.select("query", F.col("vec").alias("wanted")), ["query"])
    dot = F.aggregate(F.zip_with("vec", "wanted", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    rows = pairs.select("query", dot.alias("score"), F.explode("ids").alias("vec_id"))
    rows = _best(rows, "query", k + 1, [F.desc("score"), F.col("vec_id")])
    # At most k + 1 rows per walk: one of them may be the asking row.
    lists = rows.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))).alias("found"))
    both = salted_join(owners, lists.withColumnRenamed("query", "node"), ["node"], ["id"])
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("id")), 1, k)
    out = both.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
