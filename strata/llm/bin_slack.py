"""Best-fit packing by minimum bin slack (operator 5).

Documents become token sequences of at most ``capacity`` tokens; sequences
are then filled with pieces so that each leaves as little slack as possible.

The fullest filling of a bin depends only on how many pieces of each length
are left, and a length is at most ``capacity``.  So Spark counts the pieces by
length (never more than ``capacity`` rows), the driver runs the subset-sum
search on these counts, and Spark places every piece by its number among the
pieces of its length.  The search repeats a filling as often as the counts
allow: while they do, it stays the fullest one.  The number of searches is
therefore bounded by the capacity, not by the number of documents.

Cases: a null text counts as empty; an empty text has only the closing id;
texts of any length are cut into whole pieces, the first may be shorter; equal
rows are placed one by one; of equally full fillings the one that the longest
lengths reach first is taken, and pieces of one length are alike, whichever of
them goes where; an empty table gives no rows; other columns are
left out, whatever their names.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, numbered, small_batches
from strata.llm.pair_bpe import byte_symbols

CAPACITY = 2048
CLOSING_ID = 0

# Words whose ids one Python worker keeps; then it starts anew (memory bound).
CACHE_WORDS = 500_000

WHITE_RUN = regex.compile(r"\s\s")
# Fixed: the split pattern of byte-level tokenizers that use their regex.
SPLIT = regex.compile(public_tokenizers.PATTERN)

MARKS = ".,;:!?|"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds(dict):
    """Little-endian ids of ``prefix + word``; unknown words go to ``encode``."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out = self.encode(self.prefix + word)
        return out


class DocumentIds:
    """Ids of whole texts as the tokenizer gives them, word by word.

    The file's split pattern ends a stretch before each blank that a visible
    character follows and around single line ends, so the words between them
    can be encoded apart.  A word is split by the pattern, and the tokenizer's
    model encodes each stretch once.  Texts with runs of white space or with an
    added token, and files of another build, are encoded whole.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(tokenizer_json)
        split = spec["pre_tokenizer"] or {}
        self.by_word = (
            spec["model"]["type"] == "BPE"
            and not spec["normalizer"]
            and not spec["model"].get("ignore_merges")
            and (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        )
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.stretches: dict[str, bytes] = {}
        self.first, self.later = WordIds(self.word, ""), WordIds(self.word, " ")

    def word(self, text: str) -> bytes:
        # Most words are letters, perhaps with a closing mark: no pattern needed.
        body = text[1:] if text[0] == " " else text
        if body.isalpha():
            parts = [text]
        elif body[:-1].isalpha() and body[-1] in MARKS:
            parts = [text[:-1], text[-1]]
        else:
            parts = SPLIT.findall(text)
        return b"".join([self.stretches.get(s) or self.stretch(s) for s in parts])

    def stretch(self, text: str) -> bytes:
        if len(self.stretches) >= CACHE_WORDS:
            self.stretches.clear()
        plain = text[1:] if text[0] == " " else text
        if plain.isascii() and plain.isalpha():  # letters stand for themselves
            symbols = text if plain is text else self.symbols[32] + plain
        else:
            symbols = "".join([self.symbols[b] for b in text.encode()])
        self.stretches[text] = out = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        return out

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_word or WHITE_RUN.search(text) or any(t in text for t in self.added):
            return self.whole(text)
        out, later, line_end = [], self.later.__getitem__, None
        for line in text.split("\n"):
            if line_end is not None:
                out.append(line_end)
            words = line.split(" ")
            if words[0]:
                out.append(self.first[words[0]])
            out.extend(map(later, words[1:]))
            line_end = self.first["\n"]
        return b"".join(out)


@lru_cache(maxsize=2)
def document_ids(tokenizer_json: str) -> DocumentIds:
    """One per Python worker, so that its tasks share the words they have met."""
    return DocumentIds(tokenizer_json)


def spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    head = n % capacity or min(n, capacity)
    cuts = [0, *range(head, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def pieces(
    docs: DataFrame,
    tokenizer_json: str,
    capacity: int = CAPACITY,
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 [, ids]."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = document_ids(shared.value)
        closing = array("I", [CLOSING_ID]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(ids_of(body.as_py()) + closing)
                for k, (start, length) in enumerate(spans(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, k, start, length, zlib.crc32(own))
                    rows.append((*row, np.frombuffer(own, "<i4").tolist()) if with_ids else row)
            fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
            fields += [("ids", pa.list_(pa.int32()))] * with_ids
            columns = list(zip(*rows)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, schema)


def fullest(room: int, left: dict[int, int], lengths: list[int]) -> list[tuple[int, int]]:
    """The fullest choice of (length, times) within ``room``.

    Bit s of ``reach`` says that some choice has the sum s.  Lengths come
    longest first, each up to its count, by doubling; the search ends at the
    first perfect fit.  The way back through the kept bitsets gives the choice.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for n in lengths:
        if n > room or not left[n]:
            continue
        steps.append((n, reach))
        times, take = min(left[n], room // n), 1
        while times:
            take = min(take, times)
            reach |= (reach << (n * take)) & mask
            times -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= n
            times += 1
        if times:
            chosen.append((n, times))
    return chosen


def fill_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Fill bins until no piece is left; returns (segments, number of bins).

    The longest piece left opens a bin, subset sums find the fullest rest, and
    the filling repeats while its pieces last.  A segment (length, first, bin,
    times, offset) says: the pieces of this length numbered from ``first`` go
    to the bins from ``bin`` on, ``times`` to each, side by side from
    ``offset``.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    segments, bins = [], 0
    lengths = sorted(left, reverse=True)
    while lengths:
        opener = lengths[0]
        left[opener] -= 1
        combo = {opener: 1}
        for n, times in fullest(capacity - opener, left, lengths):
            combo[n] = combo.get(n, 0) + times
        left[opener] += 1
        repeats = min(left[n] // times for n, times in combo.items())
        offset = 0
        for n in sorted(combo, reverse=True):
            segments.append((n, used[n], bins, combo[n], offset))
            offset += n * combo[n]
            used[n] += repeats * combo[n]
            left[n] -= repeats * combo[n]
        bins += repeats
        lengths = [n for n in lengths if left[n]]
    return segments, bins


def pack(sized: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Place rows by their ``length`` (1 to ``capacity``) into sequences.

    Adds sequence_id and offset.  ``sized`` is read three times: pass a
    checkpointed frame.
    """
    counts = {r["length"]: r["n"] for r in sized.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    segments, _ = fill_plan(counts, capacity)
    table = np.array(sorted(segments), dtype=np.int64).reshape(-1, 5)
    by_length = {int(n): table[table[:, 0] == n] for n in np.unique(table[:, 0])}
    ranked = numbered(sized, ["length"], list(order), "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            length, rank = (table[c].to_numpy().astype(np.int64) for c in ("length", "rank"))
            bin_no, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                seg = by_length[int(n)]
                seg = seg[np.searchsorted(seg[:, 1], rank[own], side="right") - 1]
                nth = rank[own] - seg[:, 1]
                bin_no[own] = seg[:, 2] + nth // seg[:, 3]
                offset[own] = seg[:, 4] + nth % seg[:, 3] * n
            table = table.drop_columns("rank").append_column("sequence_id", pa.array(bin_no))
            yield from table.append_column("offset", pa.array(offset)).to_batches()

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut documents into pieces and pack them; one row per piece."""
    return pack(cut(pieces(docs, tokenizer_json, capacity), by=["doc_id", "piece"]), capacity)
