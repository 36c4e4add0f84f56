"""BPE encoding and decoding with a pair occurrence index (operator 4).

Each task takes the words that its documents bring and has not met before,
lays their symbols out in one linked list and maps every mergeable pair to all
its positions.  A heap holds the ranks of the pairs that occur; the lowest is
applied to all its positions from left to right, and the lists of the pairs
beside each merged symbol are updated.  Documents are then put together from
their words' ids.

The tokenizer file gives vocabulary, merges, normalizer, split pattern and
added tokens.  Supported is the word-end kind: NFC, lower case, white space
dropped, byte-level symbols, a suffix on each word's last symbol, no decoder
(tokens are decoded joined by one blank).  Other files are refused.

Cases: a null text is empty; an empty text or one of white space only has no
ids and decodes to the empty text; texts of any length are taken whole; equal
rows give equal rows; pairs have different ranks, and positions of one pair that
overlap are merged from the left; an empty table gives no rows; extra columns are kept out
of the result, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stretches, and words, that a Python worker keeps ready (memory bound); beyond
# it those not met lately are dropped.
CACHE_WORDS = 300_000
# Documents put together at a time.
SLICE = 256

GAP = regex.compile(r"\p{White_Space}+")
# Controls that str.split() takes for white space and Unicode does not.
NO_GAPS = "\x1c\x1d\x1e\x1f"

MARKS = ".,;:!?|"
# Fixed: the split pattern for which a stretch of letters is one word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level files.

    Printable Latin-1 bytes stand for themselves, the others follow from 256.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PairIndex:
    """Merges the symbols of many words at once."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        self.ranks = ranks

    def encode(self, words: list[list[int]]) -> list[list[int]]:
        """``words``: initial symbol ids of each word; returns the merged ids."""
        ranks = self.ranks
        symbol: list[int] = []
        after: list[int] = []
        before: list[int] = []
        starts = []
        places: dict[tuple[int, int], list[int]] = {}
        for word in words:
            first = len(symbol)
            starts.append(first)
            symbol += word
            last = len(symbol) - 1
            before += [-1, *range(first, last)] if word else []
            after += [*range(first + 1, last + 1), -1] if word else []
            for p in range(first, last):
                pair = (symbol[p], symbol[p + 1])
                if pair in ranks:
                    places.setdefault(pair, []).append(p)
        active = [(ranks[pair][0], pair) for pair in places]
        heapq.heapify(active)
        while active:
            rank, pair = heapq.heappop(active)
            if pair not in places:
                continue
            todo = sorted(places.pop(pair))
            left, right = pair
            merged = ranks[pair][1]
            for at, p in enumerate(todo):
                q = after[p]
                # Stale positions: the symbol there was merged meanwhile.
                if symbol[p] != left or q < 0 or symbol[q] != right:
                    continue
                symbol[p] = merged
                symbol[q] = -1
                r = after[p] = after[q]
                sooner = False
                if r >= 0:
                    before[r] = p
                    sooner |= self._note(places, active, (merged, symbol[r]), p, rank)
                o = before[p]
                if o >= 0:
                    sooner |= self._note(places, active, (symbol[o], merged), o, rank)
                if sooner:  # a new pair of lower rank goes before the rest
                    places[pair] = todo[at + 1 :]
                    heapq.heappush(active, (rank, pair))
                    break
        out = []
        for first, word in zip(starts, words):
            ids, p = [], first if word else -1
            while p >= 0:
                ids.append(symbol[p])
                p = after[p]
            out.append(ids)
        return out

    def _note(self, places, active, pair, p, rank) -> bool:
        """Enter a position of a new pair; True if its rank is below ``rank``."""
        found = self.ranks.get(pair)
        if found is None:
            return False
        if pair in places:
            places[pair].append(p)
        else:
            places[pair] = [p]
            heapq.heappush(active, (found[0], pair))
        return found[0] < rank


class WordEndBpe:
    """Words to ids and decoded text, by one tokenizer file."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model = spec["model"]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (
            model["type"] != "BPE"
            or steps != ["NFC", "Replace", "Lowercase"]
            or [s.get("type") for s in splits] != ["Split", "ByteLevel"]
            or spec["decoder"]
            or model["continuing_subword_prefix"]
            or not model["end_of_word_suffix"]
        ):
            raise ValueError("not a byte-level BPE file with word ends, NFC and lower case")
        self.vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in self.vocab.items()}
        self.suffix = model["end_of_word_suffix"]
        # The file's \\s is Unicode white space; Python's has four controls more.
        self.words = regex.compile(splits[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.letters = splits[0]["pattern"]["Regex"] == WORDS
        self.index = PairIndex(
            {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(map(tuple, model["merges"]))}
        )
        symbols = byte_symbols()
        self.inner = [self.vocab.get(symbols[b]) for b in range(256)]
        self.final = {s: self.vocab.get(s + self.suffix) for s in symbols.values()}
        self.symbols = symbols
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        # Recent stretches and words, and those of before.
        self.known: dict[str, tuple[str, str, int]] = {}
        self.older: dict[str, tuple[str, str, int]] = {}
        self.merged: dict[str, list[int]] = {}

    def symbols_of(self, word: str) -> list[int]:
        """The ids a word starts from: one for each byte, the last with the suffix."""
        bytes_ = word.encode()
        ids = [self.inner[b] for b in bytes_[:-1]] + [self.final[self.symbols[bytes_[-1]]]]
        return [i for i in ids if i is not None]

    def normalized(self, text: str) -> str:
        # Letter by letter: a final sigma is lowered like any other.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str]:
        """The stretches between white space: no split or merge crosses it."""
        if any(c in text for c in NO_GAPS):
            return [s for s in GAP.split(text) if s]
        return text.split()

    def learn(self, stretches: Iterable[str]) -> None:
        """Make the stretches known; new words go through one index together."""
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        if len(self.merged) > CACHE_WORDS:
            self.merged = {}
        new = []
        for s in stretches:
            if s not in self.known:
                found = self.older.pop(s, None)
                if found:
                    self.known[s] = found
                else:
                    new.append(s)
        cut = [self.words_in(s) for s in new]
        words = list({w for parts in cut for w in parts if w not in self.merged})
        self.merged.update(zip(words, self.index.encode([self.symbols_of(w) for w in words])))
        for s, parts in zip(new, cut):
            ids = self.merged[parts[0]] if len(parts) == 1 else [i for w in parts for i in self.merged[w]]
            self.known[s] = (" ".join(map(str, ids)), " ".join([self.text_of[i] for i in ids]), len(ids))

    def words_in(self, stretch: str) -> list[str]:
        """The words of a stretch.  Most are letters with or without a closing
        mark, for which the pattern is not needed."""
        text = stretch.lower() if stretch.isascii() else self.normalized(stretch)
        if self.letters:
            if text.isalpha():
                return [text]
            if text[:-1].isalpha() and text[-1] in MARKS:
                return [text[:-1], text[-1]]
        return self.words.findall(text)

    def encode_texts(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """(ids joined by blanks, decoded text, number of ids) of each text."""
        cut = [self.pieces(t) for t in texts]
        every = set().union(*cut)
        self.learn(every - self.added.keys())
        known = self.known
        if not every.isdisjoint(self.added):
            known = known | {s: (str(i), s, 1) for s, i in self.added.items()}
        out = []
        for parts in cut:
            found = [f for f in map(known.__getitem__, parts) if f[2]]
            out.append((" ".join([f[0] for f in found]), " ".join([f[1] for f in found]), sum([f[2] for f in found])))
        return out

    def pieces(self, text: str) -> list[str]:
        """Stretches and added tokens (found in the text as it stands), in order."""
        if self.split_added is None or not any(t in text for t in self.added):
            return self.split(text)
        out, at = [], 0
        for m in self.split_added.finditer(text):
            out += [*self.split(text[at : m.start()]), m.group()]
            at = m.end()
        return out + self.split(text[at:])


@lru_cache(maxsize=2)
def word_end_bpe(tokenizer_json: str) -> WordEndBpe:
    """One per Python worker, so that its tasks share the words they have met."""
    return WordEndBpe(tokenizer_json)


def encode(docs: DataFrame, tokenizer_json: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by blanks), decoded of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_end_bpe(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                found = bpe.encode_texts([t or "" for t in batch.column(1).to_pylist()])
                ids, decoded, n = zip(*found)
                columns = (batch.column(0), n, ids, decoded)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, tuple) else c for c, (_, t) in zip(columns, fields)], [f for f, _ in fields])

    schema = "doc_id long, n_tokens long, ids string, decoded string"
    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, schema)
