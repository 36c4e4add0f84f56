"""BPE and packing against the tokenizers library and plain searches."""

import hashlib
import itertools
import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import bin_slack, pair_bpe
from strata.llm.queries import QUERIES, tokenizer
from tests.llm.conftest import SMALL

ALPHABET = [*" \n\t'sdtrelvm", *"aZé1½²!?.,;_-ßΣσςİÅẞ漢🙂\x1c\x1d\x85 \xa0\x0b", "é", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "\r\n", "  "]


def odd_texts(n, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 16))) for _ in range(n)]


def test_word_end_ids_and_text_are_the_librarys():
    own, lib = pair_bpe.WordEndBpe(tokenizer("word_bpe_49k.json")), Tokenizer.from_str(tokenizer("word_bpe_49k.json"))
    texts = [*odd_texts(3000), "a" * 3000, "Hello world " * 50]
    for text, found in zip(texts, own.encode_texts(texts)):
        ids = lib.encode(text, add_special_tokens=False).ids
        assert found == (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False), len(ids)), repr(text)


def test_small_caches_change_nothing(monkeypatch):
    texts = odd_texts(400, 2)
    whole = pair_bpe.WordEndBpe(tokenizer("word_bpe_49k.json")).encode_texts(texts)
    monkeypatch.setattr(pair_bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bin_slack, "CACHE_WORDS", 5)
    own = pair_bpe.WordEndBpe(tokenizer("word_bpe_49k.json"))
    assert [own.encode_texts([t])[0] for t in texts] == whole
    lib, ids = Tokenizer.from_str(tokenizer("byte_bpe_50k.json")), bin_slack.DocumentIds(tokenizer("byte_bpe_50k.json"))
    assert all(array("I", lib.encode(t, add_special_tokens=False).ids).tobytes() == ids(t) for t in texts)


def test_a_lower_rank_that_appears_goes_first():
    # (2, 3) -> 9 has rank 0 and appears only after (1, 1) -> 2 of rank 1.
    own = pair_bpe.PairIndex({(2, 3): (0, 9), (1, 1): (1, 2), (3, 1): (2, 7)})
    assert own.encode([[1, 1, 3, 1, 1], [], [3]]) == [[9, 2], [], [3]]
    assert own.encode([[1, 1, 1]]) == [[2, 1]]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        pair_bpe.WordEndBpe(tokenizer("byte_bpe_50k.json"))


def test_bpe_query(spark):
    lib = Tokenizer.from_str(tokenizer("word_bpe_49k.json"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        expected.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in QUERIES["op4_pair_index_bpe"](spark, SMALL).collect()} == expected


def test_bpe_odd_documents(spark, odd_docs):
    rows = pair_bpe.encode(odd_docs, tokenizer("word_bpe_49k.json")).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_tokens == 0 and r.ids == "" for r in rows if r.doc_id in (1, 2, 3))
    assert pair_bpe.encode(odd_docs.limit(0), tokenizer("word_bpe_49k.json")).count() == 0


def check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert sum(n for _, n in own) <= capacity
    return len(bins)


def test_packing_query(spark):
    lib, expected = Tokenizer.from_str(tokenizer("byte_bpe_50k.json")), set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = [*lib.encode(r.text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.add((r.doc_id, k, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())))
    rows = QUERIES["op5_min_bin_slack"](spark, SMALL).collect()
    assert len(rows) == len(expected) and {tuple(r)[:5] for r in rows} == expected
    used, least = check_packed(rows, 2048), -(-sum(r.length for r in rows) // 2048)
    assert used <= least + 1


def test_packing_odd_documents(spark, odd_docs):
    rows = bin_slack.pack_documents(odd_docs, tokenizer("byte_bpe_50k.json"), 256).collect()
    check_packed(rows, 256)
    assert sum(r.length for r in rows if r.doc_id in (1, 2)) == 2
    assert sum(r.piece == 0 for r in rows) == odd_docs.count()
    assert bin_slack.pack_documents(odd_docs.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0
    with_ids = bin_slack.pieces(odd_docs, tokenizer("byte_bpe_50k.json"), 256, with_ids=True).collect()
    assert all(zlib.crc32(array("I", r.ids).tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in with_ids)


def test_fullest_is_the_best_subset():
    pick = random.Random(3)
    for _ in range(300):
        left = {n: pick.randint(0, 3) for n in pick.sample(range(1, 20), 4)}
        room = pick.randint(0, 40)
        best = max(t for c in itertools.product(*(range(k + 1) for k in left.values())) if (t := sum(a * n for a, n in zip(c, left))) <= room)
        chosen = bin_slack.fullest(room, left, sorted(left, reverse=True))
        assert sum(n * t for n, t in chosen) == best and all(0 < t <= left[n] for n, t in chosen)


def test_plan_places_every_piece_once():
    pick = random.Random(4)
    counts = {n: pick.randint(1, 9) for n in pick.sample(range(1, 101), 40)}
    segments, bins = bin_slack.fill_plan(counts, 100)
    assert bins >= -(-sum(n * c for n, c in counts.items()) // 100)
    for n, c in counts.items():
        firsts = sorted(s[1] for s in segments if s[0] == n)
        assert firsts[0] == 0 and len(set(firsts)) == len(firsts) and firsts[-1] < c
