"""Personal data: base spans against the plain patterns, labelers, fits and odd rows."""

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import weak_pii
from strata.llm.queries import QUERIES

# The patterns as the contract gives them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, own):
    digits = re.sub(r"[^0-9]", "", own)
    if kind == "ip":
        return all(int(p) <= 255 for p in own.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    """(start, kind number, end) of every base span."""
    return sorted(
        (m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())
    )


def own(text):
    good, _ = weak_pii.base_spans(text)
    return sorted((s, k, e) for k, spans in enumerate(good) for s, e in spans)


PIECES = st.sampled_from(
    ["a", "b-c", "_", "%", ".", "..", "@", "@@", "x.y", " ", "  ", "-", "+", "(", ")", "0", "1", "42", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "+1 (171) 555-2028", "a@b.c", "\n", "é", "🙂", "٣"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert own(text) == plain(text)


def test_scans_of_long_texts_stay_linear():
    for piece in ("x", "1", "1.", "a@", "a@b", "+", "+1", "((", "1 ", "@", "a:", ":", " at a", "1-", "1 ("):
        text = piece * (300_000 // len(piece)) + " end"
        began = time.perf_counter()
        weak_pii.scan(text)
        assert time.perf_counter() - began < 20, piece
    assert own("x" * 100_000 + "@y.z " + "1" * 50_000) == [(0, 0, 100_004)]


def listed(spans):
    return ",".join(f"{weak_pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_given_documents(spark):
    data = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_weak_supervision"](spark, data).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        base = plain(texts[r.doc_id])
        found += len(base)
        assert [r[f"n_{kind}"] for kind in PLAIN] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed(base).split(",")) - {""} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), list(PLAIN).index(s.split(":")[0])))
        # A text without digits, @ or a written address is clean.
        if not re.search(r"[0-9@]| dot |\[dot\]|\(dot\)", texts[r.doc_id] or "", re.I):
            assert not spans
    assert found > 50


def test_em_finds_who_is_right():
    turn = np.random.default_rng(2)
    right = np.array([0.95, 0.85, 0.8, 0.55, 0.9, 0.75])  # the fourth labeler guesses
    silent = np.array([0.0, 0.2, 0.1, 0.0, 0.5, 0.5])
    counts, kinds = {}, {}
    for _ in range(4000):
        true = turn.random() < 0.4
        say = np.where(turn.random(6) < right, 1, -1) * (1 if true else -1)
        code = weak_pii.pattern(tuple(np.where(turn.random(6) < silent, 0, say).tolist()))
        counts[code] = counts.get(code, 0) + 1
        kinds.setdefault(code, []).append(true)
    found = weak_pii.em(counts)
    assert found.share == pytest.approx(0.4, abs=0.04)
    yes = found.rates[:, 1, 2] / (found.rates[:, 1, 2] + found.rates[:, 1, 0])
    assert np.abs(yes - right).max() < 0.08
    hits = sum((found.truth[c] >= 0.5) == t for c, own_kinds in kinds.items() for t in own_kinds)
    assert hits / 4000 > 0.95
    assert weak_pii.unpattern(weak_pii.pattern((1, 0, -1, 1, 0, -1))) == [1, 0, -1, 1, 0, -1]


def test_logistic_learns_soft_targets():
    rows = [[0, 5], [0, 6], [0, 5, 6]]
    w = weak_pii.logistic(rows, np.array([0.9, 0.1, 0.5]), np.array([5.0, 5.0, 5.0]))
    chance = [1 / (1 + np.exp(-w[r].sum())) for r in rows]
    assert np.allclose(chance, [0.9, 0.1, 0.5], atol=0.05)


def test_added_spans_are_learned(spark):
    """Numbers in national form and written-out addresses beside telling words are
    found; dates, versions and order numbers of the same shapes are not."""
    turn = np.random.default_rng(7)
    d = lambda n: "".join(map(str, turn.integers(0, 10, n)))
    rows, expected = [], {}

    def add(text, kind=None, span=None):
        rows.append((len(rows), text))
        expected[len(rows) - 1] = f"{kind}:{text.index(span)}:{text.index(span) + len(span)}" if span else ""

    for i in range(60):
        phone = f"({2 + i % 7}{d(2)}) 555-{d(4)}"
        add(f"for help call our phone {phone} any time", "phone", phone)
        plus = f"+1 ({2 + i % 7}{d(2)}) 555-{d(4)}"
        add(f"the phone is {plus} by day", "phone", plus)
        address = f"jo{i} (at) mail{i % 3} (dot) example (dot) com"
        add(f"write an email to {address} please", "email", address)
        real = f"ann{i}@mail.example.com"
        add(f"her email is {real} now", "email", real)
        add(f"on the date 20{d(2)}-0{1 + i % 9}-1{i % 9} it rained")
        add(f"see order no 7{d(12)} of the invoice")
        add("prose without anything to find in it")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.spans for r in weak_pii.find(docs).select("doc_id", weak_pii.listed(F.col("spans")).alias("spans")).collect()}
    wrong = {i: (found[i], e, rows[i][1]) for i, e in expected.items() if found[i] != e}
    assert len(wrong) <= 0.02 * len(rows), list(wrong.values())[:5]


def test_odd_documents(spark, odd_docs):
    docs = odd_docs.withColumns({n: odd_docs.doc_id for n in ("spans", "key", "candidates")})
    rows = weak_pii.find(docs).collect()
    assert len(rows) == docs.count() and {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
    assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3))
    assert weak_pii.find(docs.limit(0)).count() == 0
    none = weak_pii.find(spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")).collect()
    assert none[0].spans == []


def test_redacted():
    text = "mail a@b.co or 1.2.3.4"
    spans = weak_pii.chosen([dict(zip(("kind", "start", "end", "base", "pattern", "features"), c)) for c in weak_pii.scan(text)], weak_pii.Model())
    assert weak_pii.redacted(text, spans) == "mail <email> or <ip>"
