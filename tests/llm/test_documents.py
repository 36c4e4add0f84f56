"""Sharding, line rules, chunks, SimHash, quotes and the pipeline on fixtures."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import chat_quotes, chunk_dedup, common, covering_simhash, line_frequency, shard_tree
from strata.llm.queries import QUERIES
from tests.llm.conftest import SMALL


# sharding


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20000).withColumn("shard", F.lit("clash"))
    tree = shard_tree.even_tree(40)
    for _ in range(3):
        more = shard_tree.grown(tree)
        rows = shard_tree.assign(shard_tree.assign(df, "id", tree), "id", more, "later")
        new = more[-1].shard
        assert rows.filter((F.col("shard") != F.col("later")) & (F.col("later") != new)).count() == 0
        assert 0.6 < rows.filter(F.col("later") == new).count() * len(more) / 20000 < 1.5
        tree = more


def test_weights_move_rows_within_their_subtrees(spark):
    S = shard_tree.Shard
    tree = [S(0, "a", "x"), S(1, "a", "x"), S(2, "a", "y"), S(3, "a", "y"), S(4, "b", "x"), S(5, "b", "x", 3.0)]
    moved = [S(s.shard, s.region, s.rack, {2: 0.5, 3: 1.5}.get(s.shard, s.weight)) for s in tree]
    rows = spark.range(8000)
    rows = shard_tree.assign(shard_tree.assign(rows, "id", tree), "id", moved, "later").filter("shard != later")
    # The rack weighs the same, so rows only change between its two shards.
    assert {tuple(r) for r in rows.select("shard", "later").distinct().collect()} == {(2, 3)}
    share = {r["shard"]: r["count"] / 8000 for r in shard_tree.assign(spark.range(8000), "id", tree).groupBy("shard").count().collect()}
    assert share[5] == pytest.approx(3 / 8, abs=0.03) and share[0] == pytest.approx(1 / 8, abs=0.02)
    with pytest.raises(ValueError):
        shard_tree.shard_of(F.col("id"), [S(0, "a", "x", 0.0)])


def test_slots_are_gapless_for_odd_rows(spark, odd_docs):
    rows = shard_tree.slots(shard_tree.assign(odd_docs, "doc_id", shard_tree.even_tree(3, 1, 2)), "shard", ["doc_id", "text"]).collect()
    assert len(rows) == odd_docs.count()
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert len({r.shard for r in rows if r.doc_id is None}) == 1


def test_shard_query_sizes_and_digests(spark, tmp_path):
    """Null and very long texts, and an empty table, through the query itself."""
    import zlib

    rows = [(1, None), (2, ""), (3, "é" * 10), (4, "x" * 300_000), (None, "a"), (4, "x" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    found = QUERIES["op2_hash_tree"](spark, f"{tmp_path}/a").collect()
    expected = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=str) == expected
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert QUERIES["op2_hash_tree"](spark, f"{tmp_path}/b").count() == 0


# line rules and chunks


def test_line_rules_on_odd_documents(spark, odd_docs):
    rows = line_frequency.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert all(r.kept for r in rows if r.doc_id in (5, 6))
    kept = line_frequency.clean(odd_docs)
    assert kept.columns == odd_docs.columns and kept.schema == odd_docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}
    assert line_frequency.judge(odd_docs.limit(0)).count() == 0 and line_frequency.clean(odd_docs.limit(0)).count() == 0


def test_chunks_of_a_shared_passage_do_not_shift(spark):
    pick = random.Random(5)
    line = lambda: " ".join(pick.choice("abcdefgh") * 3 for _ in range(12))
    passage = [line() for _ in range(40)]
    docs = []
    for i in range(6):
        docs.append((i, "\n".join([*[line() for _ in range(i)], *passage, *[line() for _ in range(3)]])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in chunk_dedup.dedup(df, removed="gone").collect()}
    assert rows[0].text == docs[0][1] and rows[0].gone == 0
    for i in range(1, 6):
        left = rows[i].text.split("\n")
        # Of 40 shared lines only those at the ends of the passage, and single-line chunks, stay.
        assert sum(x in passage for x in left) < 16
        assert [x for x in left if x not in passage] == [x for x in docs[i][1].split("\n") if x not in passage]


def test_chunks_of_odd_documents(spark, odd_docs):
    done = chunk_dedup.dedup(odd_docs)
    assert done.schema == odd_docs.schema and done.count() == odd_docs.count()
    rows = done.collect()
    assert [r.text for r in rows if r.doc_id == 1] == [None] and [r.text for r in rows if r.doc_id == 2] == [""]
    # Null ids come first, so theirs is the first place of the shared text.
    whole = odd_docs.filter("doc_id = 6").first().text
    assert [r.text for r in rows if r.doc_id is None and r.text] == [whole]
    fives = [r.text for r in rows if r.doc_id == 5]
    assert len(fives) == 2 and fives[0] == fives[1] and len(fives[0]) < len(whole)
    assert all(r.n_chars == len(r.text) for r in rows if r.doc_id == 5)
    assert chunk_dedup.dedup(odd_docs.limit(0)).count() == 0


def pairs_by_brute_force(docs):
    """Texts without the lines of pairs that stand earlier; docs in order of id."""
    seen, out = {}, []
    for doc, text in docs:
        lines = text.split("\n")
        worded = [i for i, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for k, (a, b) in enumerate(zip(worded, worded[1:])):
            first = seen.setdefault("\n".join(lines[a : b + 1]), (doc, k))
            if first not in ((doc, k), (doc, k - 1)):
                gone.update(range(a, b + 1))
        out.append((doc, "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


def test_short_passages_are_found_whatever_surrounds_them(spark):
    pick = random.Random(6)
    line = lambda: " ".join(pick.choice("abcdefgh") * 3 for _ in range(12))
    docs, passages = [], []
    for size in range(2, 11):
        for n in range(10):
            passage = [line() for _ in range(size)]
            if n % 3 == 0:  # paragraphs of one line
                passage = "\n\n".join(passage).split("\n")
            passages.append(passage)
            for _ in range(2):
                docs.append((len(docs), "\n".join([*[line() for _ in range(pick.randrange(4))], *passage, *[line() for _ in range(pick.randrange(4))]])))
    odd = ["a b\na b\na b", "a b\na b\na b", "c\nc\nc\nc\nc", "x\ny\nx\ny\nx", "", "one", "\n\n", "q\n\nr", "q\nr", "q\n\nr\n"]
    docs += [(len(docs) + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, df, SMALL).collect()}
    assert rows == dict(pairs_by_brute_force(docs))
    for i, passage in enumerate(passages):
        assert not set(rows[2 * i + 1].split("\n")) & {x for x in passage if x}


def test_the_pipeline_takes_chunks_out_before_pairs(spark):
    pick = random.Random(8)
    line = lambda: " ".join(pick.choice("abcdefgh") * 3 for _ in range(12))
    passage = [line() if i % 7 else "" for i in range(60)]
    docs = [(n, "\n".join([*[line() for _ in range(n)], *passage, line()])) for n in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    chunks = {r.doc_id: r.gone for r in chunk_dedup.dedup(df, removed="gone").collect()}
    rows = {r.doc_id: r for r in chunk_dedup.dedup(df, removed="gone", pairs=True).collect()}
    assert {i: r.text for i, r in rows.items()} == dict(pairs_by_brute_force(docs))
    assert rows[0].gone == 0
    for i in (1, 2):
        # The passage has 50 pairs; those within its chunks are not compared again.
        assert chunks[i] >= 5 and chunks[i] < rows[i].gone < 50
        kept = [x for x in rows[i].text.split("\n") if x]
        assert not set(kept) & set(passage)


def shuffles(df):
    """Of the final plan, each shuffle that is not reused: its line, then those below
    it down to the next shuffle."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    tree = [(len(x) - len(x.lstrip(" :+-*()0123456789")), x.lstrip(" :+-*()0123456789")) for x in lines]
    found = []
    for i, (depth, node) in enumerate(tree):
        if node.startswith("Exchange"):
            below = []
            for d, x in tree[i + 1 :]:
                if d <= depth or "Exchange" in x:
                    break
                below.append(x)
            found.append((node, below))
    return found


def test_pairs_and_removal_share_one_shuffle_of_the_texts(spark, tmp_path):
    pick = random.Random(10)
    line = lambda: " ".join(pick.choice("abcdefgh") * 3 for _ in range(12))
    passage = [line() for _ in range(20)]
    docs = [(n, "\n".join([line(), *passage[n : n + 9], line()]), "en", "web", n) for n in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "docs"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = corpus_pipeline.lines(spark, spark.read.parquet(str(tmp_path / "docs")), SMALL)
        rows = sorted(done.collect())
        moved = shuffles(done)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [(r.doc_id, r.text) for r in rows] == pairs_by_brute_force([d[:2] for d in docs])
    assert all((r.lang, r.source, r.n_chars) == ("en", "web", r.doc_id if r.doc_id == 0 else len(r.text)) for r in rows)
    whole = [node for node, below in moved if any("FileScan" in x for x in below) and not any("Generate" in x for x in below)]
    assert len(whole) == 1
    # The pieces that are compared move once with their text.
    assert len([node for node, _ in moved if "chunk#" in node]) == 1


# SimHash


def plain_print(text, k=4):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids, radius=4):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[a] = b
    own = {}
    for i, d in enumerate(ids):
        own.setdefault(find(i), []).append(d)
    return [min((x for x in own[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_masks_cover_every_pair_within_the_radius():
    pick, looked = random.Random(6), [m & (1 << 64) - 1 for m in covering_simhash.masks(4)]
    assert len(looked) == 31 and all(20 < m.bit_count() < 44 for m in looked)
    for _ in range(3000):
        apart = sum(1 << b for b in pick.sample(range(64), pick.randint(0, 4)))
        assert any(m & apart == 0 for m in looked)


def test_simhash_query_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    prints, ids = [plain_print(d.text) for d in docs], [d.doc_id for d in docs]
    expected = {(i, f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_components(prints, ids))}
    assert {tuple(r) for r in QUERIES["op10_covering_simhash"](spark, SMALL).collect()} == expected


@pytest.mark.parametrize("block", [3, 4096])
def test_links_of_dense_prints(spark, block):
    """Clouds around a few prints, chains between them; small blocks force the second pass."""
    pick = random.Random(7)
    prints = {0, (1 << 64) - 1}
    for _ in range(4):
        centre = pick.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3))) for _ in range(60)}
        chain = centre
        for _ in range(6):
            chain ^= sum(1 << b for b in pick.sample(range(64), 4))
            prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "print long")
    found = covering_simhash.components(covering_simhash.links(nodes, 4, block))
    place = {p: i for i, p in enumerate(signed)}
    sets = {}
    for r in found.collect():
        assert r.root <= r.print
        sets.setdefault(r.root, []).append(place[r.print])
    roots = {i: min(own) for own in sets.values() for i in own}
    expected = plain_components(prints, list(range(len(prints))))
    assert [roots.get(i, i) for i in range(len(prints))] == expected


def test_simhash_odd_documents(spark, odd_docs):
    rows = covering_simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    one = covering_simhash.keep_one(odd_docs)
    assert one.schema == odd_docs.schema
    kept = one.collect()
    assert len([r for r in kept if r.text and r.text.startswith("the first of")]) == 1
    assert len([r for r in kept if not (r.text or "").strip()]) == 1
    assert covering_simhash.near_duplicates(odd_docs.limit(0)).count() == 0 and covering_simhash.keep_one(odd_docs.limit(0)).count() == 0


# quotes


def test_nested_quotes_are_linked(spark):
    rows = [
        ("c", 0, "a", "How do I  sort a list?\n\nIt has a million rows.", 1),
        ("c", 1, "b", "> how do I sort a list?\nUse sorted().", 1),
        ("c", 2, "a", ">> How do I sort a list?\n> Use sorted().\nIt is too slow.\n", 1),
        ("c", 3, "d", "A different matter.", 1),
        ("c", 4, "b", "> It has a million rows.\n\nThen sort on disk.", 1),
        ("c", 5, "e", "> never said by anyone\nHm.", 1),
        ("c", 6, "e", "> A different matter.", 1),
        ("c", 6, "e", "> A different matter.", 1),
        ("d", 0, "a", "> Use sorted().\nWhat is this?", 1),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, tie int")
    found = chat_quotes.link(df).orderBy("conv_id", "position").collect()
    own = [(r.position, r.turn, r.text, r.parent_turn, r.quote_level, r.thread_turn, r.depth) for r in found if r.conv_id == "c"]
    assert own == [
        (0, 0, "How do I  sort a list?\n\nIt has a million rows.", None, None, 0, 0),
        (1, 1, "Use sorted().", 0, 1, 0, 1),
        (2, 2, "It is too slow.", 1, 1, 0, 2),
        (3, 4, "Then sort on disk.", 0, 1, 0, 1),
        (4, 3, "A different matter.", None, None, 3, 0),
        (5, 6, "", 3, 1, 3, 1),
        (6, 5, "Hm.", None, None, 5, 0),
    ]
    other = [(r.turn, r.parent_turn, r.text) for r in found if r.conv_id == "d"]
    assert other == [(0, None, "What is this?")]  # quotes link within a conversation
    assert [(r.text, r.position) for r in found if r.conv_id is None] == [("", 0)]
    assert chat_quotes.link(df.limit(0)).count() == 0


def test_trimmed_and_interleaved_quotes_are_linked(spark):
    rows = [
        ("two lines of three", 0, "first line\nsecond line\nthird line"),
        ("two lines of three", 1, "> first line\n> second line\nreply one"),
        ("interleaved", 0, "old words"),
        ("interleaved", 1, "reply one"),
        ("interleaved", 2, "something else"),
        ("interleaved", 3, "intro a\nintro b\n> reply one\nclosing c\nclosing d"),
        ("interleaved", 4, "> intro a\n> intro b\n>> reply one\n> closing c\n> closing d"),
        ("paragraphs", 0, "one a\none b\n\ntwo\n\nthree a\nthree b"),
        ("paragraphs", 1, "one a\none b\n\nthree a"),  # holds some of it only
        ("paragraphs", 2, "> One a one b\n>\n> three b\nyes"),  # wrapped anew; cut
        ("latest", 0, "x\ny\nz"),
        ("latest", 1, "z\ny\nx"),
        ("latest", 2, "y\nw"),
        ("latest", 3, "x\nv"),
        ("latest", 4, "> x\n> y"),
        ("latest", 5, "> x\n> w\nheld by two, not by one"),
        ("whole", 0, "ok\nthen"),
        ("whole", 1, "OK"),
        ("whole", 2, "> ok\nfine"),  # the latest earlier holder, whole or in parts
        ("whole", 3, "ok"),
        ("later", 0, "> p\n> q"),
        ("later", 1, "p\nr\nq"),
        (None, None, "k\nl\nm"),
        (None, 3, "> k\n> m"),
    ]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id string, turn long, role string, text string")
    linked = chat_quotes.link(df).collect()
    assert len(linked) == len(rows)
    found = {(r.conv_id, r.turn): (r.parent_turn, r.quote_level) for r in linked if r.quote_level}
    assert found == {
        ("two lines of three", 1): (0, 1),
        ("interleaved", 3): (1, 1),
        ("interleaved", 4): (3, 1),
        ("paragraphs", 2): (0, 1),
        ("latest", 4): (1, 1),
        ("whole", 2): (1, 1),
        (None, 3): (None, 1),
    }


def test_a_long_chain_of_answers(spark):
    df = spark.createDataFrame([(1, i, "u", f"message {i}" + (f"\n> message {i - 1}" if i else "")) for i in range(40)], "conv_id int, turn int, role string, text string")
    assert [r.depth for r in chat_quotes.link(df).orderBy("position").collect()] == list(range(40))


def test_a_conversation_with_a_third_of_all_rows_and_a_very_long_message(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_PART", 50)
    monkeypatch.setattr(chat_quotes, "RANGE", 64)
    long = "\n".join(f"line {i} of a long message" for i in range(5000))
    rows = [(1, 0, "u", "start here"), (1, 1, "u", long)]
    # Everyone answers the first message, the same one over and over; every tenth answers the one before.
    rows += [(1, i, "u", f"message {i}\n> " + (f"message {i - 1}" if i % 10 == 0 else "start here")) for i in range(2, 600)]
    rows += [(1, 600, "u", "> line 7 of a long message\n> line 4000 of a long message\nyes")]
    rows += [(c, t, "u", f"own {c} {t}" + (f"\n> own {c} {t - 1}" if t else "")) for c in range(2, 250) for t in range(5)]
    found = chat_quotes.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)).collect()
    assert len(found) == len(rows)
    own = {r.turn: r for r in found if r.conv_id == 1}
    assert sorted(r.position for r in own.values()) == list(range(601))
    for i in range(2, 600):
        assert own[i].parent_turn == (i - 1 if i % 10 == 0 and i > 2 else 0), i
    assert own[600].parent_turn == 1 and own[1].text == long
    assert all(r.parent_turn == (r.turn - 1 if r.turn else None) and r.depth == r.turn == r.position for r in found if r.conv_id > 1)


# pipeline


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for no, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{no}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{no}")
        if no < 4:
            assert docs.columns == columns and docs.count() <= before.count()
        if no == 1:
            kept = {r.doc_id for r in line_frequency.judge(before).filter("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == kept
        if no == 3:
            rows = before.collect()
            prints = [plain_print(r.text) for r in rows]
            ids = [r.doc_id for r in rows]
            assert {r.doc_id for r in docs.collect()} == set(plain_components(prints, ids))
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} and len({r.doc_id for r in before.collect()}) < n
    last = docs.drop("sequence_id", "offset").collect()
    again = corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset").collect()
    assert sorted(last) == sorted(again)


@pytest.mark.parametrize("no", range(5))
def test_pipeline_stages_on_odd_documents(spark, odd_docs, no):
    stage = corpus_pipeline.STAGES[no][1]
    found = stage(spark, odd_docs, SMALL)
    assert found.count() > 0 and (no == 4 or found.columns == odd_docs.columns)
    assert stage(spark, odd_docs.limit(0), SMALL).count() == 0


def test_hot_keys_are_dealt_to_parts_by_their_count(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_PART", 10)
    left = spark.createDataFrame([(None if i % 3 == 0 else i % 7, i, "x") for i in range(300)] + [(99, 300, "x")], "a int, i int, part string")
    right = spark.createDataFrame([(None, "none")] + [(k, f"v{k}") for k in range(9)], "a int, v string")
    inner = common.dealt_join(left, right, ["a"], ["i"])
    assert inner.columns == ["a", "i", "part", "v"]
    got = sorted((r.i, r.v) for r in inner.collect())
    assert got == [(i, "none" if i % 3 == 0 else f"v{i % 7}") for i in range(300)]
    outer = common.dealt_join(left, right, ["a"], ["i"], "left")
    assert outer.count() == 301 and outer.filter("v IS NULL").collect()[0].i == 300


def test_prints_of_whole_texts():
    for text in ("", " \t", "One", "One two THREE", "Éa b c d e", "one two three four five " * 3000, "\x1c a\x0bb c\x85 d e"):
        assert covering_simhash.fingerprint(text.encode()) == plain_print(text)
