"""One query per operator, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bin_slack,
    centroid_langid,
    chat_quotes,
    chunk_dedup,
    conv_trie,
    covering_simhash,
    line_frequency,
    nbsvm,
    nn_descent,
    pair_bpe,
    shard_tree,
    slice_whiten,
    weak_pii,
)
from strata.llm.oracle import ORACLE
from strata.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The text of a public tokenizer file."""
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, as mail that quotes what it answers, in reply order."""
    return chat_quotes.link(chat_quotes.as_mail(table(spark, sf_dir, "conversations")))


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 for every document, by doc_id (law ``key``)."""
    tree = shard_tree.even_tree(40)
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    docs = shard_tree.assign(docs, "doc_id", tree)
    docs = shard_tree.assign(docs, "doc_id", shard_tree.grown(tree), "grown_shard")
    return shard_tree.slots(docs, "shard", ["doc_id", "text_crc32", "size"])


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and both verdicts of every document."""
    return line_frequency.judge(table(spark, sf_dir, "documents"))


def op4_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    done = pair_bpe.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return bin_slack.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def held_out() -> Column:
    """True for the third of the documents that nothing may be learned from."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % 3 == 1


def op6_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.train(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    scored = nbsvm.score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return centroid_langid.identify(docs, ~held_out(), keep=["doc_id", "held_out"])


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line chunks that stand in an earlier place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunk_dedup.dedup(docs, removed="n_removed_chunks")


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other rows of every 20th vector."""
    index = nn_descent.build(table(spark, sf_dir, "embeddings"), keep=21)
    return nn_descent.search(index, F.col("id") % 20 == 0, 20)


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return covering_simhash.near_duplicates(docs).select(
        covering_simhash.id_or_null("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        covering_simhash.id_or_null("root_doc").alias("component_id"),
    )


def op11_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, all spans."""
    found = weak_pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in weak_pii.KINDS]
    digest = F.sha2(weak_pii.listed(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, weak_pii.listed(F.col("spans")).alias("spans"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    numbered = conv_trie.turns(table(spark, sf_dir, "conversations"))
    nodes = conv_trie.with_digests(conv_trie.collapse(conv_trie.rebuild(numbered)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's place on the eight leading components."""
    return slice_whiten.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the document pipeline."""
    from corpus_pipeline import run  # it imports this module

    return run(spark, sf_dir)


def _shipped(query: Query) -> Query:
    """Python workers get this package before the query starts."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_OWN: dict[str, Query] = {
    "op1_quotation_links": op1_quotation_links,
    "op2_hash_tree": op2_hash_tree,
    "op3_line_frequency": op3_line_frequency,
    "op4_pair_index_bpe": op4_pair_index_bpe,
    "op5_min_bin_slack": op5_min_bin_slack,
    "op6_nbsvm": op6_nbsvm,
    "op7_nearest_centroid": op7_nearest_centroid,
    "op8_line_chunks": op8_line_chunks,
    "op9_nn_descent": op9_nn_descent,
    "op10_covering_simhash": op10_covering_simhash,
    "op11_weak_supervision": op11_weak_supervision,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spectrum_slicing": op13_spectrum_slicing,
    "pipeline": pipeline,
}
QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _OWN.items()}

__all__ = ["ORACLE", "QUERIES"]
