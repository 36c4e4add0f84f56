"""The document pipeline: five stages, each on what the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.  Null, empty and very
long texts, repeated rows, empty tables and extra columns are handled by the
operators; their docstrings say how.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bin_slack, centroid_langid, chunk_dedup, covering_simhash, line_frequency
from strata.llm.queries import held_out, tokenizer
from strata.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the nearest centroid can tell."""
    return centroid_langid.keep_known(docs, ~held_out())


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without lines frequent on their host."""
    return line_frequency.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the content-defined line chunks that stand in an earlier
    place, then without what chunks miss of passages of two or more lines."""
    return chunk_dedup.dedup(docs, pairs=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates."""
    return covering_simhash.keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens."""
    return bin_slack.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language),
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("packing", packing),
]

#: Centroids, fingerprints and tokens are beyond SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the
    shared checkpoint folder."""
    folder = scratch_path(spark, "pipeline", uuid.uuid4().hex)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for no, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if no + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{no}")
            docs = spark.read.parquet(f"{folder}/{no}")
    return docs
