"""A corpus pipeline: each stage works on all that its predecessor kept.

toxicity (rejected documents go) -> exact dedup (one of each group of equal texts
stays) -> n-gram Jaccard join (one of each group of near copies stays) -> mixing
(documents are taken as often as the mix says) -> byte-level BPE (token ids).

``run`` writes each stage as Parquet to the session's checkpoint folder and reads
it again for the next one, so a lost executor never goes back beyond a stage.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablepulse.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from tablepulse.llm.common import documents, importable, labels
from tablepulse.session import work_path

#: near copies: shingles of five words, similarity of 0.8 or more
NEAR_WORDS, NEAR_THRESHOLD = 5, Fraction(8, 10)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    importable(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels(spark, sf_dir)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    importable(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without shingles stay."""
    importable(spark)
    return ngram_join.keep_first(docs, NEAR_WORDS, NEAR_THRESHOLD)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    importable(spark)
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix."""
    importable(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.token_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: the trained classifier cannot be expressed in SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        out = work_path(spark, "pipeline", name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
