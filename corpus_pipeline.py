"""The corpus pipeline over ``documents``: five stages, each one operator of ``pluvio.llm``.

A stage takes what the one before kept, its rows written as Parquet and read
again. All but the last return the columns of ``documents``; the last returns
the token ids of every document that is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import bpe, chosen_path, decontaminate, quality, suffix
from pluvio.llm.common import staged, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose perplexity under trusted text is no higher than their language's threshold."""
    trusted = quality.trusted_ids(table(spark, folder, "labels"), F.col("quality") == 1)
    return quality.accepted(docs, trusted)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents linked by 0.8 or more of five-word shingles, the one with the smallest id."""
    return chosen_path.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the bytes that 200-byte strings repeat."""
    return suffix.without_repeats(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, folder, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=("lang", "source"))
    both = bpe.decode(coded, ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("near-duplicates", one_of_each_group),
    ("repeats", cut_repeats),
    ("benchmark", drop_benchmark),
    ("tokens", tokens),
]

#: Models, similarity classes and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
