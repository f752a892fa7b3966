"""From raw documents to token ids: five stages, each on all that the one before has kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as
Parquet and read again as the next one's ``docs``. All but the last keep the columns of
``documents``. Documents whose text becomes empty stay, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.llm import bpe, decontamination, ngram_join, suffix_dedup, toxicity
from packwright.llm.components import stored
from packwright.llm.frames import read


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels of those that are here, does not reject."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), "toxic")
    return toxicity.accepted(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the smallest id."""
    return ngram_join.representatives(docs, words=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that a document with a smaller id holds too."""
    cut = suffix_dedup.remove_repeats(docs, window=50)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, token_ids, decoded_sha256)`` of every document; the digest is that of the decoded ids."""
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("decontamination", without_benchmark),
    ("byte_bpe", token_ids),
]

#: The first stage's model cannot be written in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
