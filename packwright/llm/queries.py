"""Queries opN_<name> over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.llm import bpe, conversation_repair, decontamination, html_text, licenses, manifest, neighbours, ngram_join, quality, quotations, suffix_dedup, token_counts, toxicity
from packwright.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL if there is one."""

    def register(function: Query) -> Query:
        LLM_QUERIES[function.__name__] = function
        if sql is not None:
            LLM_ORACLE[function.__name__] = sql.strip()
        return function

    return register


#: SQL for the pages of the test tables, whose main text is what ``article`` holds.
ARTICLES = r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?(p|h1)>') AS parts FROM pages),
b AS (
  SELECT page_id, url, [trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<br>', ' ', 'g').regexp_replace('<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) FOR x IN parts] AS blocks FROM a)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x != ''), chr(10) || chr(10)) AS text,
  length(array_to_string(list_filter(blocks, lambda x: x != ''), chr(10) || chr(10))) AS n_chars FROM b"""


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by a byte-level BPE, decoded again; digests of both."""
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text, and whether they pass 512 tokens."""
    model = token_counts.load_model(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), model, limit=512)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text is divisible by five."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model trained on the labels that are not held out."""
    documents = read(spark, sf_dir, "documents")
    model = toxicity.train(documents, read(spark, sf_dir, "labels"), "toxic", trained_on=~held_out())
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "worst_sentence", "worst_score")


@query(suffix_dedup.SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without those in 13-word windows of a smaller document."""
    return suffix_dedup.digest(read(spark, sf_dir, "documents"), window=13)


@query(ngram_join.SQL)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 4-word shingles share 85 percent or more."""
    return ngram_join.classes(read(spark, sf_dir, "documents"), words=4, percent=85)


@query()
def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, word for word or with other numbers and names."""
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query(ARTICLES)
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


@query(quotations.SQL)
def op9_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in reply order, quotations linked and taken out."""
    return quotations.conversations(read(spark, sf_dir, "conversations"))


@query(licenses.sql())
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license notices of every document."""
    return licenses.scan(read(spark, sf_dir, "documents"))



@query()
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a network trained on the labels that are not held out."""
    documents = read(spark, sf_dir, "documents")
    model = quality.train(documents, read(spark, sf_dir, "labels"), "quality", trained_on=~held_out())
    scored = quality.score(documents, model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII text, bit by bit."""
    polynomial = 0xEDB88320
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, {polynomial} * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST({0xFFFFFFFF} AS BIGINT), {codes}), lambda c, b: {byte}), CAST({0xFFFFFFFF} AS BIGINT))"


@query(manifest.sql(crc32_sql("CAST(doc_id AS VARCHAR)")))
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; every other one is tampered with and checked."""
    tamper = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest.manifest(read(spark, sf_dir, "documents"), tamper=tamper)


@query(conversation_repair.sql(crc32_sql("key")))
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after damage."""
    return conversation_repair.repair(conversation_repair.damaged(read(spark, sf_dir, "conversations")))
