"""Token counts of whole texts without moving a single pre-token between tasks.

Two tiers answer how many tokens a pre-token has. The first is a compact table of frequent
pre-tokens, found in a pass over all texts (each task counts its own words and keeps the most
frequent ones, so the pass shuffles short lists only) and broadcast; its size is ``TABLE``. The
second is a cache in each worker for the rest; what is in neither is encoded by the tokenizers
library and kept, up to ``CACHE`` entries. Words of more than ``LONGEST`` characters, such as texts
without spaces, enter neither tier, so that both have a bound in bytes. Neither tier changes a count, only the time it takes.

Texts of Latin script are cut into pre-tokens by a pattern for Latin letters, other common scripts
by one with Unicode classes, and a text with any other character is counted by the library as a
whole: Unicode versions differ in the classes of rare characters. The strings of added special
tokens inside a text count as one token each, as the library has it by default.

A null text is empty and has 0 bytes and 0 tokens; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packwright.llm.components import Scratch
from packwright.llm.frames import batch, keyed, steps, strings, task_map

#: Entries of the broadcast table, and of a task's list of frequent words.
TABLE = 1 << 14
#: Entries of a worker's cache; it is emptied when full.
CACHE = 1 << 20
#: Characters of a word or pre-token, up to which it is counted or kept; texts without spaces are longer.
LONGEST = 64
#: Distinct words a task counts before it drops the rare ones.
COUNTED = 1 << 18

# The white space, letters and digits of Unicode below U+02C2.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02c1"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"


def _pattern(letters: str, digits: str) -> str:
    return (
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{_SPACE}{letters}{digits}]+"
        rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    )


_LATIN = re.compile(_pattern(_LETTERS, _DIGITS))
_COMMON = regex.compile(_pattern(r"\p{L}", r"\p{N}"))
_BEYOND_LATIN = re.compile("[^\x00-\u02c1\u2010-\u205e\u20a0-\u20bf]")
_BEYOND_COMMON = re.compile("[^\x00-\u052f\u2010-\u205e\u20a0-\u20bf\u3000-\u3096\u4e00-\u9fa5\uac00-\ud7a3]")


class Lengths(dict):
    """Tokens by pre-token: the broadcast table first, then a cache that asks the library."""

    def __init__(self, tokenizer: Tokenizer, table: dict[str, int]):
        super().__init__(table)
        self.tokenizer, self.table = tokenizer, table

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE + len(self.table):
            self.clear()
            self.update(self.table)
        found = len(self.tokenizer.encode(word, add_special_tokens=False))
        if len(word) <= LONGEST:
            self[word] = found
        return found


_workers: dict[bytes, tuple[Tokenizer, re.Pattern | None, Lengths]] = {}


def _worker(model: bytes, table: dict[str, int]):
    key = hashlib.sha256(model + repr(sorted(table.items())).encode()).digest()
    if key not in _workers:
        _workers.clear()
        tokenizer = Tokenizer.from_str(model.decode())
        added = [t["content"] for t in json.loads(model).get("added_tokens", [])]
        split = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        _workers[key] = tokenizer, split, Lengths(tokenizer, table)
    return _workers[key]


def count_text(text: str, tokenizer: Tokenizer, split: re.Pattern | None, lengths: Lengths) -> int:
    """Tokens of one text."""
    if _BEYOND_LATIN.search(text) is None:
        pattern = _LATIN
    elif _BEYOND_COMMON.search(text) is None:
        pattern = _COMMON
    else:
        return len(tokenizer.encode(text, add_special_tokens=False))
    if split is None or split.search(text) is None:
        return sum(map(lengths.__getitem__, pattern.findall(text)))
    parts = split.split(text)
    return len(parts) - 1 + sum(sum(map(lengths.__getitem__, pattern.findall(p))) for p in parts)


def frequent_words(df: DataFrame, id_col: str, text_col: str, size: int = TABLE) -> list[str]:
    """The most frequent words of all texts, at most ``size``: those from a power of two on.

    Each task drops its rare words whenever it holds ``COUNTED`` different ones, so the list is
    approximate; it is used as a cache only. How many words there are per power of two tells
    which of them fit, so no more than ``size`` words reach the driver, whatever the number of
    tasks.
    """

    def run(batches):
        counts: Counter[str] = Counter()
        for part in steps(batches):
            for text in strings(part.column("text")):
                words = text.split(" ")
                counts.update(words if max(map(len, words)) <= LONGEST else [w for w in words if len(w) <= LONGEST])
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(size)))
        top = counts.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    lists = task_map(keyed(df, id_col, text_col), run, "word string, n bigint")
    scratch = Scratch(df.sparkSession)
    summed = scratch.stored(lists.groupBy("word").agg(F.sum("n").alias("n")))
    level = F.floor(F.log2("n")).cast("int").alias("level")
    counts = {r["level"]: r["words"] for r in summed.groupBy(level).agg(F.count("*").alias("words")).collect()}
    least, total = max(counts, default=0) + 1, 0
    while least - 1 in range(64) and total + counts.get(least - 1, 0) <= size:
        least -= 1
        total += counts.get(least, 0)
    found = [r["word"] for r in summed.where(F.col("n") >= 2**least).orderBy(F.desc("n"), "word").collect()]
    scratch.clear()
    return found


def length_table(model: bytes, words: list[str], size: int = TABLE) -> dict[str, int]:
    """Token counts of the pre-tokens in these words, with a space in front; at most ``size``."""
    tokenizer, found = Tokenizer.from_str(model.decode()), {}
    for word in words:
        if _BEYOND_LATIN.search(word) is None:
            for token in _LATIN.findall(" " + word):
                if len(found) < size and token not in found:
                    found[token] = len(tokenizer.encode(token, add_special_tokens=False))
    return found


def load_model(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a tokenizer file as a broadcast."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def count_tokens(
    df: DataFrame, model: Broadcast, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", table: int = TABLE
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` of every row; ``over_limit`` is n_tokens > limit."""
    kind, spark = dict(df.dtypes)[id_col], df.sparkSession
    lengths = spark.sparkContext.broadcast(length_table(model.value, frequent_words(df, id_col, text_col, table), table))

    def run(batches):
        own, schema = _worker(model.value, lengths.value), None
        for part in steps(batches):
            texts = strings(part.column("text"))
            counts = [count_text(t, *own) for t in texts]
            schema = schema or pa.schema([part.schema.field("id"), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
            yield batch(schema, id=part.column("id"), n_bytes=[len(t.encode()) for t in texts], n_tokens=counts)

    found = task_map(keyed(df, id_col, text_col), run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return found.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
