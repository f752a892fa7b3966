"""Byte-level BPE encoding and decoding with a local rank file.

The vocabulary file is read by the driver and sent to the workers (it has a fixed size, about a
megabyte), so that executors need no path of their own. Every match of the pattern is merged
separately by the tiktoken library; there are no special tokens.

A null text counts as empty and gives no tokens. Repeated rows give repeated results. Texts of any
length are encoded whole: long ones are cut into pieces first, at places where two matches of the
pattern meet in any case, so the ids are those of the whole text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from packwright.llm.frames import batch, keyed, steps, strings, task_map

#: Characters from which a text is cut before the pattern runs.
PIECE = 1 << 15

_encodings: dict[bytes, tiktoken.Encoding] = {}

#: No alternative of the pattern has white space after another character, so a match ends
#: wherever white space follows something else.
_SAFE = re.compile(r"(?<=\S)(?=\s)")


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a rank file as a broadcast."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    """The tiktoken encoding of a rank file, kept by the worker."""
    key = hashlib.sha256(rank_file + pattern.encode()).digest()
    if key not in _encodings:
        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of at least ``size`` characters, cut only at safe places."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoder: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of one whole text."""
    if len(text) <= PIECE:
        return encoder.encode_ordinary(text)
    return [i for piece in pieces(text) for i in encoder.encode_ordinary(piece)]


def encode(df: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``(id_col, n_tokens, token_ids)`` of every row; no rows give no rows.

    ``decoded`` adds ``decoded_sha256``, the SHA-256 of the bytes that the ids decode to, in lower-case hex.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        encoder, schema = encoding(ranks.value, pattern), None
        for part in steps(batches):
            ids = [encode_text(encoder, t) for t in strings(part.column("text"))]
            digests = {"decoded_sha256": [hashlib.sha256(encoder.decode_bytes(x)).hexdigest() for x in ids]} if decoded else {}
            schema = schema or pa.schema([part.schema.field("id"), ("n_tokens", pa.int64()), ("token_ids", pa.list_(pa.int32())), *((n, pa.string()) for n in digests)])
            yield batch(schema, id=part.column("id"), n_tokens=[len(x) for x in ids], token_ids=ids, **digests)

    columns = f"id {kind}, n_tokens bigint, token_ids array<int>" + (", decoded_sha256 string" if decoded else "")
    found = task_map(keyed(df, id_col, text_col), run, columns)
    return found.withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """``(id_col, decoded)``: the raw bytes of each list of ids, null for a null list.

    The bytes need not be UTF-8 where a list was cut inside a character.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        encoder, schema = encoding(ranks.value, pattern), None
        for part in batches:
            schema = schema or pa.schema([part.schema.field("id"), ("decoded", pa.binary())])
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                found = [None if x is None else encoder.decode_bytes(x) for x in rows.column("token_ids").to_pylist()]
                yield batch(schema, id=rows.column("id"), decoded=found)

    source = df.select(df[id_col].alias("id"), df[ids_col].alias("token_ids"))
    return task_map(source, run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, ranks: Broadcast, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of what :func:`encode` and :func:`decode` give, in one pass over the texts.

    ``(id_col, n_tokens, ids_sha256, decoded_sha256)``: SHA-256 in lower-case hex, of the ids as
    little-endian unsigned 32-bit integers and of the decoded bytes.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        encoder, schema = encoding(ranks.value, pattern), None
        for part in steps(batches):
            counts, ids_sha, text_sha = [], [], []
            for text in strings(part.column("text")):
                ids = encode_text(encoder, text)
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(array("I", ids).tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(encoder.decode_bytes(ids)).hexdigest())
            schema = schema or pa.schema(
                [part.schema.field("id"), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
            )
            yield batch(schema, id=part.column("id"), n_tokens=counts, ids_sha256=ids_sha, decoded_sha256=text_sha)

    columns = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return task_map(keyed(df, id_col, text_col), run, columns).withColumnRenamed("id", id_col)
