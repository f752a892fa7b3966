import hashlib
import random
import sys
from array import array
from pathlib import Path

import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from packwright.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "Hello  world\n\n it's  me", "é" * 50, "  \n\t x" * 40, "a" * 3000, "日本語 テキスト 🎉🎉", "they'll've 123 45,6", " " * 500 + "end "]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return bpe.encoding(file.read(), public_tokenizers.PATTERN)


def test_pieces_give_the_ids_of_the_whole_text(encoder):
    r = random.Random(1)
    for _ in range(60):
        text = "".join(r.choice(["ab", " ", "  ", "\n", "é", "'s", "9", "!?", "\t", "日"]) for _ in range(r.randint(0, 400)))
        cut = list(bpe.pieces(text, 7))
        assert "".join(cut) == text
        assert [i for p in cut for i in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)


def test_round_trip_and_digests(spark, encoder):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (99, "word " * 30_000, "long")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string")
    ranks = bpe.load_ranks(spark, PATH)
    found = bpe.round_trip(df, ranks, public_tokenizers.PATTERN).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, text, _ in rows:
        ids = encoder.encode_ordinary(text or "")
        assert by_id[i]["n_tokens"] == len(ids)
        assert by_id[i]["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert by_id[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode(df, ranks, public_tokenizers.PATTERN)
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(encoded, ranks, public_tokenizers.PATTERN).collect()}
    assert decoded == {i: (t or "").encode() for i, t, _ in rows}


def test_empty_table(spark):
    ranks = bpe.load_ranks(spark, PATH)
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(df, ranks, public_tokenizers.PATTERN).count() == 0


def test_last_stage_decodes_its_ids(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in corpus_pipeline.token_ids(spark, df, "").collect()}
    assert {i: r["decoded_sha256"] for i, r in found.items()} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(TEXTS)}
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in found.values())
