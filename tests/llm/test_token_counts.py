import random

import public_tokenizers
from tokenizers import Tokenizer

from packwright.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library(spark):
    r = random.Random(2)
    bits = ["the", " ", "  ", "\n", "é", "'s", "12", "!?", "\t", "日本", "<|endoftext|>", "Ж", "ا", " ", "\x85", "՘", "🎉", "don't", "\x1c", "²"]
    texts = [None, "", "<|endoftext|>", "a<|endoftext|> b", " x" * 4000]
    texts += ["".join(r.choice(bits) for _ in range(r.randint(1, 60))) for _ in range(300)]
    texts += ["".join(r.choice(bits[:8]) for _ in range(r.randint(1, 60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")
    found = {x["doc_id"]: x for x in token_counts.count_tokens(df, token_counts.load_model(spark, PATH), limit=20, table=8).collect()}
    library = Tokenizer.from_file(PATH)
    for i, text in enumerate(texts):
        n = len(library.encode(text or "", add_special_tokens=False))
        assert (found[i]["n_tokens"], found[i]["n_bytes"], found[i]["over_limit"]) == (n, len((text or "").encode()), n > 20), text


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 3)
    lengths = token_counts.Lengths(Tokenizer.from_file(PATH), {" the": 1})
    words = [f" word{i}" for i in range(20)] * 2
    assert [lengths[w] for w in words] == [len(lengths.tokenizer.encode(w, add_special_tokens=False)) for w in words]
    assert len(lengths) <= 5


def test_table_is_bounded_and_empty_input_works(spark):
    df = spark.createDataFrame([(1, "a a a b b c"), (2, None)], "doc_id bigint, text string")
    assert token_counts.frequent_words(df, "doc_id", "text", 2) == ["a", "b"]
    assert token_counts.count_tokens(df.limit(0), token_counts.load_model(spark, PATH)).count() == 0


def test_long_words_enter_no_table(spark):
    text = "short " + "long" * 5000
    df = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    assert token_counts.frequent_words(df, "doc_id", "text", 5) == ["short"]
    lengths = token_counts.Lengths(Tokenizer.from_file(PATH), {})
    assert lengths["x" * 1000] == len(lengths.tokenizer.encode("x" * 1000, add_special_tokens=False)) and not lengths
    library = Tokenizer.from_file(PATH)
    found = token_counts.count_tokens(df, token_counts.load_model(spark, PATH)).first()
    assert found["n_tokens"] == len(library.encode(text, add_special_tokens=False))
