"""Random-indexing vectors against plain counting, slopes against differences, and held-out accuracy."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from packwright.llm import quality

SCHEMA = "id string, doc_id bigint, text string, label int, features string"


def plain_tokens(text: str) -> list[tuple[str, str]]:
    """Runs of letters (ASCII or other), digits, signs and line breaks, with the repetition mark."""
    found, before = [], None
    for match in re.finditer(r"[A-Za-z\x80-\U0010ffff]+|[0-9]+|\n+|[^\sA-Za-z0-9\x80-\U0010ffff\x00-\x20\x7f]+", text):
        token = match.group().lower() if match.group().isascii() else match.group()
        found.append("same" if token == before and "\n" not in token else token)
        before = token
    return found


TEXTS = ["One two, two three!! 4 44\n\nEnd", "", None, "a", "ÄÖ über über x\nY", "no no no no", "\x00 \t ", "Mixed CASE words99 and---signs"]


def test_tokens_of_plain_texts():
    first, word, shape = quality.tokens(pa.array(TEXTS, pa.string()))
    for i, text in enumerate(TEXTS):
        assert first[i + 1] - first[i] == len(plain_tokens(text or ""))
        same = [t == "same" for t in plain_tokens(text or "")]
        assert (word[first[i] : first[i + 1]] == quality.WORDS - 1).tolist() == same
    assert shape.min() >= quality.WORDS and shape.max() < quality.WORDS + quality.SHAPES


def test_vectors_are_sums_over_neighbours(spark):
    df = spark.createDataFrame([("x", i, t, 0, None) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    found = quality.word_vectors(df)
    index = quality.index_vectors().astype(int)
    first, word, shape = quality.tokens(pa.array(TEXTS, pa.string()))
    total = np.zeros((quality.WORDS + quality.SHAPES, quality.DIMS))
    for d in range(len(TEXTS)):
        for i in range(first[d], first[d + 1]):
            for j in range(max(first[d], i - 2), min(first[d + 1], i + 3)):
                if i != j:
                    total[word[i]] += index[word[j]] + index[shape[j]]
                    total[shape[i]] += index[word[j]] + index[shape[j]]
    length = np.linalg.norm(total, axis=1, keepdims=True)
    assert np.allclose(found, total / np.where(length == 0, 1, length))


def test_pooling_does_not_depend_on_slices(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.WORDS + quality.SHAPES, quality.DIMS))
    texts = pa.array([*TEXTS, "one two three " * 500])
    whole = quality.pooled(texts, vectors)
    first, word, shape = quality.tokens(texts)
    for i in range(len(texts)):
        rows = (vectors[word] + vectors[shape])[first[i] : first[i + 1]]
        if len(rows):
            assert np.allclose(whole[i], [*rows.mean(0), *rows.std(0), np.log1p(len(rows))], atol=1e-6)
        else:
            assert not whole[i].any()
    monkeypatch.setattr(quality, "SLICE", 7)
    assert np.allclose(quality.pooled(texts, vectors), whole, atol=1e-6)


def test_slopes_are_differences():
    drawn = np.random.default_rng(3)
    inputs, labels = drawn.normal(size=(20, 5)), drawn.integers(0, 2, 20).astype(float)
    parts = [drawn.normal(size=(5, 4)), drawn.normal(size=4), drawn.normal(size=4), np.array(0.3)]
    _, slopes = quality.loss_and_slopes(parts, inputs, labels)
    for part, slope in zip(parts, slopes, strict=True):
        for at in np.ndindex(part.shape):
            kept, values = part[at], []
            for change in (1e-6, -1e-6):
                part[at] = kept + change
                values.append(quality.loss_and_slopes(parts, inputs, labels)[0])
            part[at] = kept
            assert slope[at] == pytest.approx((values[0] - values[1]) / 2e-6, abs=1e-5)


def test_temperature_softens_what_is_too_sure():
    drawn = np.random.default_rng(4)
    true = drawn.normal(0, 1, 20_000)
    labels = (drawn.random(20_000) < 1 / (1 + np.exp(-true))).astype(float)
    assert quality.best_temperature(3 * true, labels) == pytest.approx(3, rel=0.1)
    assert quality.best_temperature(true / 2, labels) == pytest.approx(0.5, rel=0.1)


def corpus(n: int):
    pick = random.Random(9)
    syllables = ["ka", "lo", "mi", "ter", "ven", "sho", "ru", "pe"]
    rows = []
    for i in range(n):
        words = ["".join(pick.choices(syllables, k=pick.randrange(1, 4))) for _ in range(pick.randrange(20, 60))]
        bad = i % 3 == 0
        text = " ".join(w + pick.choice(["%%%", "&&&"]) for w in words) if bad else " ".join(words) + "."
        rows.append(("x", i, text, 0 if bad else 1, None))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus(400)
    labels = spark.createDataFrame([(r[1], r[3]) for r in rows] + [(None, 1), (5, None), (10**6, 1)], "doc_id bigint, quality int")
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df, quality.train(df, labels, trained_on=F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def test_held_out_rows(trained):
    df, model = trained
    held = df.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    found = {r["doc_id"]: r for r in quality.score(held, model).collect()}
    marks = {r["doc_id"]: r["label"] for r in held.collect()}
    assert len(found) > 50 and sum(found[i]["predicted"] == marks[i] for i in found) / len(found) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_odd_rows(spark, trained):
    _, model = trained
    rows = [("x", 1, None, 0, None), ("x", 1, None, 0, None), ("x", None, "", 0, None), ("x", 2, "long word " * 300_000, 0, None)]
    found = quality.score(spark.createDataFrame(rows, SCHEMA), model)
    assert found.columns == ["doc_id", "score", "predicted"]
    found = sorted((tuple(r) for r in found.collect()), key=repr)
    empty = [r[1] for r in found if r[0] != 2]
    assert len(found) == 4 and len(set(empty)) == 1 and 0 <= empty[0] <= 1
    assert quality.score(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_without_labels_or_with_one_class(spark):
    df = spark.createDataFrame(corpus(6), SCHEMA)
    for labels, expected in (([], 0.5), ([(1, 1), (2, 1), (4, 1)], 1.0), ([(0, 0), (3, 0)], 0.0)):
        model = quality.train(df, spark.createDataFrame(labels, "doc_id bigint, quality int"))
        scores = {r["score"] for r in quality.score(df, model).collect()}
        assert len(scores) == 1 and scores.pop() == pytest.approx(expected, abs=1e-5)
    empty = spark.createDataFrame([], SCHEMA)
    model = quality.train(empty, spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"))
    assert quality.score(empty, model).collect() == []


def test_repeated_ids_do_not_depend_on_order(spark):
    rows = corpus(60)
    twice = rows + [("x", r[1], r[2] + " more", r[3], None) for r in rows]
    labels = spark.createDataFrame([(r[1], r[3]) for r in rows] * 2, "doc_id bigint, quality int")
    scores = []
    for parts in (2, 5):
        df = spark.createDataFrame(twice, SCHEMA).repartition(parts)
        scores.append(sorted((r["doc_id"], round(r["score"], 9)) for r in quality.score(df, quality.train(df, labels)).collect()))
    assert scores[0] == scores[1]
