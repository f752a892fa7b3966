import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from packwright.llm import toxicity

CALM = "river stone market light people road small house winter letter garden story field water morning answer".split()
RUDE = "foulword nastyword grimword".split()


def texts(count, seed):
    r, rows = random.Random(seed), []
    for i in range(count):
        bad = i % 3 == 0
        parts = [" ".join(r.choice(CALM) for _ in range(r.randint(3, 9))) for _ in range(r.randint(1, 12))]
        if bad:
            parts[r.randrange(len(parts))] += " " + r.choice(RUDE) + r.choice(["", "s", "er"])
        rows.append((i, ". ".join(parts) + ".", int(bad)))
    return rows


def test_learns_from_documents_and_locates_sentences(spark):
    rows = texts(400, 3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(df.drop("toxic"), df.drop("text"), trained_on=F.col("doc_id") % 5 != 0)
    scored = {r["doc_id"]: r for r in toxicity.score(df.select("doc_id", "text", F.lit("clash").alias("score")), model).collect()}
    held = [r for r in rows if r[0] % 5 == 0]
    assert sum(scored[i]["predicted"] == y for i, _, y in held) >= 0.97 * len(held)
    assert all(0 <= s["score"] <= 1 for s in scored.values())
    found = toxicity.offending(df, model).collect()
    assert found and all(any(w in r["sentence"] for w in RUDE) for r in found)
    kept = {r["doc_id"] for r in toxicity.accepted(df, model).collect()}
    assert kept == {i for i, s in scored.items() if s["predicted"] == 0}


def test_null_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "calm words."), (3, "a. " * 5000), (3, "a. " * 5000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.train(df, labels)
    found = toxicity.score(df, model).collect()
    assert len(found) == 5 and not any(r["predicted"] for r in found[:3])
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.accepted(df.limit(0), model).count() == 0


def test_sentences_without_evidence_add_nothing(spark):
    calm = [(1000 + i, t, 0) for i, t in enumerate(["a. " * 5000, "3.14 2.71\n" * 5000, "zzq yyq xxq.\n" * 5000])]
    rude = (2000, "a. " * 4000 + "river " + RUDE[0] + " stone. " + "a. " * 4000, 1)
    rows = texts(400, 3)
    df = spark.createDataFrame(rows + calm + [rude], "doc_id bigint, text string, toxic int")
    model = toxicity.train(df, df.where("doc_id < 1000").select("doc_id", "toxic"))
    found = {x["doc_id"]: x["predicted"] for x in toxicity.score(df, model).collect()}
    assert [found[i] for i, _, _ in calm] == [0, 0, 0] and found[2000] == 1
    assert {x["doc_id"] for x in toxicity.accepted(df.where("doc_id >= 1000"), model).collect()} == {i for i, _, _ in calm}
    untrained = toxicity.train(df, df.where("toxic = 0").select("doc_id", "toxic"))
    assert {x["score"] for x in toxicity.score(df, untrained).collect()} == {toxicity.noisy_or([], toxicity.START_BIAS)}


def test_a_text_that_does_not_fit_the_sample_is_passed_over(spark, monkeypatch):
    rows = texts(300, 3) + [(i, "river " * 35_000, 0) for i in range(1000, 1030)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows: (seen.extend(rows), (np.zeros(8), -8.0))[1])
    for bound, long in ((200_000, 0), (300_000, 1)):
        monkeypatch.setattr(toxicity, "SAMPLE_BYTES", bound)
        seen.clear()
        toxicity.train(df.drop("toxic"), df.drop("text"))
        assert sum(len(x) > 10_000 for x, _ in seen) == long and len(seen) == 300 + long


def test_scores_equal_the_plain_product(spark):
    """1 - prod(1 - p) over sentences, each less the prior, from random weights."""
    draw = random.Random(8)
    words = ["kind", "awful", "rotten", "people", "bread", "tea", "straße", "x"]
    weights = {f: draw.uniform(-2, 9) for w in words for f in toxicity.word_features(w)}
    bias = toxicity.START_BIAS
    texts = [None, "", "...", "Unseen words only. Again."]
    texts += ["".join(draw.choice(words).title() + draw.choice([" ", " ", ". ", "!", "\n"]) for _ in range(draw.randrange(1, 40))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    model = spark.sparkContext.broadcast((weights, bias))
    found = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    prior = 1 / (1 + math.exp(-bias))
    for i, text in enumerate(texts):
        odds = []
        for sentence in re.split(r"[.!?\n]+", (text or "").lower()):
            if sentence:
                odds.append(bias + sum(sum(weights.get(f, 0.0) for f in set(toxicity.word_features(w))) for w in set(re.findall(r"[^\W\d_]+", sentence))))
        clean = 1 - prior
        for z in odds:
            if z > bias:
                clean *= (1 - 1 / (1 + math.exp(-min(z, 30)))) / (1 - prior)
        if not any(z > bias for z in odds):
            clean = 1 - 1 / (1 + math.exp(-max(odds, default=bias)))
        assert found[i]["score"] == pytest.approx(1 - clean, abs=1e-9), text
        assert found[i]["predicted"] == int(1 - clean >= 0.5)


def test_fitting_raises_the_likelihood_of_labels():
    rows = [("good bread. " * 3 + ("awful rotten fool." if i % 3 == 0 else "warm tea."), int(i % 3 == 0)) for i in range(60)]
    likelihood = []
    for rounds in (0, 1, 5, 40):
        weights, bias = toxicity.fit(rows, rounds=rounds)
        scores = toxicity.WordScores({int(f): float(weights[f]) for f in weights.nonzero()[0]})
        total = 0.0
        for text, label in rows:
            clean = sum(-math.log1p(math.exp(z)) for z in toxicity.sentence_odds(text, scores, bias))
            total += math.log(-math.expm1(clean)) if label else clean
        likelihood.append(total)
    assert likelihood == sorted(likelihood) and likelihood[-1] > likelihood[0] / 10
