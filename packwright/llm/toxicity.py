"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is a bag of sentences. Each sentence has a probability ``sigmoid(bias + sum of the
weights of its features)``, and the document's score is the noisy-or, ``1 - prod(1 - p)``, of its
worst sentence and of what the others have beyond the prior: one offending sentence is enough, and
any number of sentences that say nothing add nothing. Training sees labels of documents only; afterwards the sentence
probabilities say where the offence is.

Features are the words of a sentence without case, each with its first four and five letters, so
that unseen forms of a word count. They are hashed. The model is fitted on at most ``SAMPLE``
labelled documents, chosen by a hash of their id; scoring covers every row and whole texts.

A null or empty text has no sentences: its score is that of the prior of an empty sentence, below
0.5. Repeated rows get equal scores. Labels with a null are ignored. Without labelled rows of both
classes the weights are zero and every score is the low prior.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.llm.frames import batch, keyed, steps, strings, task_map

#: Labelled documents the model is fitted on, at most.
SAMPLE = 6_000
#: Bytes of sampled text that the model is fitted on, at most; whole documents in hash order, those that do not fit are passed over.
SAMPLE_BYTES = 20 << 20
#: Hashed features.
BUCKETS = 1 << 17
#: Log odds of a sentence with no known feature, the prior: well below one in a thousand.
START_BIAS = -8.0

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 1 << 19


def word_features(word: str) -> list[int]:
    """Hashed features of one lower-case word: itself and its beginnings."""
    names = [f"w{word}"]
    if len(word) > 4:
        names += [f"a{word[:4]}", f"b{word[:5]}"]
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


def sentences(text: str) -> list[str]:
    """The sentences of a text: runs without ``. ! ?`` or a line break."""
    return _SENTENCE.findall(text)


def _bags(rows: Iterable[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, the sentence of each, the document of each sentence, and the labels.

    Features in fewer than three documents say nothing about others and are left out.
    """
    feature, sentence, document, labels = array("q"), array("q"), array("q"), []
    seen: dict[str, list[int]] = {}
    spread = np.zeros(BUCKETS, np.int64)
    for text, label in rows:
        begun = len(feature)
        for s in sentences(text) or [""]:
            found = set()
            for word in _WORD.findall(s.lower()):
                if word not in seen:
                    seen[word] = word_features(word)
                found.update(seen[word])
            feature.extend(found)
            sentence.extend([len(document)] * len(found))
            document.append(len(labels))
        spread[np.unique(np.frombuffer(feature, np.int64)[begun:])] += 1
        labels.append(label)
    feature, sentence, document = (np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (feature, sentence, document))
    keep = spread[feature] >= 3
    return feature[keep], sentence[keep], document, np.array(labels, float)


def fit(rows: Iterable[tuple[str, int]], rounds: int = 100, rate: float = 1.0, shrink: float = 3e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels under noisy-or.

    Full-batch steps of Adagrad with an L1 penalty, which leaves features without evidence at
    zero. Deterministic for the same rows in the same order.
    """
    weights, bias = np.zeros(BUCKETS), START_BIAS
    feature, sentence, document, y = _bags(rows)
    if len(set(y.tolist())) < 2:
        return weights, bias
    step = np.full(BUCKETS, 1e-8)
    # Both classes weigh the same, or the rarer one would be neglected.
    share = y.mean()
    cost = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for _ in range(rounds):
        z = np.clip(bias + np.bincount(sentence, weights[feature], len(document)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        log_clean = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))
        toxic = -np.expm1(log_clean)
        # d log P / dz of a sentence: p (1 - P) / P for toxic documents, -p for the others.
        pull = np.where(y > 0, np.exp(log_clean) / np.maximum(toxic, 1e-9), -1.0) * cost
        slope = np.bincount(feature, (pull[document] * p)[sentence], BUCKETS)
        step += slope**2
        scale = rate / np.sqrt(step)
        moved = weights + scale * slope
        weights = np.sign(moved) * np.maximum(np.abs(moved) - scale * shrink, 0)
    return weights, bias


def training_rows(df: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, trained_on: Column | None) -> DataFrame:
    """``(text, label)`` of labelled rows, at most ``SAMPLE``, in an order fixed by the ids.

    Labels are few beside documents; the join is left to the optimizer, which broadcasts them
    only below its own size limit. Of ids with several labels the largest counts.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marks = marks if trained_on is None else marks.where(trained_on)
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = marks.orderBy(order, "id").limit(SAMPLE)
    texts = keyed(df, id_col, text_col).where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    rows = texts.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return rows.orderBy(order, "id").select("text", "label")


def train(
    df: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", trained_on: Column | None = None
) -> Broadcast:
    """The model, fitted on the labelled rows that ``trained_on`` (a column of labels) accepts."""
    chosen = training_rows(df, labels, label_col, id_col, text_col, trained_on)

    def bounded():
        size = 0
        for row in chosen.toLocalIterator():
            text = row["text"] or ""
            more = len(text.encode("utf-8", "replace"))
            if size + more <= SAMPLE_BYTES:
                size += more
                yield text, row["label"]

    weights, bias = fit(bounded())
    known = np.flatnonzero(weights)
    model = (dict(zip(known.tolist(), weights[known].tolist(), strict=True)), bias)
    return df.sparkSession.sparkContext.broadcast(model)


class WordScores(dict):
    """Sum of a word's weights, kept for the words a task meets."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= _CACHE:
            self.clear()
        found = self[word] = sum(self.weights.get(f, 0.0) for f in set(word_features(word)))
        return found


def sentence_odds(text: str, scores: WordScores, bias: float) -> list[float]:
    """Log odds of every sentence of a text."""
    return [bias + sum(map(scores.__getitem__, set(_WORD.findall(s)))) for s in sentences(text.lower())]


def noisy_or(odds: list[float], bias: float) -> float:
    """``1 - prod(1 - p)`` of the worst sentence and what the others have beyond the prior; of no sentences, the prior."""
    prior, worst = math.log1p(math.exp(bias)), max(odds, default=bias)
    if worst <= bias:
        return -math.expm1(-math.log1p(math.exp(worst)))
    return -math.expm1(-prior - sum(math.log1p(math.exp(min(z, 30.0))) - prior for z in odds if z > bias))


def score(df: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, predicted, worst_sentence, worst_score)`` of every row.

    ``worst_sentence`` counts the sentences from 0 and is null without any.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        (weights, bias), schema = model.value, None
        scores = WordScores(weights)
        for part in steps(batches):
            total, worst, peak = [], [], []
            for text in strings(part.column("text")):
                odds = sentence_odds(text, scores, bias)
                total.append(noisy_or(odds, bias))
                at = max(range(len(odds)), key=odds.__getitem__, default=None)
                worst.append(at)
                peak.append(None if at is None else 1 / (1 + math.exp(-max(min(odds[at], 30.0), -30.0))))
            schema = schema or pa.schema(
                [part.schema.field("id"), ("score", pa.float64()), ("worst_sentence", pa.int32()), ("worst_score", pa.float64())]
            )
            yield batch(schema, id=part.column("id"), score=total, worst_sentence=worst, worst_score=peak)

    found = task_map(keyed(df, id_col, text_col), run, f"id {kind}, score double, worst_sentence int, worst_score double")
    return found.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_sentence", "worst_score")


def accepted(df: DataFrame, model: Broadcast, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All columns of the rows that score below the threshold."""
    at = df.columns.index(text_col)

    def run(batches):
        (weights, bias) = model.value
        scores = WordScores(weights)
        for part in batches:
            named = pa.RecordBatch.from_arrays([pa.array(range(part.num_rows), pa.int64()), part.column(at).cast(pa.string())], ["row", "text"])
            for step in steps(iter([named])):
                fine = [noisy_or(sentence_odds(t, scores, bias), bias) < threshold for t in strings(step.column("text"))]
                yield part.take(step.column("row").filter(pa.array(fine, pa.bool_())))

    return task_map(df, run, df.schema)


def offending(df: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(id_col, sentence_no, sentence, score)``: the sentences whose own probability reaches the threshold."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        (weights, bias), schema = model.value, None
        scores, least = WordScores(weights), math.log(threshold / (1 - threshold))
        for part in steps(batches):
            rows = []
            for i, text in enumerate(strings(part.column("text"))):
                odds = sentence_odds(text, scores, bias)
                rows += [(i, k, s, z) for k, (s, z) in enumerate(zip(sentences(text), odds, strict=False)) if z >= least]
            schema = schema or pa.schema([part.schema.field("id"), ("sentence_no", pa.int32()), ("sentence", pa.string()), ("score", pa.float64())])
            yield batch(
                schema,
                id=part.column("id").take(pa.array([r[0] for r in rows], pa.int64())),
                sentence_no=[r[1] for r in rows],
                sentence=[r[2].strip() for r in rows],
                score=[1 / (1 + math.exp(-min(r[3], 30.0))) for r in rows],
            )

    found = task_map(keyed(df, id_col, text_col), run, f"id {kind}, sentence_no int, sentence string, score double")
    return found.withColumnRenamed("id", id_col)
