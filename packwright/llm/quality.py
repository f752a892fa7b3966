"""Quality of documents: random-indexing word vectors, pooled, and a small network over them.

Every token has a fixed random index vector of ``DIMS`` numbers -1, 0 and 1. Over the whole
corpus, the vector of a token is the sum of the index vectors of its neighbours, two to each side.
Tokens are runs of letters, digits, signs or line breaks; each counts as a word, hashed into
``WORDS`` cells, and as a shape (kind, case, length), so that words never seen before say
something too. A token equal to the one before it counts as a repetition. Sums are of whole
numbers, so that they do not depend on the order of tasks; a table of fixed size leaves each task.

A document is the mean and the spread of the vectors of its tokens. A network of two layers in
numpy is fitted to at most ``SAMPLE`` labelled documents, chosen by a hash of their ids; one in
five of them sets the temperature instead, which makes its outputs probabilities. Word vectors,
pooling and scores cover all rows and whole texts. Labels are the only thing learnt that depends on which rows
are held out.

A null or empty text has no tokens: its vectors are zero, and it gets the score the network gives
to that. Labels with a null are ignored; of an id with several labels the largest counts, of an id
with several texts the one whose vectors come first. Without labelled rows of both classes every score
is the share of ones, or one half. Other columns, whatever their names, do not count; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.llm.frames import batch, keyed, steps, task_map
from packwright.llm.tables import cell_sums
from packwright.llm.words import hashes, text_bytes

#: Cells of words and of shapes, and length of a vector.
WORDS, SHAPES, DIMS = 1 << 12, 64, 32
#: Labelled documents the network and the temperature are fitted on, at most.
SAMPLE = 8_000
#: Tokens worked on at a time.
SLICE = 1 << 18
HIDDEN, ROUNDS, RATE, DECAY = 24, 400, 0.02, 1e-3
REACH = 2

_NOTHING = WORDS + SHAPES
_SAME_WORD, _SAME_SHAPE = WORDS - 1, WORDS + SHAPES - 1
_LETTER, _DIGIT, _SIGN, _BREAK = 1, 2, 3, 4
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[: 0x21] = 0
_KIND[0x7F] = 0
_KIND[0x0A] = _BREAK
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("A") : ord("Z") + 1] = _KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[0x80:] = _LETTER
_UPPER = np.zeros(256, np.int64)
_UPPER[ord("A") : ord("Z") + 1] = 1
_LOWER = np.zeros(256, np.int64)
_LOWER[ord("a") : ord("z") + 1] = 1
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_BINS = np.array([2, 3, 5, 8, 12])


def index_vectors() -> np.ndarray:
    """Index vectors of all words and shapes, then one of zeros."""
    drawn = np.random.default_rng(12).integers(0, 6, (_NOTHING + 1, DIMS))
    vectors = (drawn == 0).astype(np.int8) - (drawn == 1).astype(np.int8)
    vectors[_NOTHING] = 0
    return vectors


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the tokens of each text begin, and the word and the shape of each token."""
    data, places = text_bytes(column)
    if not data.size:
        return np.zeros(len(places), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    begins = np.ones(data.size, bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins[places[places < data.size]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, data.size))
    real = kind[starts] != 0
    starts, lengths = starts[real], lengths[real]
    kinds = kind[starts]
    codes = hashes(_FOLDED[data], starts, lengths)
    first = np.searchsorted(starts, places)

    upper, lower = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _LOWER))
    upper, lower = upper[starts + lengths] - upper[starts], lower[starts + lengths] - lower[starts]
    case = np.where(upper == 0, 0, np.where((lower == 0) & (lengths > 1), 1, np.where((upper == 1) & (_UPPER[data[starts]] == 1), 2, 3)))
    size = np.searchsorted(_BINS, lengths, side="right")
    shape = np.select([kinds == _LETTER, kinds == _DIGIT, kinds == _SIGN], [case * 6 + size, 24 + size, 30 + size], 36)
    word = (codes % np.uint64(WORDS - 1)).astype(np.int64)
    same = np.zeros(word.size, bool)
    same[1:] = (codes[1:] == codes[:-1]) & (kinds[1:] == kinds[:-1]) & (kinds[1:] != _BREAK)
    same[first[first < word.size]] = False
    word[same], shape = _SAME_WORD, np.where(same, _SAME_SHAPE - WORDS, shape)
    return first, word, WORDS + shape


def _contexts(first: np.ndarray, word: np.ndarray, shape: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words, shapes and sums of the neighbours' index vectors, a slice of tokens at a time."""
    vectors = index_vectors()
    # Texts are set apart by as many empty places as a neighbourhood reaches.
    place = np.arange(word.size) + REACH * (1 + np.repeat(np.arange(first.size - 1), np.diff(first)))
    size = word.size + REACH * (first.size + 1)
    words, shapes = np.full(size, _NOTHING), np.full(size, _NOTHING)
    words[place], shapes[place] = word, shape
    for start in range(REACH, size - REACH, SLICE):
        stop = min(start + SLICE, size - REACH)
        around = slice(start - REACH, stop + REACH)
        index = vectors[words[around]] + vectors[shapes[around]]
        wide = stop - start
        total = sum(index[k : k + wide] for k in range(2 * REACH + 1) if k != REACH)
        yield words[start:stop], shapes[start:stop], total


def _task_sums(batches) -> np.ndarray:
    total = np.zeros((_NOTHING + 1, DIMS))
    for part in steps(batches):
        for words, shapes, sums in _contexts(*tokens(part.column("text"))):
            for k in range(DIMS):
                weights = sums[:, k].astype(float)
                total[:, k] += np.bincount(words, weights, _NOTHING + 1) + np.bincount(shapes, weights, _NOTHING + 1)
    return total[:_NOTHING].astype(np.int64).ravel()


def word_vectors(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Vectors of all words and shapes from the whole corpus, of length one or zero."""
    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    sums = cell_sums(texts, _task_sums, _NOTHING * DIMS).reshape(_NOTHING, DIMS).astype(float)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return sums / np.where(length == 0, 1, length)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text's tokens, and how many there are."""
    first, word, shape = tokens(column)
    texts = first.size - 1
    sums, squares = np.zeros((texts, DIMS)), np.zeros((texts, DIMS))
    for text in range(texts):
        for start in range(first[text], first[text + 1], SLICE):
            part = slice(start, min(start + SLICE, first[text + 1]))
            rows = vectors.take(word[part], axis=0)
            rows += vectors.take(shape[part], axis=0)
            sums[text] += rows.sum(0)
            squares[text] += np.einsum("ij,ij->j", rows, rows)
    count = np.diff(first)[:, None]
    mean = sums / np.maximum(count, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(count, 1) - mean * mean, 0))
    return np.hstack([mean, spread, np.log1p(count)])


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the output."""

    centre: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float = 1.0

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        hidden = np.tanh((inputs - self.centre) / self.scale @ self.inner + self.inner_bias)
        return hidden @ self.outer + self.outer_bias

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(inputs) / self.temperature, -50, 50)))


def loss_and_slopes(parts: list[np.ndarray], inputs: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Cross entropy with weight decay, and its derivative by every weight; inputs are standardised."""
    inner, inner_bias, outer, outer_bias = parts
    hidden = np.tanh(inputs @ inner + inner_bias)
    z = hidden @ outer + outer_bias
    loss = np.mean(np.logaddexp(0, z) - labels * z) + DECAY * (np.sum(inner**2) + np.sum(outer**2)) / 2
    pull = (1 / (1 + np.exp(-z)) - labels) / labels.size
    back = np.outer(pull, outer) * (1 - hidden**2)
    return float(loss), [inputs.T @ back + DECAY * inner, back.sum(0), hidden.T @ pull + DECAY * outer, pull.sum()]


def fit(inputs: np.ndarray, labels: np.ndarray) -> Network:
    """The network for these rows, by full-batch steps of Adam from a fixed start."""
    centre, scale = inputs.mean(0), inputs.std(0) + 1e-6
    standard, drawn = (inputs - centre) / scale, np.random.default_rng(5)
    parts = [drawn.normal(0, inputs.shape[1] ** -0.5, (inputs.shape[1], HIDDEN)), np.zeros(HIDDEN), drawn.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for round_ in range(1, ROUNDS + 1):
        _, slopes = loss_and_slopes(parts, standard, labels)
        for i, slope in enumerate(slopes):
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.999 * square[i] + 0.001 * slope**2
            parts[i] = parts[i] - RATE * (mean[i] / (1 - 0.9**round_)) / (np.sqrt(square[i] / (1 - 0.999**round_)) + 1e-8)
    return Network(centre, scale, parts[0], parts[1], parts[2], float(parts[3]))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross entropy on rows that the network was not fitted on."""
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 181))
    return float(min(choices, key=lambda t: np.mean(np.logaddexp(0, logits / t) - labels * logits / t)))


def fitted(inputs: np.ndarray, labels: np.ndarray) -> Network:
    """Network and temperature; every fifth row sets the temperature alone."""
    width = inputs.shape[1] if inputs.ndim == 2 else 2 * DIMS + 1
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6)) if labels.size else 0.5
    constant = Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    aside = np.arange(labels.size) % 5 == 4
    if len(set(labels[~aside].tolist())) < 2:
        return constant
    network = fit(inputs[~aside], labels[~aside])
    if aside.any():
        network.temperature = best_temperature(network.logits(inputs[aside]), labels[aside])
    return network


def _features(df: DataFrame, vectors: Broadcast, schema: str) -> DataFrame:
    def run(batches):
        for part in steps(batches):
            rows = pooled(part.column("text"), vectors.value)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))], ["id", "label", "features"]
            )

    return task_map(df, run, schema)


def train(
    df: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", trained_on: Column | None = None
) -> Broadcast:
    """Vectors from all of ``df`` and the network, fitted to the labels that ``trained_on`` accepts."""
    context = df.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(df, text_col))
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    marks = marks if trained_on is None else marks.where(trained_on)
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = marks.orderBy(order, "id").limit(SAMPLE)
    texts = keyed(df, id_col, text_col).join(chosen, "id").select("id", "label", "text")
    kind = dict(df.dtypes)[id_col]
    rows = _features(texts, vectors, f"id {kind}, label int, features array<double>")
    rows = rows.groupBy("id").agg(F.min("features").alias("features"), F.max("label").alias("label"))
    rows = rows.orderBy(order, "id").select("features", "label").collect()
    network = fitted(np.array([r["features"] for r in rows]), np.array([float(r["label"]) for r in rows]))
    return context.broadcast((vectors.value, network))


def score(df: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``(id_col, score, predicted)`` of every row; ``predicted`` is 1 from the threshold on."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        vectors, network = model.value
        for part in steps(batches):
            found = network.probabilities(pooled(part.column("text"), vectors))
            yield batch(pa.schema([part.schema.field("id"), ("score", pa.float64())]), id=part.column("id"), score=found.tolist())

    found = task_map(keyed(df, id_col, text_col), run, f"id {kind}, score double")
    return found.select(F.col("id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
