"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - score): all grades share one weight vector, the thresholds are ordered. A
document's score is the mean weight of its hashed byte trigrams plus the mean weights of its hashed
words and of their immediate repetitions, each over the whole text. Expected grade and tail probability P(grade >= k) come from the same
numbers.

The model is fitted in one task on a bounded sample of labelled rows (``labelled_rows``, the rows with the
least hash of their id) and sent to the tasks: its size depends on ``SIZE`` only.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passbook.llm import textbatch
from passbook.llm.columns import one_text, quoted, spare
from passbook.workspace import stored

BITS = 16
SIZE = 1 << BITS  # weights: so many for trigrams and as many for words
LABELLED_ROWS = 12_000
EPOCHS = 60
RATE = 0.5
L2 = 1e-6
SCALE = 10.0
CUT = 0.5

_TRIGRAM = tuple(np.uint32(x) for x in (2654435761, 2246822519, 3266489917))


def trigram_slots(data: np.ndarray) -> np.ndarray:
    """Slot of the trigram that starts at each byte but the last two."""
    wide = data.astype(np.uint32)
    mixed = wide[:-2] * _TRIGRAM[0] ^ wide[1:-1] * _TRIGRAM[1] ^ wide[2:] * _TRIGRAM[2]
    return (mixed * np.uint32(2654435769)) >> np.uint32(32 - BITS)


def _slots(words: textbatch.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots and the text of each, by kind: trigrams, words, and whether a word repeats the one before."""
    if len(words.data) > 2:
        grams = trigram_slots(words.data).astype(np.int64)
        text = np.repeat(np.arange(words.n), words.text_ends - words.text_starts)[: len(grams)]
        inside = np.arange(len(grams)) + 2 < words.text_ends[text]
        grams, text = grams[inside], text[inside]
    else:
        grams, text = np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = words.hashes()
    own = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    again = np.zeros(len(hashes), dtype=np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    return [(grams, text), (own + SIZE, words.doc), (again + 2 * SIZE, words.doc)]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    def scores(self, words: textbatch.Words) -> np.ndarray:
        total = np.zeros(words.n)
        for slots, text in _slots(words):
            n = np.bincount(text, minlength=words.n)
            total += SCALE * np.bincount(text, self.weights[slots], minlength=words.n) / np.maximum(n, 1)
        return total

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for the grades but the lowest: one row per score."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(texts: pa.Array, grades: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Full-batch gradient ascent with per-weight step sizes (AdaGrad); the same rows give the same model."""
    levels = sorted(set(grades.tolist()))
    y = np.searchsorted(levels, grades)
    n, k, size = len(y), len(levels), 2 * SIZE + 2
    rows, slots, values = [], [], []
    for words in textbatch.blocks(texts, textbatch.NOT_BLANK, lower=False):
        for slot_, text in _slots(words):
            keys, counts = np.unique(text * size + slot_, return_counts=True)
            which = keys // size
            per_text = np.bincount(text, minlength=words.n)
            rows.append((words.first + which).astype(np.int32))
            slots.append((keys % size).astype(np.int32))
            values.append((SCALE * counts / per_text[which]).astype(np.float32))
    row, slot, value = (np.concatenate(x) if x else np.empty(0, int) for x in (rows, slots, values))
    weights, steps = np.zeros(size), np.full(size, 1e-8)
    # the thresholds start where the grades' shares put them; gaps stay positive as exponentials
    shares = np.cumsum(np.bincount(y, minlength=k))[:-1] / n
    start = np.log(np.clip(shares, 1e-4, 1 - 1e-4) / np.clip(1 - shares, 1e-4, 1))
    first, gaps = start[:1].copy(), np.log(np.maximum(np.diff(start), 1e-2))
    t_steps = np.full(k - 1, 1e-8)
    for _ in range(epochs):
        thresholds = np.concatenate((first, first + np.cumsum(np.exp(gaps))))
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
        score = np.bincount(row, weights[slot] * value, minlength=n)
        below, above = _sigmoid(edges[y] - score), _sigmoid(edges[y + 1] - score)
        p = np.maximum(above - below, 1e-9)
        by_score = below + above - 1.0  # derivative of the log likelihood
        gradient = np.bincount(slot, by_score[row] * value, minlength=size) / n - L2 * weights
        to_edge = np.zeros(k + 1)
        np.add.at(to_edge, y + 1, above * (1 - above) / p / n)
        np.add.at(to_edge, y, -below * (1 - below) / p / n)
        inner = to_edge[1:-1]
        tail_sums = np.cumsum(inner[::-1])[::-1]
        step = np.concatenate((tail_sums[:1], tail_sums[1:] * np.exp(gaps)))
        steps += gradient**2
        t_steps += step**2
        weights += RATE * gradient / np.sqrt(steps)
        moved = 0.1 * step / np.sqrt(t_steps)
        first, gaps = first + moved[:1], gaps + moved[1:]
    thresholds = np.concatenate((first, first + np.cumsum(np.exp(gaps))))
    return Model(weights.astype(np.float32), thresholds, [float(x) for x in levels])


def train(
    docs: DataFrame,
    ratings: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rating_id: str = "doc_id",
    grade_column: str = "grade",
    labelled_rows: int = LABELLED_ROWS,
) -> Model | None:
    """The model, or None if the rated documents have fewer than two grades.

    An id with several ratings counts with its lowest. Null ids and null grades are no ratings.
    """
    rated = ratings.select(quoted(rating_id).alias("_id"), quoted(grade_column).cast("double").alias("_grade")).dropna()
    rated = rated.groupBy("_id").agg(F.min("_grade").alias("_grade"))
    chosen = rated.orderBy(F.xxhash64("_id"), "_id").limit(labelled_rows)
    texts = docs.select(quoted(id_column).alias("_doc"), quoted(text_column).alias("_text"))
    # at most labelled_rows ids go to the scan of the texts
    sample = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_doc", "_text", "_grade")
    # an id counts once, however many rows repeat it
    sample = stored(one_text(sample, "_doc", "_text", "_grade"), "rated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.concat_tables(parts).combine_chunks()
        texts, grades = rows.column("_text").combine_chunks(), rows.column("_grade").to_numpy()
        if len(set(grades.tolist())) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, grades))], pa.binary())], ["model"])

    ordered = sample.repartition(1).sortWithinPartitions("_doc", "_text")
    found = ordered.mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else None


def tails_column(model: Model):
    """Arrow function from texts to P(grade >= k) of the grades but the lowest; zeros for a text without words."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        found = np.zeros((len(texts), len(model.thresholds)))
        for words in textbatch.blocks(texts, textbatch.NOT_BLANK, lower=False):
            tails = model.tails(model.scores(words))
            tails[words.counts() == 0] = 0.0
            found[words.first : words.first + words.n] = tails
        flat = pa.array(found.ravel())
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * found.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), flat)

    return run


def _tails(docs: DataFrame, model: Model | None, text_column: str) -> Column:
    return tails_column(model)(quoted(text_column)) if model else F.array(F.lit(1.0))


def grade(
    docs: DataFrame,
    model: Model | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    cut: float = CUT,
) -> DataFrame:
    """``doc_id, expected_grade, tails, kept`` for every row.

    ``tails``: P(grade >= k) for each grade but the lowest. ``kept``: the first of them is at least ``cut``.
    Texts without words (null, empty, blank) get the lowest grade and are rejected. Without a model every
    text is kept. Repeated rows are graded alike, null ids stay null, an empty table gives an empty one.
    """
    rows = docs.select(quoted(id_column).alias("doc_id"), _tails(docs, model, text_column).alias("tails"))
    levels = model.grades if model else [0.0, 1.0]
    gaps = [b - a for a, b in zip(levels, levels[1:], strict=False)]
    expected = F.lit(levels[0])
    for k, gap in enumerate(gaps):
        expected = expected + F.lit(gap) * F.col("tails")[k]
    return rows.select("doc_id", expected.alias("expected_grade"), "tails", (F.col("tails")[0] >= cut).alias("kept"))


def good(docs: DataFrame, model: Model | None, text_column: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, that the model keeps."""
    (tails,) = spare(docs, "quality_tails")
    kept = docs.withColumn(tails, _tails(docs, model, text_column)).filter(F.col(tails)[0] >= cut)
    return kept.select(*map(quoted, docs.columns))


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from the table ``labels``: 0 poor, 1 sound but toxic, 2 good; null without quality."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0))
    grade_ = F.when(F.col("quality") == 0, 0).when(F.col("quality") > 0, F.when(toxic > 0, 1).otherwise(2))
    return labels.select("doc_id", grade_.alias("grade"))
