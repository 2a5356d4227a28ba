"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates, scored as sparse dot products.

Each text gives five bags: words, word pairs, and one, two and three words in a row by their
shape (capitals, digits, signs, length, whether the word repeats an earlier one).  Every
n-gram is hashed to one of 2**BITS weights; a bag's weights are averaged, so long texts are read
whole and weigh as short ones do.  Training sees a bounded labelled sample (``labelled.
SAMPLE_ROWS``) in one task; scoring runs wherever the texts are.

Nulls and texts without words score the bias alone.  Repeated rows are scored each; an
empty table gives no rows; without labels every score is one half.  Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm import arrays as A
from tidemark.llm import labelled

BITS = 18
BAGS = 5
CLASS = np.zeros(256, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 1, 2, 3, 4
CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = np.arange(5, 37)


def _ngrams(data: np.ndarray, borders: np.ndarray):
    """(five arrays of weight places per word, document of each word)."""
    starts, ends, docs = A.word_spans(data, borders)
    if not len(starts):
        return [np.zeros(0, np.int64)] * BAGS, docs
    word = A.Rolling(A.LOWER_VALUES[data])(starts, ends)
    count = lambda flag: np.minimum(np.add.reduceat(flag[:ends[-1]], starts), 255)
    kind = CLASS[data]
    small, upper = count(((kind == 1) | (kind == 4)).astype(np.int32)), count((kind == 2).astype(np.int32))
    digits, signs = count((kind == 3).astype(np.int32)), count((kind >= 5).astype(np.int32))
    before = np.zeros(len(word), A.U)
    before[1:] = np.where(docs[1:] == docs[:-1], word[:-1], A.U(0))
    before2 = np.zeros(len(word), A.U)
    before2[1:] = np.where(docs[1:] == docs[:-1], before[:-1], A.U(0))
    shape = np.searchsorted([1, 3, 7, 12, 25], ends - starts)
    for part, size in ((kind[starts], 40), (kind[ends - 1], 40), (np.minimum(signs, 3), 4),
                       (np.minimum(digits, 2), 3), (np.minimum(upper, 2), 3), ((small == 0).astype(np.int64), 2),
                       ((word == before).astype(np.int64) + 2 * (word == before2), 4)):
        shape = shape * size + part
    shape = A.mix(shape.astype(A.U) + A.BASE)
    near = np.zeros(len(word), A.U)
    near[1:] = np.where(docs[1:] == docs[:-1], shape[:-1], A.U(1))
    near2 = np.zeros(len(word), A.U)
    near2[1:] = np.where(docs[1:] == docs[:-1], near[:-1], A.U(1))
    grams = (word, A.mix(word ^ (before * A.WORD_BASE)), shape, A.mix(shape ^ (near * A.WORD_BASE)),
             A.mix(shape ^ (near * A.WORD_BASE) ^ (near2 * A.CHECK_BASE)))
    return [(A.mix(g + A.U(k)) >> A.U(64 - BITS)).astype(np.int64) for k, g in enumerate(grams)], docs


def dot(model: dict, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    n = len(borders) - 1
    grams, docs = _ngrams(data, borders)
    total = np.zeros(n)
    for g in grams:
        total += np.bincount(docs, weights=model["weights"][g], minlength=n)
    return model["bias"] + total / np.maximum(1, np.bincount(docs, minlength=n))


def train(slices, alpha: float = 0.6, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, passes: int = 4,
          batch: int = 16) -> dict:
    """FTRL-proximal: z sums gradients less the drift of the weights, q their squares."""
    rows, labels = [], []
    for data, borders, label in slices:
        grams, docs = _ngrams(data, borders)
        counts, first = A.word_counts(docs, len(borders) - 1)
        for k in range(len(borders) - 1):
            own = np.concatenate([g[first[k]: first[k + 1]] for g in grams])
            place, times = np.unique(own, return_counts=True)
            rows.append((place.astype(np.int32), (times / max(1, counts[k])).astype(np.float32)))
        labels += label.tolist()
    z, q = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weight(at):
        return np.where(np.abs(z[at]) <= l1, 0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(q[at])) / alpha + l2))

    random = np.random.default_rng(7)
    for _ in range(passes if rows else 0):
        order = random.permutation(len(rows))
        for low in range(0, len(order), batch):
            part = order[low: low + batch]
            place = np.concatenate([*(rows[i][0] for i in part), np.full(len(part), bias)])
            value = np.concatenate([*(rows[i][1] for i in part), np.ones(len(part))])
            row = np.concatenate([*(np.full(len(rows[i][0]), k) for k, i in enumerate(part)), np.arange(len(part))])
            at, inverse = np.unique(place, return_inverse=True)
            w = weight(at)
            error = labelled.sigmoid(np.bincount(row, weights=w[inverse] * value, minlength=len(part))) - np.array([labels[i] for i in part])
            g = np.bincount(inverse, weights=error[row] * value)
            z[at] += g - (np.sqrt(q[at] + g * g) - np.sqrt(q[at])) / alpha * w
            q[at] += g * g
    w = weight(np.arange(bias + 1))
    return {"weights": w[:bias].astype(np.float32), "bias": float(w[bias])}


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: float = 0.7,
             sample_rows: int = labelled.SAMPLE_ROWS // 2) -> DataFrame:
    """(doc_id, held_out, score, predicted) for documents (doc_id, text, ...)."""
    model = labelled.fit(labelled.labelled_sample(docs, labels, label, sample_rows), train)
    return labelled.score_rows(docs, lambda data, borders: labelled.sigmoid(dot(model, data, borders)), limit)


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: float = 0.7,
              sample_rows: int = labelled.SAMPLE_ROWS // 2) -> DataFrame:
    """The documents, all columns, that score ``limit`` or more."""
    model = labelled.fit(labelled.labelled_sample(docs, labels, label, sample_rows), train)
    return labelled.keep_rows(docs, lambda data, borders: labelled.sigmoid(dot(model, data, borders)), limit)


def query(spark, sf_dir) -> DataFrame:
    """op5: score of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
