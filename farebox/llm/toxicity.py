"""Toxicity by a factorization machine over hashed terms.

Terms are words (letters and digits, A-Z read as a-z) and how words begin, hashed. The
machine adds a weight per term and, for each pair of terms in a text, the product of their
factor vectors, so that an insult beside the mention of a group can count for more than
either does. It is fitted on at most ``MOST_TRAINING`` labelled documents and on terms that
go with the label; every document is then scored over its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import labelled_sample, mixed, range_hashes, row_starts, text_bytes, word_places

MOST_TRAINING = 8000  # labelled documents the model is fitted on
TERM_BITS = 20
BEGINNINGS = (4, 5)  # bytes
MOST_TERMS = 4096
LEAST_DOCUMENTS = 3
LEAST_ASSOCIATION = 10.8  # chi-square of one degree of freedom at one in a thousand
FACTORS = 4
ROUNDS = 300
RATE = 0.15
SHRINK = 2e-4
THRESHOLD = 0.3


@dataclass
class FactorizationMachine:
    bias: float
    place: np.ndarray  # of each hashed term among the model's, or -1
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, rows: np.ndarray, terms: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums over (row, term) entries, each of which is there once."""
        total = self.bias + np.bincount(rows, self.weights[terms], minlength=n_rows)
        for factor in self.factors.T:
            one = factor[terms]
            summed = np.bincount(rows, one, minlength=n_rows)
            total += 0.5 * (summed**2 - np.bincount(rows, one**2, minlength=n_rows))
        return total


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all texts, with repeats, and the row of each."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_places(data, offsets, letters_only=True)
    rows = np.repeat(np.arange(len(counts)), counts)
    kinds = [range_hashes(data, starts, ends)]
    for n in BEGINNINGS:
        kinds.append(mixed(range_hashes(data, starts, np.minimum(starts + n, ends)) ^ np.uint64(n)))
    terms = np.concatenate(kinds) >> np.uint64(64 - TERM_BITS)
    return terms.astype(np.int64), np.tile(rows, len(kinds))


def _distinct(rows: np.ndarray, terms: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    entries = np.unique((rows << bits) | terms)
    return entries >> bits, entries & ((1 << bits) - 1)


def distinct_terms(texts: pa.Array) -> pa.Array:
    terms, rows = terms_of(texts)
    rows, terms = _distinct(rows, terms, TERM_BITS)
    offsets = row_starts(np.bincount(rows, minlength=len(texts)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(terms, pa.int32()))


def _associated(rows: np.ndarray, terms: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Terms whose presence goes with the label, by the 2x2 chi-square, strongest first."""
    n, positive = len(labels), labels.sum()
    seen = np.bincount(terms, minlength=1 << TERM_BITS).astype(float)
    hits = np.bincount(terms, labels[rows], minlength=1 << TERM_BITS)
    spread = np.maximum(seen * (n - seen) * positive * (n - positive), 1)
    association = n * (hits * n - seen * positive) ** 2 / spread
    association[seen < LEAST_DOCUMENTS] = 0
    best = np.argsort(-association, kind="stable")[:MOST_TERMS]
    return best[association[best] >= LEAST_ASSOCIATION]


def fit_entries(rows: np.ndarray, terms: np.ndarray, labels: np.ndarray) -> FactorizationMachine:
    """Logistic loss, adaptive gradient steps over all entries at once."""
    n, positive = len(labels), float(labels.sum())
    rate = (positive + 0.5) / (n + 10)
    bias = float(np.log(rate / (1 - rate)))
    place = np.full(1 << TERM_BITS, -1, dtype=np.int32)
    chosen = _associated(rows, terms, labels) if 0 < positive < n else np.zeros(0, np.int64)
    place[chosen] = np.arange(len(chosen))
    start = np.random.default_rng(7).normal(0, 0.01, (len(chosen), FACTORS))
    model = FactorizationMachine(bias, place, np.zeros(len(chosen)), start)
    known = place[terms] >= 0
    rows, terms = rows[known], place[terms[known]]
    if not len(chosen):
        return model
    steps = [np.full(1, 1e-8), np.full(len(chosen), 1e-8), np.full((len(chosen), FACTORS), 1e-8)]
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-model.logits(rows, terms, n))) - labels
        at = error[rows] / n
        gradients = [
            np.array([error.mean()]),
            np.bincount(terms, at, minlength=len(chosen)) + SHRINK * model.weights,
            np.empty((len(chosen), FACTORS)),
        ]
        for f in range(FACTORS):
            one = model.factors[terms, f]
            rest = np.bincount(rows, one, minlength=n)[rows] - one
            gradients[2][:, f] = np.bincount(terms, at * rest, minlength=len(chosen))
        gradients[2] += SHRINK * model.factors
        for i, gradient in enumerate(gradients):
            steps[i] += gradient**2
            change = RATE * gradient / np.sqrt(steps[i])
            if i == 0:
                model.bias -= float(change[0])
            elif i == 1:
                model.weights -= change
            else:
                model.factors -= change
    return model


def fit(
    docs: DataFrame, labels: DataFrame, held_out: Column, most: int = MOST_TRAINING
) -> FactorizationMachine:
    """Fit on labelled documents not held out; with no label of either kind, only the bias."""
    sample = labelled_sample(docs, labels, "toxic", held_out, most)
    found = sample.select("doc_id", "label", F.arrow_udf("array<int>")(distinct_terms)("text").alias("terms")).toArrow()
    found = found.sort_by("doc_id")
    lists = found["terms"].combine_chunks()
    terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(found)), np.diff(lists.offsets.to_numpy()))
    return fit_entries(rows, terms, found["label"].to_numpy().astype(float))


def toxicity(text: str, model: FactorizationMachine, docs: DataFrame) -> Column:
    """Column of scores from 0 to 1 for the whole text in column ``text`` of ``docs``.

    A NULL or empty text, or one without any known term, gets the share of toxic
    documents among those learned from.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        machine = sent.value
        terms, rows = terms_of(texts)
        terms = machine.place[terms]
        known = terms >= 0
        rows, terms = _distinct(rows[known], terms[known].astype(np.int64), TERM_BITS)
        return pa.array(1 / (1 + np.exp(-machine.logits(rows, terms, len(texts)))))

    return scored(F.col(text))
