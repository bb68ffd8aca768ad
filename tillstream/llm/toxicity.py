"""Toxicity scores: logistic regression over hashed word n-grams, trained by FTRL-proximal.

Every coordinate has its own learning rate, and the L1 term keeps most weights at exactly
zero, so that the model that is sent to the tasks is a short list of slots and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.samples import fold, labelled_sample, once, sampled_rows, within_bytes
from tillstream.llm.stage import own_names, stored
from tillstream.llm.text import U, Words, blocks, mixed, odd_constants, words_of

SCORE = "score"
BITS = 20
PER_CLASS = 4000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.1
FOLDS, HELD_OUT = 5, 0
# Distance between the two words of a pair: 1 is a bigram, the others skip-grams.
GAPS = (1, 2, 3)


class Model(NamedTuple):
    bias: float
    slots: np.ndarray
    weights: np.ndarray


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Slots of single words and of ordered pairs up to three words apart, with the text of each, sorted by text."""
    n = len(words.hashes)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    factor = odd_constants(len(GAPS) + 1, 7)
    found, of = [mixed(words.hashes * factor[0])], [doc]
    for gap, k in zip(GAPS, factor[1:]):
        if n > gap:
            same = doc[gap:] == doc[:-gap]
            found.append(mixed(words.hashes[:-gap] * k + mixed(words.hashes[gap:]))[same])
            of.append(doc[:-gap][same])
    slots = (np.concatenate(found) >> U(64 - BITS)).astype(np.int64)
    return slots, np.concatenate(of)


def distinct(slots: np.ndarray, doc: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Each slot once for each text, and the texts' offsets."""
    both = np.sort(doc << BITS | slots)
    both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
    return both & ((1 << BITS) - 1), np.searchsorted(both, np.arange(texts + 1) << BITS)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(examples: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """FTRL-proximal, one example at a time; the bias is a coordinate without L1."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at = examples[i]
            w = solved(z[at], n[at])
            b = -zb / ((BETA + nb**0.5) / ALPHA)
            g = float(weights[i] * (sigmoid(b + w.sum()) - labels[i]))
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / ALPHA * b
            nb += g * g
    w = solved(z, n)
    slots = np.flatnonzero(w)
    return Model(-zb / ((BETA + nb**0.5) / ALPHA), slots, w[slots])


def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the accumulated gradients stand for."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", per_class: int = PER_CLASS) -> Model:
    """Train on at most `per_class` labelled documents of each class outside the held-out fold,
    and SAMPLE_BYTES of their features.

    Examples are weighted so that the classes count as in all usable labels. Without
    labels of both classes every text scores the known share, or 0.5.
    """
    sample, sizes = labelled_sample(labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT, per_class)

    @F.arrow_udf("binary")
    def slots_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for block in blocks(batch):
                slots, at = distinct(*features(words_of(block)), len(block))
                slots = slots.astype(np.int32)
                yield pa.array([slots[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())

    rows = once(sampled_rows(docs.select("doc_id", text), sample).select("doc_id", "label", slots_of(text).alias("slots")))
    got = within_bytes(stored(rows, "examples"), ["slots"]).orderBy("doc_id").toArrow()
    y = got["label"].to_numpy().astype(float)
    counts = {c: int((y == c).sum()) for c in (0, 1)}
    if not all(counts.values()):
        share = (counts[1] + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, np.int64), np.zeros(0))
    factor = {c: sizes[c] / counts[c] * sum(counts.values()) / sum(sizes.values()) for c in (0, 1)}
    examples = [np.frombuffer(s, np.int32).astype(np.int64) for s in got["slots"].to_pylist()]
    return train(examples, y, np.where(y == 1, factor[1], factor[0]))


def with_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `score` (double, 0 to 1) to every row: the probability that the text is toxic.

    The whole text is used; null and empty texts score by the bias alone. A column named
    like the added one is replaced.
    """

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = np.zeros(1 << BITS)
        weight[model.slots] = model.weights
        live = weight != 0
        for batch in batches:
            for block in blocks(batch):
                slots, doc = features(words_of(block))
                used = live[slots]
                slots, at = distinct(slots[used], doc[used], len(block))
                total = np.concatenate([[0], np.cumsum(weight[slots])])
                yield pa.array(sigmoid(model.bias + total[at[1:]] - total[at[:-1]]), pa.float64())

    return own_names(docs, [SCORE]).withColumn(SCORE, scored(F.col(text)))
