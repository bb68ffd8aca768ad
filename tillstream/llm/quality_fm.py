"""Quality scores: a factorisation machine over hashed words, structure and metadata.

Inputs of a text are its hashed words, bins of structure statistics (lines, repeats,
letter case, symbols) and bins of its stated length. Every input has a weight and a short
vector; the products of all pairs of vectors are summed in linear time, as half of the
square of the sum less the sum of the squares.
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
from tillstream.llm.text import U, blocks, bytes_of, mixed, runs, words_of

SCORE = "score"
BITS = 15
FACTORS = 6
PER_CLASS = 4000
EPOCHS = 4
RATE, DECAY = 0.1, 1e-4
FOLDS, HELD_OUT = 3, 1
BINS = 16
STATISTICS = (
    "words", "word_length", "upper", "digits", "symbols", "marks", "other_bytes", "distinct_words",
    "distinct_triples", "distinct_lines", "words_per_line", "same_as_before", "stated_length",
)
INPUTS = (1 << BITS) + BINS * len(STATISTICS)


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    vectors: np.ndarray


def class_table(letters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(letters)] = True
    return table


CLASSES = [
    class_table(bytes(range(65, 91))),
    class_table(b"0123456789"),
    class_table(b"#*$%&|<>"),
    class_table(b"!?"),
    class_table(bytes(range(128, 256))),
]


def distinct_counts(values: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Number of different values of each text; 44 bits of a value are compared."""
    keys = np.sort(doc.astype(U) << U(44) | values >> U(20))
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    return np.bincount((keys[new] >> U(44)).astype(np.int64), minlength=texts)


def log_bin(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(x, 0) + 1), BINS - 1).astype(np.int64)


def share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bins of a share: narrow ones near 0 and near 1."""
    share = part / np.maximum(whole, 1)
    edges = [0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.995]
    return np.searchsorted(edges, share, "right")


def inputs(texts: pa.Array, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of all texts end to end, their values, and the texts' offsets."""
    n = len(texts)
    data, at = bytes_of(texts)
    words = words_of(texts)
    count = np.diff(words.first)
    doc = np.repeat(np.arange(n), count)
    size = np.diff(at)
    shares = []
    for table in CLASSES:
        places = np.flatnonzero(table[data])
        shares.append(share_bin(np.diff(np.searchsorted(places, at)), size))
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, words.starts) + doc  # a new text also begins a line
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])[: len(line)])
    line_hash = mixed(np.add.reduceat(words.hashes, first)) if len(first) else words.hashes
    lines = np.bincount(doc[first], minlength=n)
    triples, begin = runs(words, 3)
    again = np.zeros(n, np.int64)
    if len(doc) > 1:
        again = np.bincount(doc[1:][(words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    length = np.bincount(doc, weights=words.lengths, minlength=n)
    bins = [
        log_bin(count), np.minimum(length / np.maximum(count, 1), BINS - 1).astype(np.int64), *shares,
        share_bin(distinct_counts(words.hashes, doc, n), count),
        share_bin(distinct_counts(triples, doc[begin], n), np.maximum(count - 2, 0)),
        share_bin(distinct_counts(line_hash, doc[first], n), lines),
        log_bin(count / np.maximum(lines, 1)), share_bin(again, count), log_bin(stated),
    ]
    fixed = np.stack([(1 << BITS) + i * BINS + b for i, b in enumerate(bins)], 1)
    keys = np.sort(doc << BITS | (words.hashes >> U(64 - BITS)).astype(np.int64))
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    often = np.diff(np.append(new, len(keys))).astype(float)
    slot, of = keys[new] & ((1 << BITS) - 1), keys[new] >> BITS
    norm = np.sqrt(np.bincount(of, weights=often * often, minlength=n))
    ends = np.cumsum(np.bincount(of, minlength=n) + len(bins))
    offsets = np.concatenate([[0], ends])
    where = np.arange(len(slot)) + (of + 1) * len(bins)
    index, value = np.empty(ends[-1] if n else 0, np.int64), np.ones(ends[-1] if n else 0)
    index[(offsets[:-1, None] + np.arange(len(bins))).ravel()] = fixed.ravel()
    index[where], value[where] = slot, often / norm[of]
    return index, value, offsets


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, seed: int = 6) -> Model:
    """Gradient steps with a rate for each parameter (Adagrad), one example at a time."""
    draw = np.random.default_rng(seed)
    w, v = np.zeros(INPUTS), draw.normal(0, 0.05, (INPUTS, FACTORS))
    seen_w, seen_v, bias, seen_b = np.full(INPUTS, 1e-2), np.full((INPUTS, FACTORS), 1e-2), 0.0, 1e-2
    for _ in range(EPOCHS):
        for i in draw.permutation(len(examples)):
            at, x = examples[i]
            vx = v[at] * x[:, None]
            s = vx.sum(0)
            g = weights[i] * (sigmoid(bias + w[at] @ x + 0.5 * (s @ s - (vx * vx).sum())) - labels[i])
            gw = g * x + DECAY * w[at]
            gv = g * x[:, None] * (s - vx) + DECAY * v[at]
            seen_w[at] += gw * gw
            seen_v[at] += gv * gv
            seen_b += g * g
            w[at] -= RATE * gw / np.sqrt(seen_w[at])
            v[at] -= RATE * gv / np.sqrt(seen_v[at])
            bias -= RATE * g / seen_b**0.5
    return Model(float(bias), w.astype(np.float32), v.astype(np.float32))


def predicted(model: Model, index: np.ndarray, value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The linear part and the pairs of all texts in one pass. Every text has inputs."""
    start = offsets[:-1]
    total = model.bias + np.add.reduceat(model.weights[index] * value, start)
    for f in range(FACTORS):
        vx = model.vectors[index, f] * value
        s = np.add.reduceat(vx, start)
        total += 0.5 * (s * s - np.add.reduceat(vx * vx, start))
    return sigmoid(total)


def stated_lengths(lengths: pa.Array, texts: pa.Array) -> np.ndarray:
    """The stated number of characters; where it is missing, the bytes of the text."""
    said = lengths.to_numpy(zero_copy_only=False).astype(float)
    return np.where(np.isnan(said), np.diff(bytes_of(texts)[1]), said)


def length_column(docs: DataFrame, chars: str):
    has = chars in docs.columns
    return F.col(chars).cast("double") if has else F.lit(None).cast("double")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", chars: str = "n_chars", per_class: int = PER_CLASS) -> Model:
    """Train on at most `per_class` labelled documents of each class outside the held-out fold,
    and SAMPLE_BYTES of their inputs.

    Examples are weighted so that the classes count as in all usable labels. Without
    labels of both classes every text scores the known share, or 0.5.
    """
    sample, sizes = labelled_sample(labels, "quality", fold("doc_id", FOLDS) != HELD_OUT, per_class)

    @F.arrow_udf("struct<at: binary, x: binary>")
    def inputs_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lengths in batches:
            row = 0
            for block in blocks(texts):
                at, x, o = inputs(block, stated_lengths(lengths.slice(row, len(block)), block))
                row += len(block)
                parts = [
                    pa.array([a[i:j].tobytes() for i, j in zip(o[:-1], o[1:])], pa.binary())
                    for a in (at.astype(np.int32), x.astype(np.float32))
                ]
                yield pa.StructArray.from_arrays(parts, ["at", "x"])

    chosen = sampled_rows(docs.select("doc_id", F.col(text), length_column(docs, chars).alias("said")), sample)
    rows = chosen.select("doc_id", "label", inputs_of(text, "said").alias("i"))
    rows = stored(once(rows.select("doc_id", "label", "i.at", "i.x")), "examples")
    got = within_bytes(rows, ["at", "x"]).orderBy("doc_id").toArrow()
    y = got["label"].to_numpy().astype(float)
    counts = {c: int((y == c).sum()) for c in (0, 1)}
    if not all(counts.values()):
        share = (counts[1] + 1) / (len(y) + 2)
        return Model(float(np.log(share / (1 - share))), np.zeros(INPUTS, np.float32), np.zeros((INPUTS, FACTORS), np.float32))
    factor = {c: sizes[c] / counts[c] * sum(counts.values()) / sum(sizes.values()) for c in (0, 1)}
    examples = [
        (np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(float))
        for a, x in zip(got["at"].to_pylist(), got["x"].to_pylist())
    ]
    return train(examples, y, np.where(y == 1, factor[1], factor[0]))


def with_scores(docs: DataFrame, model: Model, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """Add `score` (double, 0 to 1) to every row: the probability of good quality.

    The whole text is used; a null text scores as an empty one. A column named like the
    added one is replaced.
    """

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lengths in batches:
            row = 0
            for block in blocks(texts):
                stated = stated_lengths(lengths.slice(row, len(block)), block)
                row += len(block)
                yield pa.array(predicted(model, *inputs(block, stated)), pa.float64())

    kept = own_names(docs, [SCORE])
    return kept.withColumn(SCORE, scored(F.col(text), length_column(kept, chars)))
