"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A chunk's tokens near its cut ends may differ from those of the whole text. Two
neighbouring chunks are spliced at a place in their overlap where both have a token
boundary and the two tokens that meet there, encoded together, stay those two tokens.
Such a place is stable: merges are picked by score and then from the left, so the first
merge across it in the whole text would also be picked between these two tokens alone.
Hence the spliced sequence is the encoding of the whole text. Without such a place the
overlap is doubled, up to the whole text if need be.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tillstream.llm.stage import own_names
from tillstream.llm.text import blocks

COUNT = "n_tokens"
CHUNK, OVERLAP = 32_768, 256
GUARD = "\ue000"  # a letter in no piece: nothing merges with it


def encoder(path: str) -> sentencepiece.SentencePieceProcessor:
    """The library's processor, if its model leaves texts as they are and merges by score alone."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError(f"{path}: only merge models that leave the text as it is are read")
    if any(p.type in (4, 5) for p in model.pieces):
        raise ValueError(f"{path}: unused or user-defined pieces are not supported")
    if any(GUARD in p.piece for p in model.pieces):
        raise ValueError(f"{path}: a piece holds the guard letter")
    return sentencepiece.SentencePieceProcessor(model_file=path)


def boundaries(sp, text: str) -> np.ndarray:
    """Ends of the pieces in the text, in characters; the library gives them in bytes."""
    pieces = sp.encode(text, return_type="proto").pieces
    ends = np.fromiter((p.end for p in pieces), np.int64, len(pieces))
    if text.isascii():
        return ends
    begins = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])[ends]


def stable(sp, text: str, left: int, at: int, right: int) -> bool:
    """Whether the tokens text[left:at] and text[at:right], encoded together, stay apart.

    The library puts a space ahead of what it encodes; the guard keeps it from the first token.
    """
    ends = boundaries(sp, GUARD + text[left:right]) - len(GUARD)
    return np.unique(ends[ends > 0]).tolist() == [at - left, right - left]


def splice(sp, text: str, mine: np.ndarray, theirs: np.ndarray, low: int, high: int) -> int | None:
    """A stable boundary of both chunks strictly between two places, the middle ones first."""
    both = np.intersect1d(mine, theirs)
    both = both[(both > low) & (both < high)]
    for at in both[np.argsort(np.abs(2 * both - low - high), kind="stable")].tolist():
        left, right = mine[mine < at].max(initial=0), theirs[theirs > at].min(initial=len(text))
        if left > 0 and stable(sp, text, left, at, right):
            return at
    return None


def count_tokens(sp, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of the whole text."""
    if len(text) <= chunk:
        return len(sp.encode(text))
    total, done = 0, 0  # tokens that end at or before `done` are counted
    start, stop = 0, chunk
    ends = boundaries(sp, text[:chunk])
    while stop < len(text):
        width, place = overlap, None
        while place is None and width < 2 * (stop - start):
            begin = max(stop - width, start)
            after = min(stop + chunk, len(text))
            later = boundaries(sp, text[begin:after]) + begin
            place = splice(sp, text, ends, later, max(begin, done), stop)
            width *= 2
        if place is None:
            stop = min(stop + chunk, len(text))
            ends = boundaries(sp, text[start:stop]) + start
            continue
        total += int(((ends > done) & (ends <= place)).sum()) + int(((ends <= 0) & (done == 0)).sum())
        start, stop, ends, done = begin, after, later, place
    return total + int((ends > done).sum()) + int(((ends <= 0) & (done == 0)).sum())


def with_counts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Add `n_tokens` (long) to every row: the tokens of the whole text, null as empty.

    `model` is the path of the file, present on all executors. Rows are neither dropped
    nor merged; a column named like the added one is replaced.
    """

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp = encoder(model)
        for batch in batches:
            for block in blocks(batch):
                texts = [t or "" for t in block.to_pylist()]
                short = [t for t in texts if len(t) <= CHUNK]
                counts = iter([len(ids) for ids in sp.encode(short, num_threads=1)])
                yield pa.array([next(counts) if len(t) <= CHUNK else count_tokens(sp, t) for t in texts], pa.int64())

    return own_names(docs, [COUNT]).withColumn(COUNT, counted(F.col(text)))
