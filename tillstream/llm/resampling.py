"""Importance resampling towards a target: hashed word n-grams weigh documents, Gumbel noise draws them.

Counts and weights use that a line break parts words. A text is cut into its lines; the
n-grams of a line are counted once for each distinct line of the corpus and multiplied by
how often it occurs; n-grams that span lines come from the two words at each end of a
line, document by document. Lines are shuffled once, combined before it; weights need no
shuffle, distinct lines are weighed once in each block of texts.

A word is a run of bytes other than 0x00 to 0x2F, 0x3A to 0x60 and 0x7B to 0x7F, once A to
Z are lowered: no byte of a longer UTF-8 sequence is one of these.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import own_names, stored, whole_text
from tillstream.llm.text import LOWER, blocks, bytes_of

BUCKETS, LONGEST = 10_000, 3
MIN_WORDS, PERCENT, SEED = 20, 5, 42
COLUMNS = ("n_words", "n_features", "weight", "score", "rank")
FACTS = "struct<n_words: long, n_features: long, weight: long>"
COUNTS = "bucket int, n long"

C = np.uint32
SEPARATOR = np.zeros(256, bool)
SEPARATOR[0x00:0x30] = SEPARATOR[0x3A:0x61] = SEPARATOR[0x7B:0x80] = True
SHORT = 64


def _crc_step() -> np.ndarray:
    """What each byte adds to a checksum: crc32's table."""
    table = np.arange(256, dtype=C)
    for _ in range(8):
        table = np.where(table & C(1), (table >> C(1)) ^ C(0xEDB88320), table >> C(1))
    return table


STEP = _crc_step()


def _applied(operator: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of checksums, given by the images of the values of each of their four bytes."""
    out = operator[0][x & C(255)]
    for j in range(1, 4):
        out = out ^ operator[j][(x >> C(8 * j)) & C(255)]
    return out


def _zero_bytes() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps that append 0 to 63 zero bytes, and 64, 128, ... of them."""
    maps = [np.arange(256, dtype=C)[None, :] << (C(8) * np.arange(4, dtype=C)[:, None])]
    for _ in range(SHORT):
        maps.append(STEP[maps[-1] & C(255)] ^ (maps[-1] >> C(8)))
    powers = [maps[SHORT]]
    for _ in range(25):
        powers.append(_applied(powers[-1], powers[-1]))
    return np.stack(maps[:SHORT]), powers


ZEROS, POWERS = _zero_bytes()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The share of a checksum in that of the same bytes with `length` more behind them."""
    low = length & (SHORT - 1)
    out = ZEROS[low, 0, crc & C(255)]
    for j in range(1, 4):
        out = out ^ ZEROS[low, j, (crc >> C(8 * j)) & C(255)]
    high = length >> 6
    k = 0
    while high.any():
        odd = np.flatnonzero(high & 1)
        out[odd] = _applied(POWERS[k], out[odd])
        high, k = high >> 1, k + 1
    return out


class Words(NamedTuple):
    """crc32 and length in bytes of every word; `first[t]` to `first[t + 1]` are the words of text t."""

    crc: np.ndarray
    length: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array) -> Words:
    data, at = bytes_of(texts)
    data = LOWER.astype(np.uint8)[data]
    inside = ~SEPARATOR[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[at[at < len(data)]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[at] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    length = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, C)
    short = np.flatnonzero(length <= SHORT)
    left = short[np.argsort(-length[short], kind="stable")]
    lengths = -length[left]
    for i in range(SHORT):
        left = left[: np.searchsorted(lengths, -i, "left")]
        lengths = lengths[: len(left)]
        if not len(left):
            break
        value = crc[left]
        crc[left] = STEP[(value ^ data[starts[left] + i]) & C(255)] ^ (value >> C(8))
    crc ^= C(0xFFFFFFFF)
    for w in np.flatnonzero(length > SHORT).tolist():
        crc[w] = zlib.crc32(data[starts[w] : ends[w]])
    return Words(crc, length, np.searchsorted(starts, at))


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each size of a run: the buckets of all runs, their first words and the size. Runs don't leave their text."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    behind_space = shifted(np.full(len(words.crc), zlib.crc32(b" "), C), words.length) ^ words.crc
    crc = words.crc
    for size in range(1, LONGEST + 1):
        if size > 1:
            crc = shifted(crc[:-1], words.length[size - 1 :] + 1) ^ behind_space[size - 1 :]
        at = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :]) if len(text) >= size else np.zeros(0, np.int64)
        yield (crc[at] % C(BUCKETS)).astype(np.int64), at, size
        if len(text) <= size:
            return


def per_text(words: Words, gains: np.ndarray) -> np.ndarray:
    """Sum of the gains of all features of each text."""
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    total = np.zeros(len(words.first) - 1, np.int64)
    for bucket, at, _ in features(words):
        np.add.at(total, text[at], gains[bucket])
    return total


class Lines(NamedTuple):
    """Distinct lines of a block, which of them stand in its texts, and where each text's begin."""

    distinct: list[str]
    which: np.ndarray
    first: np.ndarray


def lines_of(texts: list[str]) -> Lines:
    number: dict[str, int] = {}
    which, first = [], [0]
    for text in texts:
        which += [number.setdefault(line, len(number)) for line in text.split("\n")]
        first.append(len(which))
    return Lines(list(number), np.array(which, np.int64), np.array(first))


def ends_of(lines: Lines, words: Words) -> tuple[Words, np.ndarray]:
    """The two first and two last words of every line of every text, and the line each is of.

    A run of up to three words that spans lines has no more than two words of a line unless
    that line is inside it and a single word long.
    """
    count = np.diff(words.first)
    taken = np.minimum(count, 4)
    here = taken[lines.which]
    place = np.arange(here.sum()) - np.repeat(np.cumsum(here) - here, here)
    line = np.repeat(np.arange(len(lines.which)), here)
    skip = np.maximum(count - 4, 0)[lines.which]
    at = words.first[lines.which][line] + place + np.where(place >= 2, skip[line], 0)
    return Words(words.crc[at], words.length[at], np.concatenate([[0], np.cumsum(here)])[lines.first]), line


def across_lines(lines: Lines, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs that span lines, and the texts they are in."""
    edge, line = ends_of(lines, words)
    text = np.repeat(np.arange(len(lines.first) - 1), np.diff(edge.first))
    buckets, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for bucket, at, size in features(edge):
        spans = line[at] != line[at + size - 1]
        buckets.append(bucket[spans])
        of.append(text[at[spans]])
    return np.concatenate(buckets), np.concatenate(of)


def counts_table(total: np.ndarray) -> pa.RecordBatch:
    held = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["bucket", "n"])


def line_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of distinct lines, times their occurrences."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        times = batch.column("times").to_numpy(zero_copy_only=False)
        row = 0
        for block in blocks(batch.column("line")):
            words = words_of(block)
            line = np.repeat(np.arange(len(block)), np.diff(words.first)) + row
            row += len(block)
            for bucket, at, _ in features(words):
                np.add.at(total, bucket, times[line[at]])
    yield counts_table(total)


def crossing_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features that span lines."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for block in blocks(batch.column("text")):
            lines = lines_of([t or "" for t in block.to_pylist()])
            bucket, _ = across_lines(lines, words_of(pa.array(lines.distinct, pa.large_string())))
            total += np.bincount(bucket, minlength=BUCKETS)
    yield counts_table(total)


def feature_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. The driver gets BUCKETS rows."""
    whole = texts.select(whole_text(text).alias("text"))
    lines = whole.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    parts = distinct.mapInArrow(line_counts, COUNTS).unionByName(whole.mapInArrow(crossing_counts, COUNTS))
    total = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains_of(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over own share for each bucket, with one added to every count."""
    own, aim = float(ours.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * own / ((s + 1) * aim))) for s, t in zip(ours.tolist(), target.tolist())], np.int64)


def with_weights(docs: DataFrame, gains: np.ndarray, text: str = "text") -> DataFrame:
    """Add n_words, n_features and weight; distinct lines of a block of texts are weighed once."""

    @F.arrow_udf(FACTS)
    def weighed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for block in blocks(batch):
                lines = lines_of([t or "" for t in block.to_pylist()])
                words = words_of(pa.array(lines.distinct, pa.large_string()))
                counts = np.diff(words.first)
                own = np.stack([counts, np.maximum(counts - 1, 0) + np.maximum(counts - 2, 0) + counts, per_text(words, gains)])
                # Every text has a line, so that no sum is empty.
                sums = np.add.reduceat(own[:, lines.which], lines.first[:-1], axis=1)
                bucket, of = across_lines(lines, words)
                np.add.at(sums[1], of, 1)
                np.add.at(sums[2], of, gains[bucket])
                yield pa.StructArray.from_arrays([pa.array(s, pa.int64()) for s in sums], ["n_words", "n_features", "weight"])

    names = own_names(docs, COLUMNS).columns
    made = docs.select(*[F.col(f"`{c}`") for c in names], weighed(F.col(text)).alias("weight"))
    return made.select(*[F.col(f"`{c}`") for c in names], "weight.*")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))).cast("long")


def ranked(scored: DataFrame, percent: int = PERCENT, least: int = MIN_WORDS) -> DataFrame:
    """Add `rank` to the highest scores of the rows of enough words; ties go to smaller ids, then as rows come.

    Rows are spread by range, also those of one id and score, and sorted; their place is
    that in their part plus the sizes of the parts before. Only a row for each part meets
    in one task.
    """
    fit = F.col("n_words") >= least
    order = [fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_spread")]
    spread = scored.withColumn("_spread", F.monotonically_increasing_id())
    placed = spread.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed.drop("_spread"), "ranked")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"), F.count_if(fit).alias("_fit"))
    told = sizes.orderBy("_part").collect()
    draw, before, starts = percent * sum(r["_fit"] for r in told) // 100, 0, []
    for row in told:
        starts.append((row["_part"], before))
        before += row["_size"]
    start = placed.sparkSession.createDataFrame(starts, "_part long, _before long")
    place = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    joined = placed.withColumn("_of", part).join(F.broadcast(start), F.col("_of") == F.col("_part"))
    return joined.withColumn("rank", F.when(fit & (place <= draw), place)).drop("_of", "_part", "_before", "_place")


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add n_words, n_features, weight, score and rank (null: not drawn) to every row.

    `docs` has a column doc_id. Null texts count as empty: no feature, weight 0. Either
    table may be empty. Rows that repeat an id are rows of their own; equal scores are drawn
    in the order of ids, null ids last. Columns named like the added ones are replaced; all
    others come back, or those in `keep`. Scored rows are written once before they are ranked.
    """
    gains = gains_of(feature_counts(docs, text), feature_counts(target, "text"))
    weighed = with_weights(docs, gains, text)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    kept = own_names(docs, COLUMNS).columns if keep is None else keep
    return ranked(stored(scored.select(*[F.col(f"`{c}`") for c in (*kept, *COLUMNS[:-1])]), "scored"))
