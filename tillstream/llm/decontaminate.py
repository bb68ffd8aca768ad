"""Test items that leaked into training texts, also when edited or paraphrased in part.

Seeds are short word n-grams of the items. Where a document holds a seed, the words around
it, as many on both sides as the item has, are aligned with the item (Smith-Waterman on
words); the score is the alignment's value over that of the item with itself. An alignment
that reaches the threshold has no more gaps than that, so no score comes out too low.

A seed that few items share leads to few windows. One that many share, such as a stock
opening, is not dropped: all its windows are first counted at once for words of their item,
and those with too few to reach the threshold are passed over. This loses no pair, so
neither how often an item stands in the documents nor how many items share its words
matters. Items of fewer words than a seed are found where they stand verbatim, anywhere in
a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import stored
from tillstream.llm.text import U, Words, blocks, mixed, runs, words_of

SEED_WORDS = 4
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
SHARD_WORDS = 2_000_000
ALIGN_CELLS = 4_000_000
HITS = 1 << 20
COUNTED_WORDS = 1 << 21

LEAKS = "doc_id long, item_id long, score double, first_word int, last_word int"
OUT = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())]
)


class Items(NamedTuple):
    """Items end to end, their seeds sorted by hash with item and place, and the lengths of seeds."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_place: np.ndarray
    sizes: list[int]
    held: np.ndarray  # sorted: the words of each item, mixed with the item's number


def seed_runs(words: Words, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of so many words, their first words and their texts."""
    parts = [runs(words, size) for size in sizes]
    hashes, at = np.concatenate([h for h, _ in parts]), np.concatenate([a for _, a in parts])
    return hashes, at, np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[at]


def items_of(ids: np.ndarray, texts: pa.Array) -> Items:
    """An item of fewer than SEED_WORDS words is one seed, looked for as a run of its own length."""
    words = words_of(texts)
    own = np.minimum(np.diff(words.first), SEED_WORDS)
    sizes = np.unique(own[own > 0]).tolist() or [SEED_WORDS]
    parts = []
    for size in sizes:
        hashes, at, item = seed_runs(words, [size])
        fits = own[item] == size
        parts.append((hashes[fits], at[fits], item[fits]))
    hashes, at, item = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(hashes, kind="stable")
    held = np.unique(word_of_item(words.hashes, np.repeat(np.arange(len(ids)), np.diff(words.first))))
    return Items(ids, words.hashes, words.first, hashes[order], item[order], (at - words.first[item])[order], sizes, held)


def word_of_item(words: np.ndarray, item: np.ndarray) -> np.ndarray:
    return mixed(words ^ mixed(item.astype(U) + U(1)))


def shards(benchmark: DataFrame) -> Iterator[Items]:
    """The items with words and an id, in blocks of a bounded number of words.

    Items come to the driver row by row, and no more than a block is held or sent at once.
    """
    ids, texts, size = [], [], 0
    known = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    for row in known.toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].split())
        if size >= SHARD_WORDS:
            yield items_of(np.array(ids, np.int64), pa.array(texts))
            ids, texts, size = [], [], 0
    if ids:
        yield items_of(np.array(ids, np.int64), pa.array(texts))


def found(sorted_seeds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Indices of the hashes that are seeds."""
    if not len(sorted_seeds):
        return np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(sorted_seeds, hashes), len(sorted_seeds) - 1)
    return np.flatnonzero(sorted_seeds[place] == hashes)


def aligned(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of one item with the rows of a matrix of words: best value, its first and last column.

    A row of cells depends on the one above; gaps along the row are a running maximum.
    """
    rows, width = windows.shape
    above, above_from = np.zeros((rows, width + 1), np.int32), np.tile(np.arange(width + 1, dtype=np.int32), (rows, 1))
    best, low, high = np.zeros(rows, np.int32), np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    ramp = np.arange(width + 1, dtype=np.int32) * -GAP
    line = np.arange(rows)
    for word in item:
        cell = np.zeros_like(above)
        origin = np.tile(np.arange(width + 1, dtype=np.int32), (rows, 1))
        slant = above[:, :-1] + np.where(windows == word, MATCH, MISMATCH)
        drop = above[:, 1:] + GAP
        take = np.maximum(slant, drop)
        good = take > 0
        cell[:, 1:] = np.where(good, take, 0)
        origin[:, 1:] = np.where(good, np.where(slant >= drop, above_from[:, :-1], above_from[:, 1:]), origin[:, 1:])
        lifted = cell + ramp
        top = np.maximum.accumulate(lifted, 1)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(width + 1), 0), 1)
        run = top - ramp
        longer = run > cell
        cell = np.where(longer, run, cell)
        origin = np.where(longer, np.take_along_axis(origin, source, 1), origin)
        at = cell.argmax(1)
        value = cell[line, at]
        better = value > best
        best = np.where(better, value, best)
        low, high = np.where(better, origin[line, at], low), np.where(better, at - 1, high)
        above, above_from = cell, origin
    return best, low, high


def hits(words: Words, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, item and supposed begin of the item, for every seed of an item in a text; about HITS at a time."""
    hashes, at, doc = seed_runs(words, items.sizes)
    hit = found(items.seeds, hashes)
    left, right = np.searchsorted(items.seeds, hashes[hit]), np.searchsorted(items.seeds, hashes[hit], "right")
    total = np.concatenate([[0], np.cumsum(right - left)])
    a = 0
    while a < len(hit):
        b = max(a + 1, int(np.searchsorted(total, total[a] + HITS, "right")) - 1)
        times = right[a:b] - left[a:b]
        which = np.repeat(left[a:b], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        yield np.repeat(doc[hit[a:b]], times), items.seed_item[which], np.repeat(at[hit[a:b]], times) - items.seed_place[which]
        a = b


def leaks_in(texts: pa.Array, items: Items) -> dict[tuple[int, int], tuple[float, int, int]]:
    """Best alignment of every pair of a document and an item that share a seed."""
    words = words_of(texts)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for doc, item, start in hits(words, items):
        align(words, items, doc, item, start, best)
    return best


def margin_of(length: np.ndarray) -> np.ndarray:
    """Words on each side of an item's supposed place: a score of the threshold leaves room for so many gaps."""
    return np.maximum(length, SEED_WORDS)


def enough_words(words: Words, items: Items, doc: np.ndarray, item: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each window holds as many words of its item as the threshold takes, for all items at once."""
    length = np.diff(items.first)[item]
    low = np.maximum(start - margin_of(length), words.first[doc])
    width = np.maximum(np.minimum(start + length + margin_of(length), words.first[doc + 1]) - low, 0)
    ends = np.cumsum(width)
    out = np.zeros(len(doc), bool)
    a = 0
    while a < len(doc):
        before = ends[a] - width[a]
        b = max(a + 1, int(np.searchsorted(ends, before + COUNTED_WORDS, "right")))
        size = width[a:b]
        at = np.arange(size.sum()) + np.repeat(low[a:b] - (ends[a:b] - size - before), size)
        key = word_of_item(words.hashes[at], np.repeat(item[a:b], size))
        place = np.minimum(np.searchsorted(items.held, key), len(items.held) - 1)
        hit = np.concatenate([[0], np.cumsum(items.held[place] == key)])
        out[a:b] = hit[ends[a:b] - before] - hit[ends[a:b] - size - before] >= THRESHOLD * length[a:b]
        a = b
    return out


def align(words: Words, items: Items, doc: np.ndarray, item: np.ndarray, start: np.ndarray, best: dict[tuple[int, int], tuple[float, int, int]]) -> None:
    """Enter the best alignments of some hits."""
    length = np.diff(items.first)
    # Hits of one pair whose starts lie within a quarter of the item are one window.
    slot = start // np.maximum(length[item] // 4, 4)
    order = np.lexsort((start, slot, item, doc))
    doc, item, start, slot = doc[order], item[order], start[order], slot[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (slot[1:] != slot[:-1]))[: len(doc)]
    doc, item, start = doc[new], item[new], start[new]
    fits = enough_words(words, items, doc, item, start)
    doc, item, start = doc[fits], item[fits], start[fits]
    by_item = np.argsort(item, kind="stable")
    edges = np.flatnonzero(np.append(True, np.diff(item[by_item]) != 0)[: len(item)])
    for group in np.split(by_item, edges[1:]) if len(item) else []:
        n = int(length[item[group[0]]])
        margin = int(margin_of(np.int64(n)))
        own = items.words[items.first[item[group[0]]] : items.first[item[group[0]] + 1]]
        step = max(1, ALIGN_CELLS // (n + 2 * margin))
        for some in (group[i : i + step] for i in range(0, len(group), step)):
            column = start[some][:, None] - margin + np.arange(n + 2 * margin)
            inside = (column >= words.first[doc[some]][:, None]) & (column < words.first[doc[some] + 1][:, None])
            window = np.where(inside, words.hashes[np.clip(column, 0, len(words.hashes) - 1)], U(0))
            value, low, high = aligned(own, window)
            for j, v, a, b in zip(some.tolist(), value.tolist(), low.tolist(), high.tolist()):
                score = v / (MATCH * n)
                if score >= THRESHOLD:
                    d = int(doc[j])
                    begin = int(start[j]) - margin - int(words.first[d])
                    key, new_best = (d, int(item[j])), (score, begin + a, begin + b)
                    if key not in best or (-score, begin + a) < (-best[key][0], best[key][1]):
                        best[key] = new_best


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, item_id, score, first_word, last_word of every item that a document contains.

    The score is 1 for a whole verbatim item; pairs from THRESHOLD on are returned, each
    with its best place in words of the document. Null, empty and blank texts and items
    match nothing; of rows that repeat an id the best place counts. Large benchmarks are
    treated in blocks, each against all documents.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in shards(benchmark):

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row = 0
                for block in blocks(batch.column("text")):
                    ids = batch.column("doc_id").slice(row, len(block)).to_pylist()
                    row += len(block)
                    got = leaks_in(block, items)
                    lines = [(ids[d], int(items.ids[i]), *rest) for (d, i), rest in got.items()]
                    if lines:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*lines), OUT)], schema=OUT)

        met = stored(rows.mapInArrow(search, LEAKS), "leaks")
        out = met if out is None else out.union(met)
    if out is None:
        return docs.sparkSession.createDataFrame([], LEAKS)
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct("score", -F.col("first_word")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
