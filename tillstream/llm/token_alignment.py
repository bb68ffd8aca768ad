"""Alignment of two tokenizations of every text, and how often their tokens meet in the corpus.

A is a byte-level vocabulary of the tokenizers library, B a merge model of sentencepiece.
Both spell " " + text in bytes. The ends of a document's tokens are two rising lists; the
shorter one drives a galloping search (exponential, then binary) into the longer. The
common ends cut the tokens into groups: a group holds the tokens between two common
indices of each list, and differences of ranks tell how many those are.

Encoding is cached by units. A unit begins at white space that follows a letter or sign;
no token of either vocabulary spans such a place (`load` checks what this rests on).

Documents' distinct pairs are written once. The counts of pairs over all documents come
back to the documents by a join: the frequent pairs, each a share of 1/OFTEN of all
occurrences and so at most OFTEN of them, are sent to all tasks; the rest is shuffled.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm.bpe_codec import byte_letters
from tillstream.llm.piece_counts import encoder
from tillstream.llm.stage import own_names, stored
from tillstream.llm.text import blocks

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
ALIGNED = "struct<n_a: long, n_b: long, n_groups: long, n_links: long, groups: string, pairs: array<struct<a: int, b: int, n: long>>>"
OFTEN = 1 << 18
KNOWN_UNITS = 300_000
TOGETHER = 1000
BLOCK, LINKS = 1 << 20, 1 << 20
SPACE_MARK = "▁"
UNIT = r"\s+\S*(?:[^\S{0}]\s*\S*)*"


class Vocabularies(NamedTuple):
    """Both encoders, the bytes of their tokens, and the pattern of units that they agree on."""

    a: Tokenizer
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    unit: re.Pattern
    lone_space: int


def load(a_path: str, b_path: str) -> Vocabularies:
    """Read both vocabularies; refuse those whose tokens could span two units.

    A must cut texts as byte-level vocabularies do by default, where no token holds white
    space behind anything else. In B no piece may hold a space behind anything else; line
    breaks and tabs part units only if no piece holds them.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    cut = a.pre_tokenizer
    if a.normalizer is not None or type(cut).__name__ != "ByteLevel" or cut.add_prefix_space or not cut.use_regex:
        raise ValueError(f"{a_path}: only plain byte-level vocabularies are read")
    b = encoder(b_path)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
        raise ValueError(f"{b_path}: a piece spans two words")
    byte_of = {letter: i for i, letter in enumerate(byte_letters())}
    size = a.get_vocab_size(with_added_tokens=True)
    a_bytes = [bytes(byte_of[c] for c in a.id_to_token(i) or "" if c in byte_of) for i in range(size)]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
    parting = "".join(c for c in " \n\t\r" if c == " " or not any(c in p for p in pieces))
    lone = b.piece_to_id(SPACE_MARK)
    if b.is_unknown(lone):
        raise ValueError(f"{b_path}: no piece for a space")
    return Vocabularies(a, b, a_bytes, b_bytes, re.compile(UNIT.format(re.escape(parting))), lone)


class Cached:
    """Token ids of units met before, end to end, for one of the vocabularies."""

    def __init__(self) -> None:
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
        self.ids = np.concatenate([self.ids, ids])

    def of(self, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts' units end to end, and where each text's begin."""
        size = (self.starts[1:] - self.starts[:-1])[units]
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[units] - (ends - size), size)
        return self.ids[where], np.concatenate([[0], ends])[first]


class Numbers(dict):
    """Numbers of units in the order they are met."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


class Tokens(NamedTuple):
    """Ids of all texts end to end, `first[t]` to `first[t + 1]` those of text t."""

    ids: np.ndarray
    first: np.ndarray


class Encoder:
    """Encodes texts with both vocabularies, by units."""

    def __init__(self, v: Vocabularies):
        self.v = v
        self.a_size = np.array([len(t) for t in v.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in v.b_bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.well = np.zeros(0, bool)
        self.a, self.b = Cached(), Cached()

    def a_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of units end to end, and where each unit's end.

        Units that end in a letter or sign are encoded many at a time: no token spans two of
        them, and tokens spell their bytes, so that the units' lengths tell them apart. The
        others come last.
        """
        together = [i for i, u in enumerate(units) if not u[-1].isspace()]
        apart = [i for i, u in enumerate(units) if u[-1].isspace()]
        joined = ["".join(units[i] for i in together[k : k + TOGETHER]) for k in range(0, len(together), TOGETHER)]
        told = self.v.a.encode_batch_fast(joined + [units[i] for i in apart], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in told), np.int32)
        order = np.array(together + apart, np.int64)
        size = byte_lengths(units)[order]
        ends = np.searchsorted(np.cumsum(self.a_size[ids]), np.cumsum(size)) + 1
        starts, count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        count[order] = np.diff(ends, prepend=0)
        starts[order] = ends - count[order]
        ends = np.cumsum(count)
        return ids[np.arange(ends[-1]) + np.repeat(starts - (ends - count), count)], ends

    def b_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of units, likewise. The encoder puts a space ahead, which a unit has of its own or must lose."""
        told = self.v.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        told = [ids[1:] if u[0] != " " else ids or [self.v.lone_space] for u, ids in zip(units, told)]
        ends = np.cumsum(np.fromiter(map(len, told), np.int64, len(told)))
        return np.fromiter(chain.from_iterable(told), np.int32, int(ends[-1])), ends

    def encode(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        cut = [self.v.unit.findall(" " + t) if t else [] for t in texts]
        if len(self.number) > KNOWN_UNITS:
            self.forget()
        # One look for each unit; those met for the first time get the next numbers.
        known = len(self.number)
        units = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        if len(self.number) > known:
            new = list(islice(self.number, known, None))
            a, b = self.a_ids(new), self.b_ids(new)
            self.well = np.concatenate([self.well, spelled_units(new, *a, self.v.a_bytes) & spelled_units(new, *b, self.v.b_bytes)])
            self.a.add(*a)
            self.b.add(*b)
        first = np.cumsum([0, *map(len, cut)])
        a, b = Tokens(*self.a.of(units, first)), Tokens(*self.b.of(units, first))
        doubtful = np.unique(np.searchsorted(first, np.flatnonzero(~self.well[units]), "right") - 1)
        bad = [i for i in doubtful.tolist() if not self.spelled(" " + texts[i], i, a, b)]
        return (without(a, bad), without(b, bad)) if bad else (a, b)

    def spelled(self, text: str, i: int, a: Tokens, b: Tokens) -> bool:
        """Whether the tokens of both vocabularies join to the text."""
        told = text.encode()
        return all(
            b"".join(map(table.__getitem__, t.ids[t.first[i] : t.first[i + 1]].tolist())) == told
            for table, t in ((self.v.a_bytes, a), (self.v.b_bytes, b))
        )


def byte_lengths(units: list[str]) -> np.ndarray:
    return pc.binary_length(pa.array(units, pa.large_string())).to_numpy().astype(np.int64)


def spelled_units(units: list[str], ids: np.ndarray, ends: np.ndarray, table: list[bytes]) -> np.ndarray:
    """Whether the tokens of each unit join to it. A text is its units end to end, so that only texts with others need a look."""
    made = b"".join(map(table.__getitem__, ids.tolist()))
    size = np.concatenate([[0], np.cumsum(np.fromiter(map(len, table), np.int64, len(table))[ids])])[np.concatenate([[0], ends])]
    told = np.concatenate([[0], np.cumsum(byte_lengths(units))])
    if np.array_equal(size, told) and made == "".join(units).encode():
        return np.ones(len(units), bool)
    return np.array([made[i:j] == u.encode() for u, i, j in zip(units, size.tolist(), size[1:].tolist())])


def without(tokens: Tokens, texts: list[int]) -> Tokens:
    """The tokens of some texts removed."""
    count = np.diff(tokens.first)
    gone = np.zeros(len(count), bool)
    gone[texts] = True
    return Tokens(tokens.ids[~np.repeat(gone, count)], np.cumsum([0, *np.where(gone, 0, count)]))


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value of one rising list the first place in the other that is not below it.

    `start` is a place at or before each answer. Steps double until they pass the value,
    then the last step is halved; all values move at once, and those that arrived rest.
    """
    low = start - 1  # everything up to here is below the value
    high = np.full(len(short), len(long))
    step, moving = 1, np.arange(len(short))
    while len(moving):
        at = low[moving] + step
        inside = at < len(long)
        below = inside & (long[np.minimum(at, len(long) - 1)] < short[moving])
        high[moving[~below]] = np.minimum(at[~below], len(long))
        low[moving[below]] = at[below]
        moving, step = moving[below], step * 2
    moving = np.flatnonzero(high - low > 1)
    while len(moving):
        middle = (low[moving] + high[moving]) // 2
        below = long[middle] < short[moving]
        low[moving[below]] = middle[below]
        high[moving[~below]] = middle[~below]
        moving = moving[high[moving] - low[moving] > 1]
    return high


def common_ends(a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that stand in both lists of a text, over all texts.

    Ends rise over all texts, since each text's begin behind the last one's. The shorter
    list of a text drives; an end can't stand earlier in the longer list than the first
    of its text.
    """
    a_drives = np.diff(a_first) <= np.diff(b_first)
    pairs = []
    for drives, one, one_first, other, other_first in ((a_drives, a, a_first, b, b_first), (~a_drives, b, b_first, a, a_first)):
        count = np.diff(one_first)
        text = np.repeat(np.arange(len(count)), count)
        mine = np.flatnonzero(drives[text])
        # Every STRIDE-th end gallops from its text's first place, those between from where it stopped.
        place = gallop_in_order(one[mine], other, other_first[text[mine]])
        hit = (place < len(other)) & (other[np.minimum(place, max(len(other) - 1, 0))] == one[mine]) if len(other) else np.zeros(len(mine), bool)
        pairs.append((mine[hit], place[hit]))
    (a1, b1), (b2, a2) = pairs
    at_a, at_b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    order = np.argsort(at_a)
    return at_a[order], at_b[order]


STRIDE = 8


def gallop_in_order(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Galloping search where later values start from the places of earlier ones, those again from earlier ones."""
    place = start.copy()
    heads = np.arange(0, len(short), STRIDE)
    place[heads] = (gallop_in_order if len(heads) > STRIDE else gallop)(short[heads], long, start[heads])
    reached = np.maximum(start, place[heads][np.arange(len(short)) // STRIDE] if len(heads) else start)
    return gallop(short, long, reached)


class Groups(NamedTuple):
    """Groups of all texts: where their tokens of A and B begin and end, and their text."""

    a_from: np.ndarray
    a_to: np.ndarray
    b_from: np.ndarray
    b_to: np.ndarray
    text: np.ndarray


def groups_of(a: Tokens, b: Tokens, a_size: np.ndarray, b_size: np.ndarray) -> Groups:
    """Cut the tokens at common ends. Both lists of a text end at its last byte, so no token is left over."""
    a_ends, b_ends = np.cumsum(a_size[a.ids]), np.cumsum(b_size[b.ids])
    at_a, at_b = common_ends(a_ends, a.first, b_ends, b.first)
    text = np.searchsorted(a.first, at_a, "right") - 1
    a_from, b_from = np.append(0, at_a[:-1] + 1)[: len(at_a)], np.append(0, at_b[:-1] + 1)[: len(at_b)]
    return Groups(a_from, at_a + 1, b_from, at_b + 1, text)


def links(a: Tokens, b: Tokens, g: Groups) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and id pair (A's id above B's) of every link, about LINKS at a time."""
    n_a, n_b = g.a_to - g.a_from, g.b_to - g.b_from
    # A token of A meets all of B's tokens of its group.
    group = np.repeat(np.arange(len(n_a)), n_a)
    times = n_b[group]
    total = np.concatenate([[0], np.cumsum(times)])
    i = 0
    while i < len(group):
        j = max(i + 1, int(np.searchsorted(total, total[i] + LINKS, "right")) - 1)
        some, size = group[i:j], times[i:j]
        left = np.repeat(np.arange(i, j), size)
        right = np.repeat(g.b_from[some], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        yield np.repeat(g.text[some], size), a.ids[left].astype(np.int64) << 32 | b.ids[right]
        i = j


def pairs_of(a: Tokens, b: Tokens, g: Groups, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of every text in order, their numbers of links, and where each text's begin."""
    # One number for text and pair: a block has no more texts than bytes, so that it fits by far.
    wide_b = int(b.ids.max(initial=0)) + 1
    wide = (int(a.ids.max(initial=0)) + 1) * wide_b
    if texts * wide >= 1 << 63:
        raise ValueError("too many texts at once for vocabularies of this size")
    key, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for text, pair in links(a, b, g):
        more = np.sort(text * wide + (pair >> 32) * wide_b + (pair & 0xFFFFFFFF))
        new = np.flatnonzero(np.append(True, more[1:] != more[:-1]))
        more, more_times = more[new], np.diff(np.append(new, len(more)))
        if len(key):
            key, times = np.concatenate([key, more]), np.concatenate([times, more_times])
            order = np.argsort(key, kind="stable")
            key, times = key[order], times[order]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, times = key[new], np.add.reduceat(times, new)
        else:
            key, times = more, more_times
    first = np.searchsorted(key, np.arange(texts + 1) * wide)
    pair = key % wide
    return pair // wide_b << 32 | pair % wide_b, times, first


class Spelling:
    """Groups as text: ids within a list are parted by commas, the lists by |, groups by ;."""

    def __init__(self, a: int, b: int):
        self.a = [np.array([f"{i}{mark}" for i in range(a)], object) for mark in ",|"]
        self.b = [np.array([f"{i}{mark}" for i in range(b)], object) for mark in ",;"]

    def of(self, a: Tokens, b: Tokens, g: Groups) -> list[str]:
        n_a, n_b = g.a_to - g.a_from, g.b_to - g.b_from
        out = np.empty(len(a.ids) + len(b.ids), object)
        for table, ids, count, shift, ends in (
            (self.a, a.ids, n_a, g.b_from, g.a_to),
            (self.b, b.ids, n_b, g.a_to, g.b_to),
        ):
            told = table[0][ids]
            told[ends - 1] = table[1][ids[ends - 1]]
            out[np.arange(len(ids)) + np.repeat(shift, count)] = told
        first, parts = (a.first + b.first).tolist(), out.tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip(first, first[1:])]


def aligned_block(encoder: Encoder, spelling: Spelling, texts: list[str]) -> pa.StructArray:
    a, b = encoder.encode(texts)
    g = groups_of(a, b, encoder.a_size, encoder.b_size)
    pair, times, first = pairs_of(a, b, g, len(texts))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, g.text, (g.a_to - g.a_from) * (g.b_to - g.b_from))
    rows = pa.StructArray.from_arrays(
        [pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(times)], ["a", "b", "n"]
    )
    columns = [np.diff(a.first), np.diff(b.first), np.bincount(g.text, minlength=len(texts)), n_links]
    listed = pa.ListArray.from_arrays(pa.array(first, pa.int32()), rows)
    return pa.StructArray.from_arrays(
        [*[pa.array(c, pa.int64()) for c in columns], pa.array(spelling.of(a, b, g)), listed],
        ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
    )


def with_groups(docs: DataFrame, a_path: str, b_path: str, text: str = "text", digest: bool = False) -> DataFrame:
    """Add `aligned`: counts, the groups as text (or its SHA-256) and the distinct pairs of every row."""

    @F.arrow_udf(ALIGNED)
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = load(a_path, b_path)
        encoder, spelling = Encoder(v), Spelling(len(v.a_bytes), len(v.b_bytes))
        for batch in batches:
            for block in blocks(batch, BLOCK):
                made = aligned_block(encoder, spelling, [t or "" for t in block.to_pylist()])
                if digest:
                    told = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in made.field("groups").to_pylist()]
                    made = pa.StructArray.from_arrays([pa.array(told) if f.name == "groups" else made.field(f.name) for f in made.type], [f.name for f in made.type])
                yield made

    return docs.withColumn("aligned", aligned(F.col(text)))


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, documents that hold the pair linked, and whether no pair of `a` is in more. One row for each pair.

    A row of the given frame holds a pair once, so occurrences are documents. The rows of
    one id of A are no more than B has tokens.
    """
    counts = rows.select(F.explode("aligned.pairs").alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("documents"))
    highest = F.max("documents").over(Window.partitionBy("a"))
    return counts.withColumn("is_best", F.col("documents") == highest)


def with_links(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: Sequence[str] | None = None, digest: bool = False) -> DataFrame:
    """Add n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups (string) to every row.

    `groups` lists the groups as `a1,a2|b1;a3|b2,b3`, with `digest` as its SHA-256. Null and
    empty texts, and those whose tokens don't join to a space and the text, have zeros and
    ''. Every row is a document, also where ids repeat or are null. Columns named like the
    added ones are replaced; all others come back, or those in `keep`.
    """
    names = list(own_names(docs, COLUMNS).columns if keep is None else keep)
    made = with_groups(docs.select(F.struct("*").alias("row")), a_path, b_path, f"row.{text}", digest)
    kept = F.struct(*[F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate(names)]) if names else F.lit(None).cast("int")
    rows = stored(made.select(F.monotonically_increasing_id().alias("at"), kept.alias("row"), "aligned"), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("t")).first()["t"]
    often = F.col("documents") * OFTEN >= total
    pairs = rows.select("at", F.explode("aligned.pairs").alias("p")).select("at", "p.*")
    frequent = F.broadcast(counts.where(often).withColumnsRenamed({"a": "of_a", "b": "of_b"}))
    looked = pairs.join(frequent, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")), "left")
    rare = counts.where(~often).select("a", "b", "documents", "is_best")
    rest = looked.where("documents is null").select("at", "a", "b", "n").join(rare, ["a", "b"])
    found = looked.where("documents is not null").select("at", "n", "documents", "is_best").unionByName(rest.select("at", "n", "documents", "is_best"))
    sums = found.groupBy(F.col("at").alias("of")).agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("documents")).alias("count_sum")
    )
    joined = rows.select("at", "row", *[F.col(f"aligned.{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "groups")])
    joined = joined.join(sums, F.col("at") == F.col("of"), "left")
    zero = F.lit(0).cast("long")
    values = {"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}
    return joined.select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], *[values.get(c, F.col(c)).alias(c) for c in COLUMNS]
    )
