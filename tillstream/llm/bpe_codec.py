"""Byte-pair encoding and decoding of texts, in numpy merge rounds over many words.

The distinct words of a batch are laid end to end in one array of symbols. A round
looks up every adjacent pair in the sorted pair keys by binary search, finds the
lowest rank of each word and merges all its occurrences in that word from the left.
That equals merging one pair at a time, because a pair that contains a merged symbol
always ranks behind the merge that made it; `load` refuses vocabularies where it doesn't.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import own_names
from tillstream.llm.text import blocks

IDS, DECODED = "token_ids", "decoded"
KNOWN_UNITS = 300_000
NONE = np.iinfo(np.int32).max

# Letters, digits and lower-case forms that the tokenizers library knows
# and Python 3.13's character database (Unicode 15.1) doesn't yet.
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_DIGITS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]
NEWER_LOWER = {c: c + 1 for c in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
NEWER_LOWER |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
NEWER_LOWER |= {0xA7CB: 0x0264, 0xA7DC: 0x019B}


class Vocabulary(NamedTuple):
    tokens: list[str]
    letters: dict[str, int]
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    alphabet: np.ndarray
    final: np.ndarray
    words: str
    special: dict[str, int]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def load(path: str) -> Vocabulary:
    """Read a vocabulary of the kind with word ends, lower case and dropped white space."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model = told["model"]
    suffix = model["end_of_word_suffix"] or ""
    if told["decoder"] or told["post_processor"] or model["byte_fallback"] or model["ignore_merges"] or not suffix:
        raise ValueError(f"{path}: only byte-level vocabularies with word ends are read")
    steps = [s["type"] for s in told["normalizer"]["normalizers"]]
    cut = told["pre_tokenizer"]["pretokenizers"]
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cut] != ["Split", "ByteLevel"]:
        raise ValueError(f"{path}: unknown normaliser or word splitter")
    ids = model["vocab"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left = np.array([ids[a] for a, _ in pairs], np.int64)
    right = np.array([ids[b] for _, b in pairs], np.int64)
    made = np.array([ids[a + b] for a, b in pairs], np.int32)
    size = max(ids.values()) + 1
    born = np.full(size, -1, np.int64)
    born[made[::-1]] = np.arange(len(made))[::-1]
    later = np.arange(len(made))
    if (born[left] >= later).any() or (born[right] >= later).any() or len(np.unique(made)) != len(made):
        raise ValueError(f"{path}: a merge ranks before the merges of its own parts")
    keys = left << 32 | right
    order = np.argsort(keys)
    tokens = [""] * (max([size - 1, *(t["id"] for t in told["added_tokens"])]) + 1)
    for token, number in ids.items():
        tokens[number] = token
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    for token, number in special.items():
        tokens[number] = token
    letters = byte_letters()
    return Vocabulary(
        tokens,
        ids,
        keys[order],
        order.astype(np.int32),
        made[order],
        np.array([ids[c] for c in letters], np.int32),
        np.array([ids[c + suffix] for c in letters], np.int32),
        word_pattern(cut[0]["pattern"]["Regex"]),
        special,
    )


def pair_ranks(symbols: np.ndarray, word: np.ndarray, at: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Rank of the pair that begins at each of the places, and the symbol it becomes."""
    after = np.minimum(at + 1, len(symbols) - 1)
    key = symbols[at].astype(np.int64) << 32 | symbols[after]
    found = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
    good = (v.keys[found] == key) & (word[at] == word[after]) & (after > at)
    return np.where(good, v.ranks[found], NONE), v.merged[found]


def encode_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words end to end, and where each word's begin."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths)
    symbols = v.alphabet[data]
    symbols[ends - 1] = v.final[data[ends - 1]]
    word = np.repeat(np.arange(len(words)), lengths)
    rank, merged = pair_ranks(symbols, word, np.arange(len(symbols)), v)
    done_symbols, done_words = [], []
    while len(symbols):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(first, len(word)))
        lowest = np.repeat(np.minimum.reduceat(rank, first), size)
        over = lowest == NONE
        if over.any():
            done_symbols.append(symbols[over])
            done_words.append(word[over])
        place = np.flatnonzero((rank == lowest) & ~over)
        # Chosen pairs that overlap share a symbol: of such a run every other one counts.
        head = np.append(True, np.diff(place) != 1)[: len(place)]
        begin = np.maximum.accumulate(np.where(head, place, 0))
        place = place[(place - begin) % 2 == 0]
        symbols[place] = merged[place]
        keep = ~over
        keep[place + 1] = False
        now = np.cumsum(keep)[place] - 1
        symbols, word, rank, merged = symbols[keep], word[keep], rank[keep], merged[keep]
        stale = np.concatenate([now, np.maximum(now - 1, 0)])
        rank[stale], merged[stale] = pair_ranks(symbols, word, stale, v)
    ids, of = np.concatenate(done_symbols or [symbols]), np.concatenate(done_words or [word])
    order = np.argsort(of, kind="stable")
    return ids[order], np.searchsorted(of[order], np.arange(len(words) + 1))


def ranges(kind: str, newer: list[tuple[int, int]]) -> str:
    """The inside of a character class with all letters (L) or digits (N)."""
    codes = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
    codes = sorted({*codes, *(c for a, b in newer for c in range(a, b + 1))})
    edges = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
    parts = zip([0, *edges], [*edges, len(codes)])
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[b - 1]:08x}" for a, b in parts)


def word_pattern(cut: str) -> str:
    """The vocabulary's pattern in terms of Python's own expressions."""
    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    for name, inside in ((r"\p{L}", ranges("L", NEWER_LETTERS)), (r"\p{N}", ranges("N", NEWER_DIGITS)), (r"\s", space)):
        cut = cut.replace(name, inside)
    return cut


class Codec:
    """Encodes texts by their units, the pieces between white space.

    Units met before are looked up; the words of all new units of a block are encoded
    together. White space only parts words, so no word spans two units.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.find = re.compile(v.words).findall
        self.units = re.compile(word_pattern(r"[^\s]+")).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) + ")").split
        self.mark = next(iter(v.special), "")[:2]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {" " + s: i for i, s in enumerate(self.v.special)}
        self.ids = np.array(list(self.v.special.values()), np.int32)
        self.starts = np.arange(len(self.v.special) + 1)

    def parted(self, text: str) -> list[str]:
        text = normal(text)
        # Python's split also parts at these four, which are no white space to the vocabulary.
        return text.split() if not any(c in text for c in "\x1c\x1d\x1e\x1f") else self.units(text)

    def pieces(self, text: str) -> list[str]:
        """Units, and special strings behind a space; these are sought before the text is normalised."""
        if not self.v.special or self.mark not in text:
            return self.parted(text)
        out = []
        for i, part in enumerate(self.cut(text)):
            out += [" " + part] if i % 2 else self.parted(part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts end to end, and their offsets."""
        cut = [self.pieces(t) for t in texts]
        if len(self.number) > KNOWN_UNITS:
            self.forget()
        new = sorted(set(chain.from_iterable(cut)) - self.number.keys())
        if new:
            words = [self.find(u) for u in new]
            ids, starts = encode_words([w.encode() for w in chain.from_iterable(words)], self.v)
            ends = starts[np.cumsum([len(w) for w in words])]
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
            self.ids = np.concatenate([self.ids, ids])
        total = sum(map(len, cut))
        flat = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, total)
        per_unit = (self.starts[1:] - self.starts[:-1])[flat]
        ends = np.cumsum(per_unit)
        where = np.arange(ends[-1] if total else 0) + np.repeat(self.starts[flat] - (ends - per_unit), per_unit)
        last = np.cumsum([0, *map(len, cut)])
        return self.ids[where], np.concatenate([[0], ends])[last]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Without a decoder of its own, the vocabulary's tokens joined by spaces."""
        tokens = np.array(self.v.tokens, object)[ids].tolist()
        return [" ".join(tokens[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def normal(text: str) -> str:
    """NFC and lower case letter by letter (no rule for the last letter of a word).

    White space only parts words, so it is left as it is.
    """
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
    return text.translate(NEWER_LOWER) if max(text) > "\u1c88" else text


def with_tokens(docs: DataFrame, vocabulary: str, text: str = "text", decode: bool = True) -> DataFrame:
    """Add `token_ids` (array of int) and, with `decode`, `decoded` (string) to every row.

    `vocabulary` is the path of the file, present on all executors. A null text has no
    tokens and decodes to "". Rows are neither dropped nor merged; columns named like the
    added ones are replaced.
    """
    kind = "struct<ids: array<int>, decoded: string>" if decode else "struct<ids: array<int>>"

    @F.arrow_udf(kind)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec(load(vocabulary))
        for batch in batches:
            for block in blocks(batch):
                ids, at = codec.encode([t or "" for t in block.to_pylist()])
                columns = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
                if decode:
                    columns.append(pa.array(codec.decode(ids, at), pa.string()))
                yield pa.StructArray.from_arrays(columns, ["ids", "decoded"][: len(columns)])

    made = own_names(docs, [IDS, DECODED]).withColumn(IDS, encoded(F.col(text)))
    made = made.withColumn(DECODED, F.col(f"{IDS}.decoded")) if decode else made
    return made.withColumn(IDS, F.col(f"{IDS}.ids"))
