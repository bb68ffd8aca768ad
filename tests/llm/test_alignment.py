"""Token alignment against both libraries and counting by hand."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import rows
from tests.llm.shared import SF, awkward, documents
from tillstream.llm import registry, token_alignment
from tillstream.llm.stage import table

A, B = public_tokenizers.path(registry.BYTE_VOCABULARY), public_tokenizers.path(registry.PIECE_MODEL)


class Libraries:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        letters = token_alignment.byte_letters()
        self.byte = {c: i for i, c in enumerate(letters)}

    def tokens(self, text):
        """(ids, bytes) of both vocabularies; none where they don't spell the text."""
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


@pytest.fixture(scope="module")
def libraries():
    return Libraries()


def groups_by_hand(a, b):
    ends_a, ends_b = np.cumsum([len(t) for _, t in a]), np.cumsum([len(t) for _, t in b])
    common, out = set(ends_a) & set(ends_b), []
    for ids, ends in (([i for i, _ in a], ends_a), ([i for i, _ in b], ends_b)):
        parts, part = [], []
        for i, end in zip(ids, ends):
            part.append(i)
            if end in common:
                parts.append(part)
                part = []
        out.append(parts)
    return list(zip(*out))


def by_hand(libraries, texts):
    cut = [groups_by_hand(*libraries.tokens(t)) for t in texts]
    held, linked = Counter(), []
    for groups in cut:
        mine = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        linked.append(mine)
        held.update(mine.keys())
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for groups, mine in zip(cut, linked):
        told = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in groups)
        out.append(
            (
                sum(len(xs) for xs, _ in groups),
                sum(len(ys) for _, ys in groups),
                len(groups),
                sum(mine.values()),
                sum(n for p, n in mine.items() if held[p] == top[p[0]]),
                sum(n * held[p] for p, n in mine.items()),
                told,
            )
        )
    return out


ODD = [
    "a▁b", "▁", " ", "   ", "\n", "\n\n a", "a \n b", "a\n  b", "a  b   c ", "\t\ttab\tx", "<|endoftext|> <s></s> <0x41>", "it's I'LL we've",
    "\xa0x\u2009\u3000 y\xa0z", "x\x1cy \x85z\x0b w", "nul\x00 in", "日本語のテキスト 漢字\n仮名", "e\u0301 é \ufb01", "😀😀 👩\u200d👩\u200d👧",
    "12345 67,890.12", "()[]{};;;---", "end ", " lead", "x" * 300, "ab" * 200 + " " + "-" * 100, "\r\n\r\nx\r y", "ß\u200bß", "a\u2028 b\u1680\n c",
]


def test_encoding_equals_the_libraries(libraries):
    random.seed(3)
    letters = ["a", "the", " ", "  ", "\n", "\t", "é", "漢", "'s", "1", "!", "▁", " ", "\x1c", "<s>", "😀"]
    texts = ODD + ["".join(random.choice(letters) for _ in range(random.randint(1, 30))) for _ in range(400)]
    v = token_alignment.load(A, B)
    a, b = token_alignment.Encoder(v).encode(texts)
    for i, text in enumerate(texts):
        want_a, want_b = libraries.tokens(text)
        assert a.ids[a.first[i] : a.first[i + 1]].tolist() == [x for x, _ in want_a], repr(text)
        assert b.ids[b.first[i] : b.first[i + 1]].tolist() == [x for x, _ in want_b], repr(text)


def test_forgotten_units_are_encoded_again(monkeypatch, libraries):
    monkeypatch.setattr(token_alignment, "KNOWN_UNITS", 3)
    encoder = token_alignment.Encoder(token_alignment.load(A, B))
    for text in ("one two three four five", "one two", "six one", "two five"):
        a, _ = encoder.encode([text])
        assert a.ids.tolist() == [x for x, _ in libraries.tokens(text)[0]]


def test_only_texts_with_odd_units_are_joined_again(monkeypatch, libraries):
    plain, seen = token_alignment.Encoder.spelled, []
    monkeypatch.setattr(token_alignment.Encoder, "spelled", lambda self, text, *rest: seen.append(text) or plain(self, text, *rest))
    encoder = token_alignment.Encoder(token_alignment.load(A, B))
    a, b = encoder.encode(["one two", "a▁b two", "", "three", "x ▁"])
    c, d = encoder.encode(["x two", "two a▁b"])
    assert seen == [" a▁b two", " x ▁", " two a▁b"]
    assert (np.diff(a.first) > 0).tolist() == (np.diff(b.first) > 0).tolist() == [True, False, False, True, False]
    assert (np.diff(c.first) > 0).tolist() == (np.diff(d.first) > 0).tolist() == [True, False]


def test_gallop_finds_what_binary_search_finds():
    random.seed(1)
    for _ in range(200):
        long = np.unique(np.random.default_rng(random.randint(0, 10**6)).integers(0, 300, random.randint(0, 120)))
        short = np.unique(np.random.default_rng(random.randint(0, 10**6)).integers(0, 320, random.randint(0, 80)))
        start = np.zeros(len(short), np.int64)
        wanted = np.searchsorted(long, short)
        assert token_alignment.gallop(short, long, start).tolist() == wanted.tolist()
        assert token_alignment.gallop_in_order(short, long, start).tolist() == wanted.tolist()


@pytest.mark.parametrize("often", [1, 1 << 18])
def test_links_by_hand(spark, libraries, monkeypatch, often):
    """With few pairs sent to all tasks, and with all of them."""
    monkeypatch.setattr(token_alignment, "OFTEN", often)
    docs = awkward() + [(100 + i, t) for i, t in enumerate(ODD)] + [(2, "again the same"), (2, "again the same")]
    found = rows(token_alignment.with_links(documents(spark, docs), A, B), "doc_id", *token_alignment.COLUMNS)
    told = by_hand(libraries, [t for _, t in docs])
    assert found == sorted(((i, *facts) for (i, _), facts in zip(docs, told)), key=repr)


def test_large_groups_are_linked_in_parts(libraries, monkeypatch):
    monkeypatch.setattr(token_alignment, "LINKS", 5)
    a = token_alignment.Tokens(np.arange(7, dtype=np.int32), np.array([0, 0, 4, 7]))
    b = token_alignment.Tokens(np.array([9, 9, 8, 9, 7], np.int32), np.array([0, 0, 3, 5]))
    g = token_alignment.Groups(np.array([0, 4]), np.array([4, 7]), np.array([0, 3]), np.array([3, 5]), np.array([1, 2]))
    pair, times, first = token_alignment.pairs_of(a, b, g, 3)
    mine = [Counter({(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pair[i:j], times[i:j])}) for i, j in zip(first, first[1:])]
    assert mine[0] == Counter()
    assert mine[1] == Counter((x, y) for x in range(4) for y in (9, 9, 8))
    assert mine[2] == Counter((x, y) for x in range(4, 7) for y in (9, 7))


def test_other_columns_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b"), (None, None)]).withColumnRenamed("source", "N_Links").withColumnRenamed("lang", "row")
    made = token_alignment.with_links(docs, A, B)
    assert made.columns == ["doc_id", "text", "row", "n_chars", *token_alignment.COLUMNS]
    assert rows(made, "row", "n_a", "n_links", "groups") == [("en", 0, 0, ""), ("en", 2, 2, "257|264;275|287")]
    assert token_alignment.with_links(docs.limit(0), A, B).count() == 0


def test_query_by_hand(spark, libraries):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    told = by_hand(libraries, [t for _, t in docs])
    wanted = [(i, *f[:-1], hashlib.sha256(f[-1].encode()).hexdigest() if f[-1] else "") for (i, _), f in zip(docs, told)]
    assert rows(registry.op11_token_alignment(spark, SF)) == sorted(wanted, key=repr)
