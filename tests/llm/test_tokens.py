import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.shared import SF, awkward, documents
from tillstream.llm import bpe_codec, piece_counts, registry

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(bpe_codec.load(WORDS))


def random_texts(n, letters, most, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, most))) for _ in range(n)]


ODD = [
    "", " ", "a<|endoftext|>B <|startoftext|><|endoftext|", "<|ENDOFTEXT|> <|endoftext|>", "ΑΣ ΣΑΣ", "İstanbul", "'S 'RE don't I'LL",
    "aaaaaaaaaaaa aaaaa", "é<|endoftext|>́x", "\0a\x1cb\x85c", "ﬁ Ǆ", "x" * 3000, "A b　c﻿d", "ᲉꟋ",
]


def test_codec_equals_the_library(codec, library):
    texts = ODD + random_texts(3000, "abcdeé'’ AIıß12\n,.!中😀", 40)
    ids, at = codec.encode(texts)
    decoded = codec.decode(ids, at)
    for i, (text, other) in enumerate(zip(texts, library.encode_batch(texts, add_special_tokens=False))):
        assert ids[at[i] : at[i + 1]].tolist() == other.ids, repr(text)
        assert decoded[i] == library.decode(other.ids, skip_special_tokens=False)


def test_codec_splits_every_letter_like_the_library(codec, library):
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    ids, at = codec.encode(texts)
    for i, other in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == other.ids, ascii(texts[i])


def test_codec_forgets_words_without_changing_results(codec, monkeypatch):
    monkeypatch.setattr(bpe_codec, "KNOWN_UNITS", 3)
    small = bpe_codec.Codec(codec.v)
    for text in ("one two three four five", "two six <|endoftext|>", "one"):
        assert small.encode([text])[0].tolist() == codec.encode([text])[0].tolist()


def test_frame_with_awkward_rows(spark, library):
    docs = documents(spark, awkward()).selectExpr("*", "'x' as DECODED", "1 as n_tokens")
    got = bpe_codec.with_tokens(docs, WORDS).collect()
    assert len(got) == len(awkward())
    assert got[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "token_ids", "decoded"]
    for row in got:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.token_ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)


def test_codec_query(spark, library):
    got = {r.doc_id: r for r in registry.op5_bpe_codec(spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        r = got[row.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("letters", ["ab c", "abcdefghijklmnop", "a  \n\tb", "日本語テキスト 😀a", " ", "a", "éz ", "▁a ", "<s>x</s> "])
def test_chunked_counts_equal_whole_ones(letters):
    sp = piece_counts.encoder(PIECES)
    for text in random_texts(25, letters, 900):
        for chunk, overlap in ((64, 8), (100, 16), (33, 4), (8, 2)):
            assert piece_counts.count_tokens(sp, text, chunk, overlap) == len(sp.encode(text)), (text, chunk)


def test_counts_of_awkward_rows(spark, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, awkward()).selectExpr("*", "'x' as N_Tokens")
    for row in piece_counts.with_counts(docs, PIECES).collect():
        assert row.n_tokens == len(sp.encode(row.text or ""))


def test_count_query(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in registry.op8_token_counts(spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = len(sp.encode(row.text))
        assert tuple(got[row.doc_id]) == (row.doc_id, len(row.text.encode()), n, n > 4096)


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert bpe_codec.with_tokens(empty, WORDS).count() == 0
    assert piece_counts.with_counts(empty, PIECES).count() == 0
