"""Words of many thousand characters: the library's ids, in time by the word's length."""

import random
import string
import time

import pytest
import sentencepiece

from tillmetrics.llm import suffix_pieces
from tillmetrics.llm.queries import tokenizer_file

KINDS = {
    "base64": string.ascii_letters + string.digits + "+/",
    "one letter": "a",
    "two letters": "ab",
    "pieces and none": ["the", "ing", "中", "x", "\U0001f600", "\x00", "qu", "tion", "=", "--"],
}


@pytest.fixture(scope="module")
def model():
    return tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary(model):
    return suffix_pieces.load(model)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("n", [suffix_pieces.LONG_WORD - 2, suffix_pieces.LONG_WORD, 30_000])
def test_the_librarys_ids(model, vocabulary, kind, n):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    word = "".join(random.Random(n).choices(KINDS[kind], k=n))
    texts = [word, f"say {word} it\n{word}", word[1:]]
    found = [x.tolist() for x in suffix_pieces.Encoder(vocabulary).encode(texts)]
    assert found == library.encode(texts)


def test_windows_do_not_show(model, vocabulary, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    word = "".join(random.Random(4).choices(["tion", "ing", "the", "r", "é", "日"], k=3000))
    for size in (1, 17, 1000):
        monkeypatch.setattr(suffix_pieces, "WORD_CHARS_AT_ONCE", size)
        some = word if size > 1 else word[: suffix_pieces.LONG_WORD + 9]
        assert suffix_pieces.Encoder(vocabulary).encode([some])[0].tolist() == library.encode(some)


def test_known_borders_and_words_may_be_forgotten(model, vocabulary, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    monkeypatch.setattr(suffix_pieces, "BORDERS_KEPT", 10)
    monkeypatch.setattr(suffix_pieces, "IDS_KEPT", 100)
    monkeypatch.setattr(suffix_pieces, "TEXTS_AT_ONCE", 1)
    rng = random.Random(5)
    texts = ["".join(rng.choices(string.ascii_lowercase + " ", k=n)) for n in (5, 400, 30)]
    texts += ["".join(rng.choices(string.ascii_lowercase, k=2000)), *texts]
    assert [x.tolist() for x in suffix_pieces.Encoder(vocabulary).encode(texts)] == library.encode(texts)


def test_a_word_of_a_megabyte(vocabulary):
    word = "".join(random.Random(6).choices(KINDS["base64"], k=1_000_000))
    begin = time.monotonic()
    ids = suffix_pieces.Encoder(vocabulary).encode([word])[0]
    assert time.monotonic() - begin < 15
    assert suffix_pieces.decode(vocabulary, ids.tolist()) == word
