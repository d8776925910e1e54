"""What the coders of operators 3 and 10 may cost, in counts rather than time."""

import random

import numpy as np

import pytest

from evseq.llm import range_coder, sentencepiece_codec, token_files
from evseq.llm.common import tokenizer_path
from tests.llm.conftest import prose


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **kwargs):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **kwargs)


def tokens(encoder, texts):
    got = [np.frombuffer(g, "<u2").tolist() for g in encoder.encode(texts)]
    return got == [[*encoder.tokenizer.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def counting_encoder():
    encoder = token_files.Encoder(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read())
    encoder.tokenizer = Counting(encoder.tokenizer)
    return encoder


def test_new_chunks_go_to_the_tokenizer_together():
    encoder = counting_encoder()
    assert tokens(encoder, [prose(1, 3000), "a b\nc  d <|endoftext|> e<|endoftext|>\n\n f \n  g", " ", "", "\n"])
    assert encoder.tokenizer.texts < 20  # of some 600 different chunks


def test_chunks_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_CHUNKS", 200)
    encoder, rng = counting_encoder(), random.Random(2)
    common = prose(3, 20)
    assert tokens(encoder, [common])
    for k in range(40):
        assert tokens(encoder, [f"{common} {prose(k, 30)} x\ty", f"{rng.random()} {common}"])
        assert len(encoder.cache) + len(encoder.older) < 600
    assert all(f" {w}" in encoder.cache for w in common.split()[1:])


def test_state_of_a_block_is_small():
    model = range_coder._Model(64)
    held = [a for a in vars(model).values() if isinstance(a, np.ndarray)]
    assert sum(a.nbytes for a in held) < 30_000 * 64


class Splits:
    """The pattern of words, counting the characters it splits."""

    def __init__(self, pattern):
        self.pattern, self.chars = pattern, 0

    def findall(self, text):
        self.chars += len(text)
        return self.pattern.findall(text)


@pytest.fixture
def codec():
    return sentencepiece_codec.Codec(sentencepiece_codec.read_model(tokenizer_path("piece_bpe_32k.model")))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_texts_are_split_once(codec, library):
    texts = [prose(4, 400), "", None, "a ▁b  c\n\nd", prose(5, 400)]
    codec.vocabulary.words = Splits(codec.vocabulary.words)
    got = sentencepiece_codec.encode_batch(codec, texts)
    assert [list(g) for g in got] == [library.encode(t or "") for t in texts]
    assert codec.vocabulary.words.chars <= sum(len(t or "") + 1 for t in texts)


def test_common_words_are_encoded_once(codec, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "CACHE_WORDS", 100)
    common, met = prose(6, 20), []
    encode = codec._encode_words
    monkeypatch.setattr(codec, "_encode_words", lambda words: encode(w for w in list(words) if not met.append(w)))
    for k in range(40):
        texts = [f"{common} {prose(50 + k, 15)}", f"{common} once{k}"]
        assert [list(g) for g in sentencepiece_codec.encode_batch(codec, texts)] == library.encode(texts)
        assert len(codec.cache) + len(getattr(codec, "older", {})) < 300
    first = common.split()[1]
    assert sum(w.strip(" ▁") == first for w in met) == 1


def test_pairs_and_steps_are_bounded(codec, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MOST_KNOWN", 30)
    texts = [prose(7, 200), "mañana 中😀 Straße", "a" * 500]
    assert [list(g) for g in sentencepiece_codec.encode_batch(codec, texts)] == library.encode(texts)
    assert len(codec.vocabulary.steps) + sum(map(len, codec.vocabulary.pairs.values())) <= 30
