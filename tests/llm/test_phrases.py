"""Operator 3: packs code phrases of token ids, and spell out the rest."""

import random

import numpy as np
import pyarrow as pa
import pytest

from evseq.llm import range_coder, token_files
from evseq.llm.common import tokenizer_path
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read())


def packed(encoder, *groups):
    pack = token_files.Pack(encoder)
    for texts in groups:
        pack.add(pa.array(texts, pa.string()))
    return pack


def expected(encoder, texts):
    return [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, token_files.END_ID] for t in texts]


ODD = [
    None, "", " ", "\n", "\n\n\n", "a", "a ", " a", "a  b", "a   b", "a\n b", "a \nb", "a\n \nb", "a\n\n\n b", "\n\nx\n\n", "a\tb c", "x\x1ey z", "x y", "y\r\nz", "\x00a b",
    "it's John's, 'tis dogs' (fine), x_y. e.g. a.b,c;d--e... Straße! été? 10.5% ª. ², 中, ñ. <|endoftext|>, a<|endoftext|>.b x<|endof text|>",
    "a.'s b,'t c'll 'SS.'s À.'d", "mail a.b@c.example.com, +1 (212) 555-0100", "\U0001f600, \U0001f600.", "é, é.x",
]


def test_odd_texts_come_back(encoder):
    texts = ODD + [t for t in ODD if t] * 3
    got = token_files.read_payload(packed(encoder, texts[:9], texts[9:]).payload())
    assert [g.tolist() for g in got] == expected(encoder, texts)


def test_random_texts_come_back(encoder):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aBé '.,-s1中\n  \t") for _ in range(rng.randrange(40))) for _ in range(4000)]
    got = token_files.read_payload(packed(encoder, texts).payload())
    assert [g.tolist() for g in got] == expected(encoder, texts)


@pytest.mark.parametrize("space", ["\t", "\x0b", "\x0c", "\r", "\r\n", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2000", "\u2007", "\u200a", "\u200b", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\ufeff"])
def test_any_white_space(encoder, space):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab", "C.", "(", " d", "1", " ", "\n", space, space, f"\n{space}e"]) for _ in range(rng.randrange(14))) for _ in range(1500)]
    assert [np.frombuffer(e, "<u2").tolist() for e in encoder.encode(texts)] == expected(encoder, texts)


def test_white_space_does_not_send_texts_whole(encoder, monkeypatch):
    whole = []
    ids = encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda c, w: ids(c, w) if not whole.extend(w) else None)
    texts = ["one\r\ntwo,\tthree\xa0: four\u2009%\r\n\r\nfive.", "six \t seven\n  eight", "nine\x1eten"]
    got = token_files.read_payload(packed(encoder, texts).payload())
    assert [g.tolist() for g in got] == expected(encoder, texts) and whole == texts[2:]


def test_phrases_are_coded_as_one(encoder, monkeypatch):
    coded = []
    encode = range_coder.encode
    monkeypatch.setattr(range_coder, "encode", lambda ids: encode(ids) if not coded.append(len(ids)) else None)
    rng = random.Random(2)
    words = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(400)) + f" {rng.random()}." for _ in range(50)]
    pack = packed(encoder, texts)
    payload = pack.payload()
    assert [g.tolist() for g in token_files.read_payload(payload)] == expected(encoder, texts)
    assert sum(coded) < 0.5 * pack.n_ids
    whole = np.concatenate([np.array(e, dtype=np.uint16) for e in expected(encoder, texts)])
    assert len(payload) < sum(len(b) for b, _, _ in encode(whole))


class Given:
    """Documents of given phrases."""

    def __init__(self, phrases, at):
        self.phrases, self.at = phrases, at

    def cut(self, texts):
        return [self.at], [str(k) for k in range(len(self.phrases))], []

    def ids(self, chunks, whole):
        return [self.phrases[int(c)] for c in chunks]


@pytest.mark.parametrize("size", [2, 3, 7])
def test_more_phrases_than_symbols(size):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, 65536, (40_000, size)).astype("<u2")
    at = np.concatenate([np.arange(40_000), rng.permutation(40_000), rng.permutation(40_000)])
    pack = packed(Given([r.tobytes() for r in ids], at), ["x"])
    (got,) = token_files.read_payload(pack.payload())
    assert np.array_equal(got, [*ids[at].ravel(), token_files.END_ID])


def test_all_ids_used_leave_no_room():
    ids = np.arange(65536).astype("<u2")
    phrases = [ids.tobytes(), ids[7:9].tobytes(), ids[5:8].tobytes()]
    pack = packed(Given(phrases, np.array([0, 1, 1, 1, 2, 2, 2, 0])), ["x"])
    (got,) = token_files.read_payload(pack.payload())
    assert np.array_equal(got, np.concatenate([ids, np.tile(ids[7:9], 3), np.tile(ids[5:8], 3), ids, [token_files.END_ID]]))


def test_damage_is_found(encoder):
    payload = packed(encoder, [prose(5, 900)]).payload()
    rng = random.Random(6)
    for _ in range(8):
        at = rng.randrange(len(payload) // 2, len(payload) - 8)
        with pytest.raises(ValueError):
            token_files.read_payload(payload[:at] + bytes([payload[at] ^ 4]) + payload[at + 1 :])


def test_packs_end_at_many_phrases(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_PHRASES", 50)
    assert packed(encoder, [prose(7, 2000)]).full() and not packed(encoder, ["a b"]).full()


def test_packs_end_at_long_phrases(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_SPELLED", 300)
    assert packed(encoder, ["a\x1e" * 200]).full() and not packed(encoder, ["a b " * 200]).full()


def test_groups_hold_every_document():
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["a" * 9_000_000, None, "", "b", "c" * 5_000_000, "d" * 5_000_000, None])], ["id", "text"])
    groups = list(token_files._groups(batch.slice(0)))
    assert [i for g in groups for i in g.column(0).to_pylist()] == list(range(7)) and len(groups) == 3
    assert [i for g in token_files._groups(batch.slice(1, 4)) for i in g.column(0).to_pylist()] == [1, 2, 3, 4]
