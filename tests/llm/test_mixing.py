"""The mixed probabilities of operator 3's coder."""

import math
import random

import numpy as np
import pytest

from evseq.llm import range_coder as rc
from tests.llm.conftest import prose


def words(seed, n):
    numbers: dict = {}
    return np.array([numbers.setdefault(w, 400 + 7 * len(numbers)) for w in prose(seed, n).split()], dtype=np.uint16)


def cost(ids):
    """Bits of one block by the mixture of three orders, number by number."""
    numbers, counts, bits = {}, [], 0.0
    first, second = {}, {}
    weights = {}
    start = rc._start_weights().T.tolist()
    one = two = 0
    for t, value in enumerate(ids.tolist()):
        at1, at2 = one % rc.SLOTS1, ((one * 30011 + two * 52391) >> 4) % rc.SLOTS2
        (p1, c1), (p2, c2) = first.get(at1, (None, 0)), second.get(at2, (None, 0))
        context = c2 * 8 + c1 * 2 + (p1 == p2)
        w = weights.setdefault(context, list(start[context]))
        new = value not in numbers
        x = numbers.setdefault(value, len(numbers))
        if new:
            counts.append(0)
        scale = max(t, 1)
        share = [w[0] * scale * (p2 == x), w[1] * scale * (p1 == x), w[2] * counts[x], w[3] * scale * new]
        total = w[0] * scale * (p2 is not None) + w[1] * scale * (p1 is not None) + w[2] * t + w[3] * scale
        bits -= math.log2(sum(share) / total)
        if new:
            bits -= math.log2(((1 << 22) // (value + 512) + 1) / int(rc._NEW[-1]))
        own = sum(share)
        weights[context] = [v + ((s * rc.WEIGHT // own - v + rc.HALF) >> rc.RATE) for v, s in zip(w, share)]
        for table, at, (p, c) in ((first, at1, (p1, c1)), (second, at2, (p2, c2))):
            table[at] = (p, min(c + 1, 3)) if p == x else (p, c - 1) if c else (x, 1)
        counts[x] += 1
        one, two = x, one
    return bits


def order0(ids):
    """Bits by order 0 alone, its shares known, and its table of plain ids."""
    _, n = np.unique(ids, return_counts=True)
    return -(n * np.log2(n / n.sum())).sum() + 16 * len(n)


@pytest.mark.parametrize("ids", [words(1, 4000), np.tile(words(2, 37), 60), np.zeros(900, np.uint16), np.random.default_rng(5).integers(0, 65536, 2000).astype(np.uint16)])
def test_size_is_the_mixtures_cost(ids):
    (data, _, n), *more = rc.encode(ids)
    assert not more and n == len(ids)
    # ranges cut short of a carry cost about half a percent
    assert cost(ids) - 1 <= 8 * len(data) <= cost(ids) * 1.01 + 64


def test_repeats_with_noise_take_less_than_order_0():
    text = np.concatenate([np.tile(words(3, 50), 40), words(4, 2000)])
    rng = random.Random(6)
    noisy = np.array([v if rng.random() < 0.9 else rng.choice(text.tolist()) for v in text.tolist()], dtype=np.uint16)
    (data, _, _), *_ = rc.encode(noisy)
    assert 8 * len(data) < 0.8 * order0(noisy)


def test_intervals_cover_the_total_and_are_found():
    ids = words(7, 600)
    numbers, new = rc._numbers(np.tile(np.resize(ids, rc.BLOCK), (2, 1)))
    model = rc._Model(2)
    for t in range(600):
        x = numbers[:, t].astype(np.int64)
        model.predict(2, t)
        if t % 37 == 0:
            met, at = int(numbers[0, :t].max()) + 1 if t else 0, np.zeros(2, np.int64)
            for k in range(met + 1):
                own, kept = np.full(2, k, np.int64), model.weights.copy()
                if k < met or model.mass_new[0]:
                    start, size = model.interval(2, own, np.full(2, k == met))
                    model.weights[:] = kept
                    assert (start == at).all() and (size > 0).all()
                    for value in (start, start + size - 1):
                        found, is_new = model.find(2, value)
                        assert (is_new == (k == met)).all() and (is_new | (found == k)).all()
                    at = start + size
            assert (at == model.total).all()
        model.interval(2, x, new[:, t])
        model.learn(2, x)


def test_blocks_are_reset_and_checked():
    ids = np.tile(words(8, rc.BLOCK), 3)
    blocks = rc.encode(ids)
    assert len({b for b, _, _ in blocks}) == 1  # equal blocks give equal bytes: nothing is carried over
    assert np.array_equal(np.concatenate(rc.decode([blocks[2], (rc.encode(ids[:77])[0])])), np.concatenate([ids[: rc.BLOCK], ids[:77]]))
    rng = random.Random(9)
    with pytest.raises(ValueError):
        rc.decode([(*blocks[0][:2], rc.BLOCK + 1)])
    data, crc, n = rc.encode(ids[:500])[0]
    for _ in range(12):
        at = rng.randrange(len(data) - 8)
        for bad in (data[:at] + bytes([data[at] ^ (1 << rng.randrange(8))]) + data[at + 1 :], data[:at], bytes(rng.randrange(256) for _ in range(len(data)))):
            with pytest.raises(ValueError):
                rc.decode([(bad[: len(bad) // 2 * 2], crc, n)])
