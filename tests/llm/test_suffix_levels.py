"""Longer keys and folds of repeated strings, against plain Python."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evseq.llm import suffix_dedup
from tests.llm import brute
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def common():
    """A common line of 70 bytes and one of 140 in many surroundings, copies of
    other texts and a passage of which ever longer parts are repeated."""
    rng = random.Random(4)
    short, long, passage = prose(60, 12)[:70], prose(61, 30)[:140], prose(62, 60)
    rows = []
    for i in range(80):
        words = [prose(500 + 7 * i, 15), short, prose(900 + 7 * (i % 9), 15), long, prose(1300 + 7 * i, 10)]
        rows.append((i, " ".join(words[i % 3 :] if i % 5 else words)))
    rows += [(100 + i, prose(1700 + i, 6) + " " + passage[: 105 + 3 * i]) for i in range(40)]
    rows += [(200 + i, rows[rng.randrange(60)][1]) for i in range(10)]
    return rows


@pytest.mark.parametrize("hot", [0, 1, 4, suffix_dedup.HOT])
def test_keys_of_every_length(spark, common, hot):
    df = spark.createDataFrame(common, "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_repeats(df, hot=hot).collect()
    want = {d: (n, s, k) for d, n, s, k in brute.repeats(common)}
    for r in got:
        assert (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id]
    assert len(got) == len(common)


def test_every_window_stays_under_one_key(spark):
    """Splitting halves the range; equal windows have equal keys at each level."""
    rng = random.Random(1)
    line = bytes(rng.randrange(97, 123) for _ in range(60))
    rows = []
    for i in range(6):
        raw = bytes(rng.randrange(97, 100) for _ in range(60)) + line + bytes(rng.randrange(97, 100) for _ in range(60))
        left = rng.randrange(60, 80)  # the anchor is the gram at byte 80
        rows.append((i, 0, 7, 1000, raw[80 - left : 80 + 20 + rng.randrange(70, 80)], left))
    df = spark.createDataFrame(rows, "id long, tie long, key long, start long, bytes binary, left int")
    level = df.withColumns({"lo": F.lit(0), "hi": F.lit(80)})

    def windows(entries):
        out = collections.defaultdict(list)
        for r in entries:
            for at in range(len(r.bytes) - 99):
                out[r.id, r.start + at, bytes(r.bytes[at : at + 100])].append(r.key)
        return out

    before = windows(level.collect())
    for _ in range(7):
        rows_before = level.count()
        level = suffix_dedup.split_keys(level, 100, 20)
        found = level.collect()
        now = windows(found)
        assert set(now) == set(before) and all(len(keys) == 1 for keys in now.values())
        assert len(found) <= 2 * rows_before and len(found) <= len(now)
        keys = collections.defaultdict(set)
        for (_, _, window), key in now.items():
            keys[window] |= set(key)
        assert all(len(k) == 1 for k in keys.values())
    assert all(len(r.bytes) == 100 and r.lo == r.hi for r in level.collect())


def test_spans_are_linear_in_the_suffixes():
    """Nested common prefixes: one span for each suffix, not one for each interval."""
    rng = random.Random(3)
    stem = bytes(rng.randrange(97, 123) for _ in range(180))
    rows = [(i, 1, 0, stem[: 100 + i % 80] + bytes([65 + i % 26, 65 + i // 26 % 26, 65 + i // 676])) for i in range(400)]
    data = b"\xff".join(r[3] for r in rows) + b"\xff"
    starts = np.cumsum([0, *[len(r[3]) + 1 for r in rows[:-1]]])
    sa = suffix_dedup.SuffixArray(data, starts, np.array([len(r[3]) for r in rows]), 100)
    order = {int(p): i for i, p in enumerate(starts)}
    place = [order[int(p)] for p in sa.positions]
    found = [i for _, _, _, late in suffix_dedup.repeat_groups(sa, [-1] * len(place), place, 100) for i in late]
    assert len(found) == len(set(found)) == len(place) - 1
    # each document is covered as far as the longest prefix of an earlier one
    spans = suffix_dedup.covered_in_shard(rows, 100)
    for i, (_, _, _, raw) in enumerate(rows):
        shared = max((next((n for n, (a, b) in enumerate(zip(raw, r[3])) if a != b), min(len(raw), len(r[3]))) for r in rows[:i]), default=0)
        assert max((e for s, e in spans.get(i, ()) if s == 0), default=0) == (shared if shared >= 100 else 0)


def test_repeats_within_a_batch_are_found_by_place():
    h, content = np.array([5, 5, 5, 6, 5, 5]), np.array([1, 1, 2, 1, 1, 1])
    rank, start = np.array([3, 1, 0, 0, 1, 1]), np.array([0, 9, 0, 0, 4, 4])
    # two rows of one place are one place
    assert suffix_dedup.repeated_here(h, content, rank, start).tolist() == [True, True, False, False, False, False]
