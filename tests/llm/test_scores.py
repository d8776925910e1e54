"""Scores of the classifiers against plain Python, statistic by statistic."""

import collections
import math

import numpy as np
import pytest

from evseq.llm import boosting, quality
from tests.llm.conftest import prose


def plain_features(text):
    """Every statistic by its own definition, over the whole text at once."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * quality.N_FEATURES
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    n, m = max(len(words), 1), max(len(lines), 1)

    def share(test, items, total):
        return sum(1 for x in items if test(x)) / total

    def of_bytes(low, high):
        return sum(low <= b <= high for b in raw) / len(raw)

    tops = [max(collections.Counter(x).values(), default=0) for x in (words, lines)]
    return [
        math.log1p(len(raw)), math.log1p(len(words)), math.log1p(len(lines)), sum(map(len, words)) / n,
        len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n, tops[0] / n,
        len(set(zip(words, words[1:]))) / n, share(lambda x: len(x) > 14, words, n),
        share(lambda x: len(x) > 3 and len(set(x[-3:])) == 1, words, n), share(lambda x: x[:1].isupper(), words, n),
        share(lambda x: len(x) > 1 and x.isupper(), words, n), len(set(lines)) / m, tops[1] / m,
        share(lambda x: len(x) < 30, lines, m), of_bytes(65, 90), of_bytes(97, 122), of_bytes(48, 57), of_bytes(32, 32),
        of_bytes(10, 10), of_bytes(128, 255), *[raw.count(bytes([c])) / len(raw) for c in quality.MARKS],
    ]


TEXTS = [
    None,
    "",
    " \n\t\n ",
    "One TWO two two  heeey!!!\n\nOne TWO\nOne TWO\n" + "x" * 40,
    "é" * 30 + " 中文 word-" + "a" * 20 + " ...",
    "\n".join(prose(i % 9, 12) for i in range(60)),
    "nospace" * 200,
    " " * 500 + "end",
]


@pytest.mark.parametrize("piece", [quality.PIECE, 100, 7, 1])
@pytest.mark.parametrize("text", TEXTS)
def test_features_at_every_piece_size(monkeypatch, text, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    np.testing.assert_allclose(quality.features(text), plain_features(text), rtol=1e-12)


def test_features_of_a_text_of_several_megabytes():
    text = (prose(1, 3000) + "\n") * 180 + prose(2, 60_000)
    assert len(text) > 3 * quality.PIECE
    np.testing.assert_allclose(quality.features(text), plain_features(text), rtol=1e-12)


def test_scores_by_hand(spark, docs, rows, labels, monkeypatch):
    """The registered score: plain features of each text, walked down each tree."""
    seen = []
    fit = boosting.fit
    monkeypatch.setattr(quality.boosting, "fit", lambda x, y, **kw: seen.append(fit(x, y, **kw)) or seen[-1])
    got = quality.scores(docs, labels).collect()
    (forest,) = seen
    want = collections.Counter()
    for doc, text in rows:
        x, total = plain_features(text), forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + (x[feature[node]] > threshold[node])
            total += leaf[node - (2**forest.depth - 1)]
        want[doc, round(1 / (1 + math.exp(-total)), 6)] += 1
    assert collections.Counter((r.doc_id, round(r.score, 6)) for r in got) == want
