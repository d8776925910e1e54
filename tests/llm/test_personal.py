"""Wider spans of personal data: many matches, long ones, planted ones by kind."""

import collections
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from evseq.llm import pii
from tests.llm import brute
from tests.llm.conftest import prose


def test_very_many_matches_in_one_text(spark):
    rng = random.Random(1)
    some = [f"u{i}@h{i % 7}.org" if i % 3 else f"u{i} (at) h{i % 5} (dot) org" for i in range(30_000)]
    text = " ".join(some) + " " + " ".join(f"{rng.randrange(256)}.1.2.3" for _ in range(5_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    (row,) = pii.find_personal_data(df).collect()
    assert time.perf_counter() - start < 120
    want = brute.personal(text)
    assert len(want) > 24_000 and [(s.kind, s.start, s.end) for s in row.base] == want


def test_spans_apart_by_definition(spark):
    rng = random.Random(2)

    def spans(n):
        return [(0, a := rng.randrange(60), a + rng.randrange(1, 9), "k", False, "m", "l", "r") for _ in range(n)]

    rows = [(i, spans(rng.randrange(8)), spans(rng.randrange(8))) for i in range(200)]
    df = spark.createDataFrame(rows, f"id int, wide array<{pii.TAGGED}>, firm array<{pii.TAGGED}>")
    for r in df.select("wide", "firm", pii.apart(F.col("wide"), F.col("firm")).alias("got")).collect():
        want = [w for w in r.wide if not any(b.start < w.end and w.start < b.end for b in r.firm)]
        assert collections.Counter(map(tuple, r.got)) == collections.Counter(map(tuple, want))


@pytest.mark.parametrize("chunk", [1, 3, pii.CHUNK])
def test_scan_keeps_its_state_over_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(pii, "CHUNK", chunk)
    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 3, 10)], "v array<int>")
    got = df.select("v", pii.scan(F.col("v"), F.lit(0), lambda s, x: (s + x, s + x), "int").alias("sums")).collect()
    assert all(r.sums == [sum(r.v[: i + 1]) for i in range(len(r.v))] for r in got)


KNOWN = {
    "email": lambda r: f"j{r.randrange(999)} (at) mail{r.randrange(99)} (dot) org",
    "phone": lambda r: f"({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}",
    "iban": lambda r: f"DE{r.randrange(10, 99)} " + " ".join(f"{r.randrange(1000, 9999)}" for _ in range(4)) + f" {r.randrange(10, 99)}",
    "secret": lambda r: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((32, 40, 200)))),
}
CUE = {"email": "write to", "phone": "call", "iban": "account", "secret": "token:"}


def planted(n=240):
    rng, rows = random.Random(3), []
    for i in range(n):
        kind = list(KNOWN)[i % 4]
        span = KNOWN[kind](rng)
        head = f"{prose(i, 12)} {CUE[kind]} "
        rows.append((i, kind, span, f"{head}{span} {prose(i + 1000, 12)} mail a{i}@b.org", len(head)))
    return rows


def test_planted_spans_are_found_by_kind(spark):
    rows = planted()
    got = pii.find_personal_data(spark.createDataFrame([(i, t) for i, _, _, t, _ in rows], "doc_id long, text string"))
    spans = {r.doc_id: {(s.kind, s.start, s.end) for s in r.spans} for r in got.collect()}
    found = collections.Counter(kind for i, kind, span, _, at in rows if (kind, at, at + len(span)) in spans[i])
    for kind in KNOWN:
        assert found[kind] >= 54, found  # 90 % of 60 each


def test_gazetteer_votes_both_ways(spark):
    rows = [
        ("email", "a@b.org", 1), ("email", "logo@2x.png", -1), ("email", "a@b.example", -1), ("email", "a (at) b (dot) de", 1), ("email", "a@b.zzz", 0),
        ("ip", "81.2.3.4", 1), ("ip", "127.0.0.1", -1), ("ip", "255.1.1.1", -1), ("card", "4539578763621486", 1), ("card", "4111 1111 1111 1111", 0),
        ("card", "9111111111111111", -1), ("phone", "+49 30 123456", 1), ("phone", "+999 123 45678", -1), ("phone", "212 736 5000", 1),
        ("phone", "212-555-0100", 0), ("phone", "012 345 6789", -1), ("iban", "DE89 3704 0044 0532 0130 00", 1), ("iban", "DE89 3704 0044", -1),
        ("iban", "ZZ89 3704 0044 0532 0130 00", -1), ("secret", "0123456789abcdef0123456789abcdef", 0),
    ]
    df = spark.createDataFrame(rows, "kind string, match string, want int")
    for r in df.select("*", pii.gazetteer(F.col("kind"), F.col("match")).alias("got")).collect():
        assert r.got == r.want, r


def test_wider_patterns_have_no_upper_bound(spark):
    secret = "ab12" * 500
    host = "h" * 300
    text = f"key {secret} mail {'u' * 90} (at) {host} (dot) {'x' * 80} (dot) y1 (dot) y2 (dot) y3 (dot) org"
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(
        pii.located(F.col("text"), pii.WIDER["secret"], F.lit(True)).alias("s"), pii.located(F.col("text"), pii.WIDER["email"], F.lit(True)).alias("e")
    ).first()
    assert [x["match"] for x in got.s] == [secret] and [x["match"] for x in got.e] == [text[text.index("u" * 90) :]]
    long = "a1" * 200_000  # no match may recurse per repetition
    df = spark.createDataFrame([(long + " " + "x" * 200_000 + " (at) " + "y (dot) " * 20_000,)], "text string")
    row = pii.candidates(df.withColumn("doc_id", F.lit(1))).first()
    assert any(s.kind == "secret" and len(s["match"]) == len(long) for s in row.spans)


def test_kinds_are_told_by_pattern():
    assert all(re.compile(p.replace("++", "+").replace("}+", "}").replace("?+", "?")) for p in pii.WIDER.values())
