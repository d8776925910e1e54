"""The registered text queries and the pipeline on the smallest driver tables."""

import collections
import os
import re
import zlib

import numpy as np
import pytest

from evseq.llm import boosting, quality, sentencepiece_codec
from evseq.llm.common import tokenizer_path
from evseq.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def collected(spark, name):
    return QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE[name])
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert collections.Counter(tuple(r[c] for c in columns) for r in df.collect()) == collections.Counter(rel.fetchall())


def test_op2(spark, documents):
    assert sorted(map(tuple, collected(spark, "op2_ngram_join"))) == sorted(brute.components(documents))


def test_op3(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert sorted(map(tuple, collected(spark, "op3_token_files"))) == brute.tokens(documents, tokenizer)


def test_op4_held_out(spark, con):
    got = {r.doc_id: r for r in collected(spark, "op4_quality")}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    known = con.execute("select doc_id, quality from labels").fetchall()
    right = [got[i].predicted == q for i, q in known]
    assert np.mean(right) > 0.9


def test_op5(spark, con, documents):
    got = {r.doc_id: r for r in collected(spark, "op5_toxicity")}
    assert len(got) == len(documents)
    known = con.execute("select doc_id, toxic from labels").fetchall()
    assert np.mean([got[i].toxic == bool(t) for i, t in known]) > 0.85
    assert all((r.grade > 0) == r.toxic for r in got.values())


def test_op7(spark, documents):
    got = {r.doc_id: r for r in collected(spark, "op7_pii")}
    for i, text in documents:
        spans = brute.personal(text)
        assert [got[i][f"n_{k}"] for k in brute.PATTERNS] == [sum(s[0] == k for s in spans) for k in brute.PATTERNS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(got[i].spans.split(","))


def test_op8(spark, documents):
    import hashlib

    got = sorted(map(tuple, collected(spark, "op8_suffix_dedup")))
    want = [
        (d, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for d, n, s, k in brute.repeats(documents)
    ]
    assert got == want


def test_op9(spark, con):
    import html

    got = {r.page_id: r for r in collected(spark, "op9_html_extract")}
    for i, page in con.execute("select page_id, html from pages").fetchall():
        article = re.search("<article>(.*)</article>", page, re.S)[1]
        text = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert (got[i].text, got[i].n_chars) == (text, len(text))


def test_op10(spark, documents):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in collected(spark, "op10_sentencepiece")}
    for i, text in documents:
        ids = np.array(sp.encode(text), dtype="<u4")
        assert got[i].exact and (got[i].n_pieces, got[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_pipeline(spark, con, documents):
    """``run`` against the stages in plain Python."""
    import corpus_pipeline

    labels = dict(con.execute("select doc_id, quality from labels").fetchall())
    train = sorted((i, t) for i, t in documents if i in labels and zlib.crc32(str(i).encode()) % 5)
    forest = boosting.fit(quality.feature_rows([t for _, t in train]), np.array([float(labels[i]) for i, _ in train]))
    score = forest.predict(quality.feature_rows([t for _, t in documents]))
    rows = [r for r, s in zip(documents, score) if s >= quality.THRESHOLD]
    rows = [r for r, e in zip(rows, brute.exact(rows)) if e[3]]
    rows = [r for r, c in zip(rows, brute.components(rows)) if c[0] == c[2]]
    items = con.execute("select item_id, text from benchmark").fetchall()
    rows = [r for r, c in zip(rows, brute.contamination(rows, items)) if not c[2]]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(tokenizer_path("piece_bpe_32k.model")))
    want = [(i, t, tuple(codec.encode_all([t])[0].tolist()), t) for i, t in rows]

    assert [name for name, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids", "decoded"]
    assert sorted((r.doc_id, r.text, tuple(r.piece_ids), r.decoded) for r in got.collect()) == want


def test_stages_on_nothing(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs


def test_op12(spark, con):
    got = collected(spark, "op12_shuffle_shards")
    texts = dict(con.execute("select doc_id, text from documents").fetchall())
    raw = {i: (t or "").encode() for i, t in texts.items()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(b) + 1, zlib.crc32(b)) for i, b in raw.items()}
    sizes = collections.Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert len({(r.shard, r.slot) for r in got}) == len(got) and all(r.slot < sizes[r.shard] for r in got)


def test_op13(spark):
    import pyarrow.parquet as pq

    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    n, deviation, z, values, trace = brute.whitening([r["embedding"] for r in rows])
    want = {r["vec_id"]: (d, w) for r, d, w in zip(rows, deviation, z)}
    got = collected(spark, "op13_whitening")
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    assert all(r.deviation == want[r.vec_id][0] for r in got)
    assert all(abs(abs(r.whitened) - abs(want[r.vec_id][1][r.component - 1])) < 1e-9 for r in got)
    assert all(abs(r.explained - values[r.component - 1] / trace) < 1e-12 and r.identity_error < 1e-4 for r in got)
