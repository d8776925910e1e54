"""Each operator against plain Python on documents full of edge cases."""

import collections
import random
import time

import numpy as np
import pytest

from evseq.llm import (
    boosting,
    decontaminate,
    exact_dedup,
    html_extract,
    ngram_join,
    pii,
    quality,
    range_coder,
    sentencepiece_codec,
    suffix_dedup,
    token_files,
    toxicity,
)
from evseq.llm.common import tokenizer_path
from evseq.llm.components import connected_components
from tests.llm import brute
from tests.llm.conftest import prose


def bag(found):
    return collections.Counter(found)


# ------------------------------------------------------------ 1 decontamination


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_contamination(docs, rows, items, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)  # 300: many blocks of windows
    got = decontaminate.contamination(docs, items[1]).collect()
    want = [(d, n, h, len(i), tuple(i)) for d, n, h, i in brute.contamination(rows, items[0])]
    assert bag((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"])) for r in got) == bag(want)


def test_items_of_one_window_are_dealt_over_blocks(spark, docs, rows, monkeypatch):
    quote = " ".join(prose(3, 40).split()[5:15])
    found = [(i, quote) for i in range(200)]
    bench = spark.createDataFrame(found, "item_id long, text string")
    per = decontaminate.windows(bench).groupBy(decontaminate.in_block(4).alias("b")).count().collect()
    assert len(per) == 4 and max(r["count"] for r in per) < 100
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 5_000)
    got = decontaminate.contamination(docs, bench).collect()
    assert bag((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == bag(
        (d, n, h, tuple(i)) for d, n, h, i in brute.contamination(rows, found)
    )


def test_long_texts_are_searched_in_pieces(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 64)
    text = prose(8, 600)
    w = text.split()
    items = [(str(k), " ".join(w[k : k + 10])) for k in range(0, 590, 7)] + [("s", "the of"), ("t", w[3])]
    n, spans, found = decontaminate.Searcher(items).search(text)
    want = brute.contamination([(0, text)], items)[0]
    assert (n, sum(b - a for a, b in spans), sorted(found)) == want[1:]


def test_contamination_of_nothing(spark, docs, empty, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(docs, none).collect())
    assert decontaminate.contamination(empty, items[1]).count() == 0


def test_drop_contaminated_keeps_columns(docs, rows, items):
    left = decontaminate.drop_contaminated(docs, items[1])
    assert left.columns == docs.columns
    want = [d for (d, _, h, _) in brute.contamination(rows, items[0]) if not h]
    assert bag(r[0] for r in left.collect()) == bag(want)


# ------------------------------------------------------------ 2 n-gram join


def near_rows(seed=5, groups=6, size=25):
    """Groups of edited copies around the threshold, and a passage many share."""
    rng, out = random.Random(seed), []
    passage = prose(99, 30)
    for g in range(groups):
        base = prose(seed * 100 + g, rng.randrange(30, 160)).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(9)}"
            out.append(" ".join(w) + (f" {passage}" if rng.random() < 0.2 else ""))
    rng.shuffle(out)
    return list(enumerate(out))


def test_ngram_join_edges(docs, rows, empty):
    got = ngram_join.near_duplicates(docs)
    assert bag(map(tuple, got.collect())) == bag(brute.components(rows))
    assert ngram_join.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block_sets", [ngram_join.BLOCK_SETS, 7])
def test_ngram_join_groups(spark, block_sets):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicates(df, block_sets=block_sets)  # 7: clusters of many blocks
    assert bag(map(tuple, got.collect())) == bag(brute.components(rows))


def test_tree_links_against_all_pairs():
    rows = near_rows(11, 3, 20)
    sets = list(ngram_join.Shingler().sets(t for _, t in rows))
    everyone = list(range(len(sets)))
    links = ngram_join.tree_links(sets, everyone, everyone, everyone)
    component = {d: c for d, _, c in brute.components(rows)}
    assert all(component[a] == component[b] for a, b in links)
    assert len(links) == len(sets) - len(set(component.values()))  # a spanning forest


def test_keep_one(docs, rows):
    left = ngram_join.keep_one(docs)
    gone = {d for d, _, c in brute.components(rows) if d is not None and d != c}
    assert left.columns == docs.columns
    assert bag(r[0] for r in left.collect()) == bag(d for d, _ in rows if d not in gone)


def test_keep_one_tells_rows_of_an_id_apart(spark):
    a, b = prose(31, 80), prose(32, 80)
    near = a + " tail"
    rows = [(1, a), (2, near), (2, b), (3, near), (2, None), (2, "")]
    left = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(map(tuple, left.collect())) == bag([(1, a), (2, b), (2, None), (2, "")])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


# ------------------------------------------------------------ 3 token files


@pytest.mark.parametrize(
    "ids",
    [
        np.zeros(0, np.uint16),
        np.zeros(5000, np.uint16),
        np.full(3, 65535, np.uint16),
        np.arange(9000).astype(np.uint16),
        np.random.default_rng(1).integers(0, 65536, 5000).astype(np.uint16),
        np.random.default_rng(2).zipf(1.3, 7000).astype(np.uint16),
    ],
)
def test_coder_round_trip(ids):
    blocks = range_coder.encode(ids)
    assert np.array_equal(np.concatenate([*range_coder.decode(blocks), np.zeros(0, np.uint16)]), ids)
    if blocks:  # each block on its own
        assert np.array_equal(range_coder.decode(blocks[-1:])[0], ids[(len(blocks) - 1) * range_coder.BLOCK :])


def test_coder_compresses_and_checks():
    ids = np.tile(np.arange(300, dtype=np.uint16), 40)
    blocks = range_coder.encode(ids)
    assert sum(len(b) for b, _, _ in blocks) < len(ids)
    data, crc, n = blocks[0]
    with pytest.raises(ValueError):
        range_coder.decode([(data[:40] + bytes([data[40] ^ 1]) + data[41:], crc, n)])


def test_token_files(docs, rows, empty, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    monkeypatch.setattr(token_files, "PART_BYTES", 20_000)  # several parts
    got = token_files.token_digests(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    by_start = sorted(got, key=lambda r: r.start)
    ids = [r.doc_id for r in by_start]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    texts = collections.defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    # rows that share an id may come in any order among themselves
    at = 0
    left = {d: bag((n, crc) for _, _, n, crc in brute.tokens([(d, t) for t in ts], tokenizer)) for d, ts in texts.items()}
    for r in by_start:
        assert r.start == at
        left[r.doc_id][(r.n_tokens, r.ids_crc32)] -= 1
        at += r.n_tokens
    assert not any(any(c.values()) for c in left.values())
    assert token_files.token_digests(empty, path).count() == 0


def test_chunks_give_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer, rng = Tokenizer.from_file(path), random.Random(4)
    encoder = token_files.Encoder(open(path, encoding="utf-8").read())
    texts = ["".join(rng.choice("ab 's,.\n  \té1中\x1c") for _ in range(rng.randrange(30))) for _ in range(3000)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


# ------------------------------------------------------------ 4 quality, trees


def test_forest_learns_and_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000], trees=40, depth=3)
    assert ((forest.predict(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    row = x[2000]
    total = forest.base
    for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
        node = 0
        for _ in range(forest.depth):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        total += leaf[node - (2**forest.depth - 1)]
    assert forest.raw(x[2000:2001])[0] == pytest.approx(total)
    constant = boosting.fit(np.ones((10, 2)), np.ones(10))
    assert constant.predict(np.ones((1, 2)))[0] > 0.5
    assert boosting.fit(np.zeros((0, 2)), np.zeros(0)).predict(np.ones((2, 2))).tolist() == [0.5, 0.5]


def test_quality_edges(spark, docs, rows, labels, empty):
    got = quality.scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by_text = {}
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        by_text.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_text[5]) == 1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    assert quality.scores(empty, labels).count() == 0
    assert quality.keep_good(docs, none).columns == docs.columns


def test_quality_pieces(monkeypatch):
    whole = quality.features(prose(1, 50))
    assert np.array_equal(quality.features(None), np.zeros(quality.N_FEATURES)) and whole.shape == (quality.N_FEATURES,)
    monkeypatch.setattr(quality, "PIECE", 100)
    assert quality.features(prose(1, 50))[0] == whole[0]


# ------------------------------------------------------------ 5 toxicity


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 4, 800)
    rows = [([0] if g else [1], [g + rng.normal(0, 0.3) if g else 1.0]) for g in y]
    weights, theta = toxicity.fit_ordinal(rows, y, 2, 3)
    assert list(theta) == sorted(theta) and weights[0] > 0 > weights[1]
    model = toxicity.OrdinalModel(np.array([0, 1]), weights, theta)
    above = model.above(["a", "b"], lambda t: ([0], [3.0]) if t == "a" else ([1], [1.0]))
    assert (np.diff(above, axis=1) <= 0).all() and above[0].sum() > 2 > 1 > above[1].sum()


def test_toxicity_edges(spark, docs, rows, labels, empty):
    got = toxicity.severity(docs, labels).collect()
    assert len(got) == len(rows) and all(r.expected_severity >= 0 for r in got)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert not any(r.toxic for r in toxicity.severity(docs, none).collect())
    assert toxicity.severity(empty, labels).count() == 0


def test_toxicity_finds_words(spark):
    rng, texts, marks = random.Random(1), [], []
    for i in range(400):
        w = prose(1000 + i, rng.randrange(20, 80)).split()
        bad = i % 4 == 0
        for _ in range(rng.randrange(1, 6) if bad else 0):
            w[rng.randrange(len(w))] = rng.choice(["vilex", "gruntor", f"badfix{rng.randrange(99)}"])
        texts.append((i, " ".join(w)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.severity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()}
    held = [i for i in got if got[i].held_out]
    assert sum(got[i].toxic != bool(m) for i, m in marks if i in held) <= 0.06 * len(held)


# ------------------------------------------------------------ 6 exact dedup


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(docs, rows, keep):
    got = exact_dedup.duplicate_groups(docs, keep=keep).drop("keep_rows").collect()
    assert bag(map(tuple, got)) == bag(brute.exact(rows, max if keep == "largest" else min))


def test_exact_groups_survive_collisions(docs, rows, empty):
    from pyspark.sql import functions as F

    weak = lambda text: F.unhex(F.substring(F.md5(F.encode(F.substring(text, 1, 3), "UTF-8")), 1, 2))
    got = exact_dedup.duplicate_groups(docs, keep="largest", content_hash=weak).drop("keep_rows").collect()
    assert bag(map(tuple, got)) == bag(brute.exact(rows))
    assert exact_dedup.duplicate_groups(empty).count() == 0


def test_deduplicate_leaves_one_row_a_text(docs, rows):
    left = exact_dedup.deduplicate(docs, keep="largest")
    assert left.columns == docs.columns
    texts = [r[1] or "" for r in left.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {t or "" for _, t in rows}


# ------------------------------------------------------------ 7 personal data


def spans_of(row, name):
    return [(s.kind, s.start, s.end) for s in row[name]]


def test_personal_data(spark, docs, rows, empty):
    rng = random.Random(7)
    pieces = ["a@b.c", "_x@d.e-f.g", "1.2.3.4", "999.1.1.1", "001.02.3.255", "4111111111111111", "4111-1111 1111 1111", "+49 (30) 1234-567", "+1", "++12 3", "12 34", " ", "x", ".", "-", "é😀", "@", "5500 0000 0000 0004", "1" * 20]
    texts = [(100 + i, "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))) for i in range(400)]
    both = [(d, t) for d, t in rows] + texts
    df = spark.createDataFrame(both, "doc_id long, text string")
    got = pii.find_personal_data(df).collect()
    want = bag((d, tuple(brute.personal(t))) for d, t in both)
    assert bag((r.doc_id, tuple(spans_of(r, "base"))) for r in got) == want
    assert all(set(spans_of(r, "base")) <= set(spans_of(r, "spans")) for r in got)
    assert pii.find_personal_data(empty).count() == 0
    assert pii.find_personal_data(docs).count() == len(rows)


def test_further_spans(spark):
    secret = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    texts = [(i, f"mail u{i}@mail.example.org now, token = \"{secret}\" end {i}") for i in range(60)]
    got = pii.find_personal_data(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    for r in got:
        assert [k for k, _, _ in spans_of(r, "base")] == ["email"]
        assert [texts[r.doc_id][1][a:b] for k, a, b in spans_of(r, "spans") if k == "secret"] == [secret]


def test_labelers_are_told_apart(spark):
    n = {"one": [1, 1, 1, 1, 1], "zero": [0, -1, 0, 0, -1], "mixed": [1, 1, 0, 0, 1]}
    rows = [(*n["one"], 50), (*n["zero"], 200), (*n["mixed"], 30)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} int" for k in pii.LABELERS) + ", n long")
    prior, p = pii.fit_labelers(df)
    assert 0.2 < prior < 0.4 and p["shape", 1, 1] > 0.9 > 0.1 > p["shape", 1, 0]


# ------------------------------------------------------------ 8 repeated strings


def repeat_rows():
    rng, passage = random.Random(2), prose(50, 60)
    out = []
    for i in range(60):
        text = prose(2000 + i, rng.randrange(10, 90))
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(passage) - 60)
            text += " " + passage[a : a + rng.randrange(60, 250)] + " " + prose(3000 + rng.randrange(500), 8)
        out.append((i, text))
    return out + [(60, out[3][1]), (61, "ab" * 300), (62, "x" + "ab" * 200), (63, "line of text here\n" * 40)]


def repeats_of(df, **kw):
    got = suffix_dedup.remove_repeats(df, **kw).collect()
    return bag((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_repeats(spark, hot):
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = bag((d, n, tuple(s), k) for d, n, s, k in brute.repeats(rows))
    assert repeats_of(df, hot=hot) == want  # hot=3: anchors compared by Spark's own joins


def test_repeats_edges(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_RUNS", 5)
    # equal rows are one document; other rows with one id are ordered by a hash
    plain = [r for r in rows if r[0] not in (14, None)]
    plain.remove((5, rows[4][1]))
    known = docs.filter("doc_id is not null and doc_id <> 14")
    want = {d: (n, tuple(s), k) for d, n, s, k in brute.repeats(plain)}
    got = suffix_dedup.remove_repeats(known).collect()
    assert len(got) == len(plain) + 1
    assert all((r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) == want[r.doc_id] for r in got)
    assert suffix_dedup.remove_repeats(docs).count() == len(rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_repeated_rows_are_one_document(spark, hot):
    a, b = prose(21, 80), prose(22, 90)
    rows = [(None, b), (3, "head " + b[:250]), (5, a), (9, a), (10, "x" + a[40:300] + "y")]
    want = {d: (spans, kept) for d, _, spans, kept in brute.repeats(rows)}
    # the first copies of a and b stand on several rows, as does a document with a part of one
    df = spark.createDataFrame(rows + [rows[0], rows[2], rows[2], rows[4]], "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(df, hot=hot).collect()
    assert bag(r.doc_id for r in got) == bag([None, None, 3, 5, 5, 5, 9, 10, 10])
    for r in got:
        assert ([(s.start, s.end) for s in r.spans], bytes(r.kept)) == want[r.doc_id]
    assert want[5] == ([], a.encode()) and want[None] == ([], b.encode())


def test_long_texts_are_hashed_in_buffers(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 512)
    raw = prose(1, 2000).encode()
    index, _, first, last = (np.concatenate(x) for x in zip(*suffix_dedup.text_runs([raw, b"short", raw[:100]], 100, 20)))
    windows = [(i, p) for i, a, b in zip(index, first, last) for p in range(a, b + 1)]
    assert sorted(windows) == [(0, p) for p in range(len(raw) - 99)] + [(2, 0)]


def test_maximal_repeats_of_a_string():
    data = b"banana_bandana_anab"
    at = np.arange(len(data) - 2)
    sa = suffix_dedup.SuffixArray(data, at, len(data) - at, 3)
    left = [-1 if p == 0 else data[p - 1] for p in sa.positions.tolist()]
    found = {
        (data[sa.positions[lo] : sa.positions[lo] + n].decode(), tuple(sorted(sa.positions[lo : hi + 1].tolist())))
        for n, lo, hi in suffix_dedup.maximal_repeats(sa, left, 3)
    }
    want = set()
    for n in range(3, len(data)):
        for s in {data[i : i + n] for i in range(len(data) - n + 1)}:
            own = [i for i in range(len(data)) if data.startswith(s, i)]
            before = {data[i - 1] if i else -1 for i in own}
            after = {data[i + n] if i + n < len(data) else -1 for i in own}
            if len(own) > 1 and (len(before) > 1 or -1 in before) and (len(after) > 1 or -1 in after):
                want.add((s.decode(), tuple(own)))
    assert found == want


# ------------------------------------------------------------ 9 main text


@pytest.fixture(scope="module")
def forest(spark):
    return html_extract.train(spark.createDataFrame([], "url string, html string"), max_pages=150)


def test_frames_are_told_apart(forest):
    rng, right = random.Random(77), []
    paragraphs = [prose(i, 30).capitalize() + "." for i in range(40)]
    for _ in range(80):
        page = html_extract.build_page(rng, paragraphs)
        nodes = html_extract.parse(page)
        want = " ".join(
            nodes[i].text.replace(html_extract.MARK, "") for i in html_extract._page_order(nodes) if html_extract.MARK in nodes[i].text
        )
        for n in nodes:
            n.text = n.text.replace(html_extract.MARK, "")
        got = html_extract.main_text(nodes, html_extract.decode(nodes, forest.raw(html_extract.features(nodes))))
        right.append(got == want)
    assert np.mean(right) > 0.8


def test_decoding_never_contradicts(forest):
    nodes = html_extract.parse(html_extract.build_page(random.Random(3), [prose(i, 20) for i in range(9)]))
    chosen = html_extract.decode(nodes, np.random.default_rng(1).normal(size=len(nodes)))
    assert all(chosen[nodes[i].parent] for i in range(1, len(nodes)) if chosen[i])


def test_parse_text():
    page = '<p>a &amp; b&#233;<br>c<p class="x>y">d <b>e</b>f<script>var t="</p>"; if (a<b) x();</script><!-- <p>no</p> --><ul><li>g<li>h</ul>i'
    nodes = html_extract.parse(page)
    assert html_extract.main_text(nodes, [True] * len(nodes)) == "a & bé c d ef g h i"
    assert html_extract.parse(None)[0].text == "" and html_extract.parse("plain")[0].text == "plain"


@pytest.mark.parametrize(
    "page, text",
    [
        ('<script>var s="<!--";</script><article><p>T</p></article>', "T"),
        ("<p>a</p><SCRIPT>for(i=0;i<n;i++)f(i)</Script ><p>b</p><script>g()</script>c", "a b c"),
        ("<style>a::after{content:'<!--'}</style><title>x<y</title><noscript><!-- </noscript><p>T</p>", "T"),
        ("<script>s='</scripts>'+\"<p>\"</script\n><p>T</p><script>never closed <p>U</p>", "T"),
        ('<svg><style>b{content:"<!--"}</style><!-- </svg> --><text>x</text></svg><p>T</p>', "T"),
        ("<svg><style>b{} </svg><p>T</p>", "T"),
        ('<p title="a<b">T</p><p data-x=\'<p>"no"</p>\'>U</p>', "T U"),
        ('<p title=it\'s>T</p><p class="a"">U</p><p class="b">don\'t</p>', "T U don't"),
        ('<p title="a>T</p><p>U</p>', "T U"),
        ("<p>1 <2, a <b and c</p><p>U</p>", "1 <2, a <b and c U"),
    ],
)
def test_parse_raw_text_and_quotes(page, text):
    nodes = html_extract.parse(page)
    assert html_extract.main_text(nodes, [True] * len(nodes)) == text


@pytest.mark.parametrize("part", ['x="<a y" ', "<a x='<b \"", "<a<a", "<script>", '<a x="', "<svg><style>", "<p title=\"a<b' "])
def test_parse_reads_hostile_pages_once(part):
    start = time.perf_counter()
    html_extract.parse("<a " + part * 40_000)
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "</p>" * 100_000, "<h1>x" * 100_000, "<table><tr><td>" * 40_000, "<ul><li>" * 50_000 + "</ul>" * 50_000]
    + ["<p>" + "<div>" * 50_000 + "<li>x" * 50_000],
)
def test_nested_pages_take_linear_time(page):
    start = time.process_time()
    nodes = html_extract.parse(page)
    assert time.process_time() - start < 10
    assert len(html_extract.decode(nodes, np.ones(len(nodes)))) == len(nodes)


@pytest.mark.parametrize("n", [2, 49, 50, 300])
def test_largest_sibling_share_at_every_count(n):
    nodes = html_extract.parse("<article>" + "<p>ab</p>" * (n - 1) + "<p>abcdefgh</p></article>")
    shares = html_extract.features(nodes)[2:, -3]
    assert len(shares) == n and np.allclose(shares, 8 / (2 * n + 6))


def test_some_built_pages_are_long():
    rng, paragraphs = random.Random(1), [prose(i, 8) for i in range(6)]
    counts = [html_extract.build_page(rng, paragraphs).count(html_extract.MARK) for _ in range(300)]
    assert sum(c >= 50 for c in counts) >= 3 and max(counts) >= 200


def test_extract_edges(spark, forest):
    long = "".join(f"<p>{prose(i, 60)}.</p>" for i in range(400))
    rows = [
        (1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<article><p>" + prose(1, 40) + "</p></article>", "x"),
        (3, None, "<article><p>" + prose(1, 40) + "</p></article>", "x"), (4, "v", f"<body><nav><a href=q>menu</a></nav><article>{long}</article>", "x"),
        (None, "w", "<<<>>> <div", "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, HTML string")
    got = [(r.page_id, r.text) for r in html_extract.extract(pages, model=forest).collect()]
    assert len(got) == len(rows) and (1, "") in got and (2, "") in got
    assert got.count((3, prose(1, 40))) == 2
    assert dict(got)[4] == " ".join(f"{prose(i, 60)}." for i in range(400))
    assert html_extract.extract(pages.limit(0)).count() == 0


# ------------------------------------------------------------ 10 SentencePiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_codec_gives_the_librarys_ids(library):
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(tokenizer_path("piece_bpe_32k.model")))
    rng = random.Random(6)
    signs = "aeiou thrnsé ß中😀\t\n  ▁._-0123ABC'\"ing"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["", " ", "   ", "\n", prose(1, 500)]
    got = sentencepiece_codec.encode_batch(codec, texts)
    assert [list(g) for g in got] == library.encode(texts)
    assert [codec.decode(g) for g in got] == [library.decode(g.tolist()) for g in got]


def test_codec_in_pieces(library, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "PIECE", 50)
    monkeypatch.setattr(sentencepiece_codec, "CACHE_WORDS", 20)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(tokenizer_path("piece_bpe_32k.model")))
    texts = [prose(1, 300), "a  b\n" * 60, " " * 200]
    assert [list(g) for g in sentencepiece_codec.encode_batch(codec, texts)] == library.encode(texts)


def test_codec_over_spark(docs, rows, empty, library):
    path = tokenizer_path("piece_bpe_32k.model")
    out = sentencepiece_codec.encode_decode(docs, path)
    assert out.columns == [*docs.columns, "piece_ids", "decoded"]
    got = bag((r[0], tuple(r.piece_ids), r.decoded) for r in out.collect())
    assert got == bag((d, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for d, t in rows)
    trip = sentencepiece_codec.round_trip(docs, path).collect()
    assert len(trip) == len(rows) and all(r.exact for r in trip)
    assert sentencepiece_codec.round_trip(empty, path).count() == 0
