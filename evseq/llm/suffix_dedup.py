"""Operator 8: removal of repeated byte strings by an enhanced suffix array.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller id, or same document and earlier start) is removed.

1. Each window of ``LENGTH`` bytes has one anchor, its leftmost k-gram of least
   hash; equal windows have equal anchors.  Windows with the same anchor
   position form a run.  Runs are rows of numbers: the hash of the anchor, the
   hash of the run's bytes, and the place.  They are dealt by anchor; of equal
   runs all but the earliest are covered, and an anchor of one distinct run is
   done.  A task first drops what repeats within its own batch, so copies and
   common passages travel as a fraction of their number.
2. The bytes of the distinct runs of the other anchors, each once, are dealt out
   by anchor.  In a shard an enhanced suffix array (suffixes of bounded runs,
   sorted, with common prefixes) is built and its common-prefix interval tree is
   read off with a stack.  Intervals whose occurrences differ in the byte to the
   left (or start a run) are maximal repeats; all occurrences but the earliest
   are covered.  Left bytes and the earliest occurrence are carried up the
   stack, so the work is linear in the suffixes.
3. Covered spans are merged per document and cut out.

An anchor of more than ``HOT`` distinct runs is split by longer keys before it
goes to the shards: its windows with the anchor in their left half share the
bytes right of it, the others those left of it, so each run gives at most two
sub-runs under keys of 60 bytes, then of 80 and so on.  Equal sub-runs are folded
and keys of one sub-run are done; after seven levels a key is a whole window.
Every window stays under exactly one key, and nothing is capped.

Runs count as equal by two 64-bit hashes, of the anchor and of all their bytes.

Defined cases: a null text has no bytes; a null id is before every other id;
rows equal in id and text count as one document; rows with one id and
different texts are ordered by a hash of the text; texts under ``LENGTH``
bytes lose nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evseq.llm.common import pick, small, written

LENGTH = 100
GRAM = 20
HOT = 20_000  # distinct runs under one key; beyond it the key is made longer
SHARD_RUNS = 25_000  # runs in a shard, on average
BUFFER = 1 << 18  # bytes hashed at once, few enough for the cache; positions in it take 24 bits
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash sums of all prefixes, and the factors that move a difference to its start."""
    n = len(data)
    room = -(-n // BUFFER) * BUFFER  # few sizes, so that the tables are kept
    up, down = _powers(_BASE, room)[:n], _powers(_INVERSE, room)[:n]
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=prefix[1:])
    return prefix, down


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xFF51AFD7ED558CCD)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k bytes at each position."""
    prefix, down = _prefix_hashes(data)
    n = len(data)
    return _mixed((prefix[k:] - prefix[: n - k + 1]) * down[: n - k + 1])


def anchor_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, k: int):
    """Runs of windows with one anchor: (anchor hash, hash of the run's bytes,
    first window, last window).

    ``starts``/``ends``: the documents' byte ranges in ``data``.
    """
    w = length - k + 1
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    prefix, down = _prefix_hashes(data)
    h = _mixed((prefix[k:] - prefix[: len(data) - k + 1]) * down[: len(data) - k + 1])
    least = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[: len(least) - (w - width)], least[w - width :])
    anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    step = np.zeros(len(anchor) + 1, dtype=np.int32)
    long_enough = ends - starts >= length
    np.add.at(step, starts[long_enough], 1)
    np.add.at(step, ends[long_enough] - length + 1, -1)
    valid = np.cumsum(step[:-1]) > 0
    change = np.ones(len(anchor), dtype=bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    first = np.nonzero(change)[0]
    last = np.append(first[1:], len(anchor)) - 1
    ok = valid[first]
    first, last = first[ok], last[ok]
    size = (last - first + length).astype(np.uint64)
    content = _mixed((prefix[last + length] - prefix[first]) * down[first] ^ size << np.uint64(56))
    return h[anchor[first]], content, first, last


def hashed_runs(texts: list[bytes], length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, anchor hash, hash of the bytes, first window, last window),
    in buffers of bounded size."""
    pieces: list[tuple[int, int, bytes]] = []
    size = 0
    for i, raw in enumerate(texts):
        for at in range(0, max(1, len(raw) - length + 1), BUFFER):
            piece = raw[at : at + BUFFER + length - 1]
            if size + len(piece) > 2 * BUFFER:
                yield _runs_of(pieces, length, k)
                pieces, size = [], 0
            pieces.append((i, at, piece))
            size += len(piece)
    yield _runs_of(pieces, length, k)


def text_runs(texts: list[bytes], length: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text index, anchor hash, first window, last window) of all runs."""
    for index, h, _, first, last in hashed_runs(texts, length, k):
        yield index, h, first, last


def _runs_of(pieces: list[tuple[int, int, bytes]], length: int, k: int):
    ends = np.cumsum([len(p) for _, _, p in pieces], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(pieces) else ends
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    h, content, first, last = anchor_runs(data, starts, ends, length, k)
    piece = np.searchsorted(ends, first, side="right")
    index = np.array([i for i, _, _ in pieces], dtype=np.int64)[piece]
    shift = np.array([at for _, at, _ in pieces], dtype=np.int64)[piece] - starts[piece]
    return index, h.view(np.int64), content.view(np.int64), first + shift, last + shift


def repeated_here(h: np.ndarray, content: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which runs have an equal one at an earlier place among those given."""
    order = np.lexsort([start, rank, content, h])
    h, content, rank, start = h[order], content[order], rank[order], start[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (content[1:] != content[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    late = np.zeros(len(h), dtype=bool)
    late[order] = (rank != rank[head]) | (start != start[head])
    return late


class SuffixArray:
    """Suffixes of ``data`` at ``positions``, sorted, with neighbours' common prefixes.

    ``room``: bytes each suffix may use (to the end of its run, so at most
    twice the string length, which bounds the sort keys).  Suffixes whose first
    ``shortest`` bytes are alone, by their rolling hash, are left out first.
    """

    def __init__(self, data: bytes, positions: np.ndarray, room: np.ndarray, shortest: int):
        h = gram_hashes(np.frombuffer(data, np.uint8), shortest)[positions]
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        starts, room = positions[twice], room[twice]
        suffixes = [data[p : p + r] for p, r in zip(starts.tolist(), room.tolist())]
        order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__), dtype=np.int64)
        self.positions = starts[order]
        room = room[order]
        limit = np.minimum(room[:-1], room[1:])
        raw = np.frombuffer(data, np.uint8)
        self.common = np.zeros(len(limit), dtype=np.int64)
        live = np.arange(len(limit))
        a, b = self.positions[:-1], self.positions[1:]
        step = 0
        while len(live):
            live = live[(limit[live] > step)]
            live = live[raw[a[live] + step] == raw[b[live] + step]]
            step += 1
            self.common[live] = step


_DIVERSE = -2  # the byte to the left differs, or a run starts


class _Interval:
    """An open common-prefix interval: the byte left of all its suffixes so far,
    its earliest suffix, and those that an earlier one repeats at this depth."""

    __slots__ = ("depth", "begin", "letter", "best", "late")

    def __init__(self, depth: int, begin: int, letter: int, best: int):
        self.depth, self.begin, self.best, self.late = depth, begin, best, []
        self.letter = letter if letter >= 0 else _DIVERSE

    def add(self, letter: int, best: int, place: list) -> None:
        if letter != self.letter:
            self.letter = _DIVERSE
        if place[best] < place[self.best]:
            best, self.best = self.best, best
        self.late.append(best)


def repeat_groups(sa: SuffixArray, left: list[int], place: list, shortest: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """(length, first, last index in ``sa.positions``, late) of every maximal repeat.

    ``left``: the byte before each sorted suffix, or -1 where a run starts;
    ``place``: where it stands, in any order that compares.  ``late`` names the
    suffixes whose longest repeat with an earlier occurrence is this one.  A
    group whose suffixes all follow the same byte is no maximal repeat: the one
    that starts a byte earlier covers it.
    """
    deep = sa.common >= shortest
    edge = np.diff(np.concatenate([[0], deep.astype(np.int8), [0]]))
    common = sa.common.tolist()
    for lo, hi in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()):
        # suffixes lo..hi share at least the shortest length
        stack: list[_Interval] = []
        for i in range(lo, hi + 1):
            depth = common[i] if i < hi else -1
            begin, letter, best = i, left[i], i
            while stack and stack[-1].depth > depth:
                top = stack.pop()
                top.add(letter, best, place)
                if top.letter == _DIVERSE:
                    yield top.depth, top.begin, i, top.late
                begin, letter, best = top.begin, top.letter, top.best
            if depth >= 0:
                if stack and stack[-1].depth == depth:
                    stack[-1].add(letter, best, place)
                else:
                    stack.append(_Interval(depth, begin, letter, best))


def maximal_repeats(sa: SuffixArray, left: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
    """(length, first, last index in ``sa.positions``) of every maximal repeat, all
    its occurrences in between."""
    for length, first, last, _ in repeat_groups(sa, left, sa.positions.tolist(), shortest):
        yield length, first, last


def covered_in_shard(rows: list[tuple], length: int) -> dict[int, list[tuple[int, int]]]:
    """rows: (document rank, key, start, bytes); spans by document rank."""
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    by_key: dict[int, dict[bytes, tuple[int, int]]] = defaultdict(dict)
    for rank, key, start, raw in sorted(rows, key=lambda r: (r[0], r[2])):
        first = by_key[key].setdefault(raw, (rank, start))
        if first != (rank, start):  # rows equal in id and text send the first run again
            spans[rank].append((start, start + len(raw)))
    entries = [(rank, start, raw) for runs in by_key.values() if len(runs) > 1 for raw, (rank, start) in runs.items()]
    if not entries:
        return spans
    data = b"\xff".join(raw for _, _, raw in entries) + b"\xff"
    size = np.array([len(raw) for _, _, raw in entries], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    n_windows = size - length + 1
    entry = np.repeat(np.arange(len(entries)), n_windows)
    offset = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    position = begin[entry] + offset
    sa = SuffixArray(data, position, size[entry] - offset, length)
    raw = np.frombuffer(data, np.uint8)
    which = np.searchsorted(begin, sa.positions, side="right") - 1
    at = sa.positions - begin[which]
    left = np.where(at > 0, raw[np.maximum(sa.positions - 1, 0)].astype(np.int16), -1).tolist()
    place = [(entries[w][0], entries[w][1] + o) for w, o in zip(which.tolist(), at.tolist())]
    for depth, _, _, late in repeat_groups(sa, left, place, length):
        for i in late:
            rank, start = place[i]
            spans[rank].append((start, start + depth))
    return spans


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.tie") == F.col(f"{b}.tie"))


def _place(start: str = "start") -> Column:
    return F.struct(F.col("id").isNotNull().alias("known"), "id", "tie", F.col(start).alias("start"))


def dealt_runs(base: DataFrame, length: int, gram: int) -> DataFrame:
    """(id, tie, h, run, late) of the runs that matter: ``late`` ones have an equal
    one at an earlier place, the others are the distinct runs of an anchor that has
    several.  ``run`` is first window << 16 | windows after it."""
    id_type = base.schema["id"].dataType.simpleString()

    def anchors(batches):
        for batch in small(batches):
            ids, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys = [(i is not None, i if i is not None else 0, t) for i, t in zip(ids, ties)]
            rank_of = {key: i for i, key in enumerate(sorted(set(keys)))}
            rank = np.array([rank_of[key] for key in keys], dtype=np.int64)
            found = hashed_runs(batch.column(2).to_pylist(), length, gram)
            index, h, content, first, last = (np.concatenate(x) for x in zip(*found))
            late = repeated_here(h, content, rank[index], first)
            # late runs need no partner: they are dealt anywhere
            deal = np.where(late, content ^ _mixed(np.arange(len(h), dtype=np.uint64)).view(np.int64), h)
            take = pa.array(index)
            run = (first << 16) | (last - first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(deal), pa.array(content, mask=late), pa.array(run)],
                ["id", "tie", "h", "content", "run"],
            )

    runs = base.mapInArrow(anchors, f"id {id_type}, tie long, h long, content long, run long")
    same = Window.partitionBy("h", "content").orderBy(F.col("id").isNotNull(), "id", "tie", "run")
    anchor = Window.partitionBy("h")
    marked = runs.select(
        "id",
        "tie",
        "h",
        "run",
        # equal places are one place
        (F.col("content").isNull() | (F.rank().over(same) > 1)).alias("late"),
        (F.min("content").over(anchor) != F.max("content").over(anchor)).alias("several"),
    )
    return marked.filter("late or several").drop("several")


def run_bytes(base: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """(id, tie, key, start, bytes) of the runs (id, tie, h, run)."""
    id_type = base.schema["id"].dataType.simpleString()
    own = runs.groupBy("id", "tie").agg(F.collect_set(F.struct("h", "run")).alias("runs"))
    with_text = base.alias("b").join(own.alias("o"), _same_document("b", "o")).select("b.id", "b.tie", "b.text", "o.runs")

    def cut(batches):
        for batch in small(batches):
            runs = batch.column(3)
            fields = runs.flatten()
            ends = np.cumsum(runs.value_lengths().to_numpy(zero_copy_only=False))
            h, run = (fields.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            row = np.searchsorted(ends, np.arange(len(h)), side="right")
            first, size = run >> 16, (run & 0xFFFF) + length
            texts = batch.column(2).to_pylist()
            for at in range(0, len(h), 100_000):
                part = slice(at, at + 100_000)
                found = [texts[i][a : a + n] for i, a, n in zip(row[part].tolist(), first[part].tolist(), size[part].tolist())]
                take = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(h[part]), pa.array(first[part]), pa.array(found, pa.binary())],
                    ["id", "tie", "key", "start", "bytes"],
                )

    return with_text.mapInArrow(cut, f"id {id_type}, tie long, key long, start long, bytes binary")


def with_anchor_place(entries: DataFrame, length: int, gram: int) -> DataFrame:
    """Add ``left``: bytes of the first window left of the anchor."""
    schema = entries.withColumn("left", F.lit(0)).schema

    def locate(batches):
        for batch in small(batches):
            left = []
            for key, raw in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                more = len(raw) - length  # the anchor is in the last window, too
                h = gram_hashes(np.frombuffer(raw, np.uint8), gram).view(np.int64)
                left.append(more + int(np.argmax(h[more : length - gram + 1] == key)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(left, pa.int32())], schema.fieldNames())

    return entries.mapInArrow(locate, schema)


def split_keys(entries: DataFrame, length: int, gram: int) -> DataFrame:
    """Sub-runs under longer keys, at most two for each run.

    The windows under a key have between ``lo`` and ``hi`` bytes left of the
    anchor, so all of them hold ``lo`` bytes left and ``length - gram - hi`` right
    of it, which are the key; the range is halved.
    """
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    own_lo = F.col("left") - (F.octet_length("bytes") - length)

    def half(a: Column, b: Column) -> Column:
        left, last = F.least("left", b), F.greatest(own_lo, a)
        skip = F.col("left") - left
        sub = F.substring("bytes", skip + 1, length + left - last)
        key = F.substring(sub, left - a + 1, gram + a + (length - gram) - b)
        return F.when(
            left >= last,
            F.struct(
                F.xxhash64(a, b, key).alias("key"),
                (F.col("start") + skip).alias("start"),
                sub.alias("bytes"),
                left.cast("int").alias("left"),
                a.cast("int").alias("lo"),
                b.cast("int").alias("hi"),
            ),
        )

    halves = F.array(half(F.col("lo"), middle), half(middle + 1, F.col("hi")))
    return entries.select("id", "tie", F.explode(F.filter(halves, lambda x: x.isNotNull())).alias("x")).select("id", "tie", "x.*")


def calm_entries(entries: DataFrame, length: int, gram: int, hot: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(entries of keys with at most ``hot`` distinct runs, covered spans): the
    others are split by longer keys, equal sub-runs folded, until none is left."""
    calm, spans = [], []
    lo, hi = 0, length - gram
    while True:
        counts = written(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot), "suffix-hot-keys")
        if counts.isEmpty() or lo == hi:
            return [*calm, entries], spans
        calm.append(entries.join(counts, "key", "left_anti").select("id", "tie", "key", "start", "bytes"))
        own = entries.join(counts.select("key"), "key", "left_semi").select("id", "tie", "key", "start", "bytes", *entries.columns[5:])
        if "left" not in own.columns:
            own = with_anchor_place(own, length, gram).withColumns({"lo": F.lit(lo), "hi": F.lit(hi)})
        sub = written(split_keys(own, length, gram), "suffix-sub-runs")
        least = sub.groupBy("key", "bytes").agg(
            F.min(_place()).alias("least"), F.count(F.lit(1)).alias("n"), F.min("left").alias("left"), F.min("lo").alias("lo"), F.min("hi").alias("hi")
        )
        least = written(least, "suffix-folded")
        again = least.filter("n > 1").select("key", "bytes", "least")
        late = sub.join(again, ["key", "bytes"]).filter(_place() > F.col("least"))
        spans.append(late.select("id", "tie", "start", (F.col("start") + F.octet_length("bytes")).cast("long").alias("end")))
        several = least.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
        entries = least.join(several, "key", "left_semi").select(
            F.col("least.id").alias("id"), F.col("least.tie").alias("tie"), "key", F.col("least.start").alias("start"), "bytes", "left", "lo", "hi"
        )
        entries = written(entries, "suffix-entries")
        hi = lo + (hi - lo) // 2  # the wider half


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> tuple[DataFrame, DataFrame]:
    """(documents: id, tie, text; spans: id, tie, start, end, not merged)."""
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    base = pick(docs, id=id_col, text=text_col).select("id", F.xxhash64("text").alias("tie"), text.alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    runs = written(dealt_runs(base, length, gram), "suffix-runs")
    entries = written(run_bytes(base, runs.filter("not late"), length), "suffix-entries")
    shards = max(1, math.ceil(entries.count() / SHARD_RUNS))
    calm, spans = calm_entries(entries, length, gram, hot)

    def shard_spans(t: pa.Table) -> pa.Table:
        ids, ties = t.column("id").to_pylist(), t.column("tie").to_pylist()
        keys = sorted(set(zip(ids, ties)), key=lambda k: (k[0] is not None, k[0] if k[0] is not None else 0, k[1]))
        rank_of = {k: i for i, k in enumerate(keys)}
        rows = list(
            zip(map(rank_of.__getitem__, zip(ids, ties)), t.column("key").to_pylist(), t.column("start").to_pylist(), t.column("bytes").to_pylist())
        )
        found = [(i, s, e) for i, spans in covered_in_shard(rows, length).items() for s, e in merge(spans)]
        return pa.table(
            {
                "id": pa.array([keys[i][0] for i, _, _ in found], t.schema.field("id").type),
                "tie": pa.array([keys[i][1] for i, _, _ in found], pa.int64()),
                "start": pa.array([s for _, s, _ in found], pa.int64()),
                "end": pa.array([e for _, _, e in found], pa.int64()),
            }
        )

    columns = ["id", "tie", "key", "start", "bytes"]
    dealt = functools.reduce(DataFrame.unionByName, [c.select(*columns) for c in calm])
    in_shards = dealt.groupBy(F.pmod("key", F.lit(shards)).alias("shard")).applyInArrow(
        shard_spans, f"id {id_type}, tie long, start long, end long"
    )
    start = F.shiftright("run", 16)
    end = start + F.col("run").bitwiseAND(F.lit(0xFFFF)) + length
    late = runs.filter("late").select("id", "tie", start.alias("start"), end.alias("end"))
    return base, functools.reduce(DataFrame.unionByName, [late, in_shards, *spans])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans [start, end) removed, kept (bytes)."""
    base, spans = repeated_spans(docs, id_col, text_col, **kw)
    own = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    id_type = base.schema["id"].dataType.simpleString()
    joined = base.alias("b").join(own.alias("o"), _same_document("b", "o"), "left").select("b.id", "b.text", "o.spans")

    def cut_out(batches):
        for batch in small(batches):
            removed, kept = [], []
            for raw, got in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                spans = merge([(s["start"], s["end"]) for s in got or ()])
                at, parts = 0, []
                for start, end in spans:
                    parts.append(raw[at:start])
                    at = end
                parts.append(raw[at:])
                removed.append([{"start": s, "end": e} for s, e in spans])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in batch.column(1).to_pylist()], pa.int64()), pa.array(removed, batch.schema.field(2).type), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    out = joined.mapInArrow(
        cut_out, f"doc_id {id_type}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary"
    )
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", n_removed.alias("n_removed"), "spans", "kept")
