"""Operator 2: n-gram Jaccard join with a prefix tree.

A document's set holds the hashes of its distinct ``SIZE``-word shingles.
Documents with equal sets are one class.  Two classes link when
100 * intersection >= THRESHOLD * union.

Candidates.  Linked sets of a and b shingles differ in 15 (a + b) / 115 of them
at most, d say.  All sets of about one size deal their shingles by hash over the
same parts, more than d of them; each differing shingle spoils one part, so of
any d + 1 parts one is the same in both.  A class sends the hash of its first
d + 1 parts that hold two shingles or more (one, in small sets), as (signature,
class) with the class as 64 bits; sets near the end of a size range also send
those of the next one.  Sets with fewer such parts try other deals, at last one
signature for all of them.  Classes of a signature are tied to the least of
them, first within a task, so a signature of very many classes sends one row a
task.  A shingle that many documents hold ties nothing by itself, whatever the
number of documents.  The connected components are the clusters, found without
naming pairs.

Join.  A cluster goes to one task, or, above a block's size, to tasks of two
blocks each.  A task orders its shingles by frequency, puts the sets into a
path-compressed prefix tree and walks it once for every set: overlaps add up
along shared prefixes, and a subtree is left when its lengths or the shingles
that remain cannot reach the threshold, or when all of it is connected
already.  Large clusters are joined in steps (within blocks; with the first
block; then, ordered by the components so far, the block pairs that are not of
one component), so one huge group of near copies does not cost all of its block
pairs.  Pairs go in rounds that ship about the texts of the large clusters
each.  Components of the links give the result.

Shingles are 64-bit hashes and classes 128-bit hashes of whole sets.

Defined cases: a null text, or one without words, has an empty set and is
alone; repeated rows and ids are in the class of their set; a null id is
returned and counts as larger than all other ids; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, small, written
from evseq.llm.components import connected_components

SIZE = 4
THRESHOLD = 85
RANGE = 1.6  # sizes of one deal: from lo to under RANGE * lo
PART = 3  # shingles a part holds in the smallest sets of a deal
DEALS = 8  # deals tried before the common signature
SENT_ROWS = 1 << 20  # rows in which a task ties equal signatures
BUFFER = 1 << 18  # bytes hashed at once, few enough for the cache
BLOCK_SETS = 2_000  # sets of one block of a cluster
BLOCK_SHINGLES = 1_500_000
MAX_BATCH = 256  # sets between two looks at what is connected by now
_BASE = 0xB5AD4ECEDA1CE2A9 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Shingle sets of whole texts: words `[^\\x20\\x09-\\x0D]+`, A-Z lowered."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.up = self.down = np.zeros(0, np.uint64)

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word; ``data`` ends with a separator."""
        if len(self.up) < len(data) + 1:
            self.up, self.down = _powers(_BASE, len(data) + 1), _powers(_INVERSE, len(data) + 1)
        space = _SPACE[data]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=prefix[1:])
        return starts, _mix((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def _word_hashes(self, raw: bytes) -> np.ndarray:
        """Word hashes of a text of any length, in pieces cut between words."""
        out, at = [], 0
        while at < len(raw):
            end = at + BUFFER
            while end < len(raw) and not _SPACE[raw[end - 1]]:
                end += 1
            out.append(self._words(np.frombuffer(raw[at:end] + b" ", np.uint8))[1])
            at = end
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def _set(self, words: np.ndarray) -> np.ndarray:
        k = min(self.size, len(words))
        if not k:
            return np.zeros(0, np.uint64)
        h = np.zeros(len(words) - k + 1, dtype=np.uint64)
        for j in range(k):
            h = (h ^ words[j : len(words) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return np.unique(_mix(h + np.uint64(k)))

    def sets(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        group: list[bytes] = []
        size = 0
        for text in texts:
            raw = (text or "").encode()
            if size and size + len(raw) > BUFFER:
                yield from self._group(group)
                group, size = [], 0
            group.append(raw)
            size += len(raw) + 1
        yield from self._group(group)

    def _group(self, group: list[bytes]) -> Iterator[np.ndarray]:
        if len(group) == 1:
            yield self._set(self._word_hashes(group[0]))
        elif group:
            starts, h = self._words(np.frombuffer(b" ".join(group) + b" ", np.uint8))
            ends = np.cumsum([len(raw) + 1 for raw in group])
            cut = np.searchsorted(starts, np.concatenate([[0], ends]))
            for a, b in zip(cut[:-1], cut[1:]):
                yield self._set(h[a:b])


def class_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def need(n: int, threshold: int = THRESHOLD) -> int:
    """Least overlap of a set of n with any set it links to."""
    return -(-threshold * n // 100)


def differing(n: np.ndarray, high: int, threshold: int = THRESHOLD) -> np.ndarray:
    """Most shingles not in both of a set of n and one of at most ``high`` it links to."""
    return (100 - threshold) * (n + np.minimum(high, 100 * n // threshold)) // (100 + threshold)


def size_ranges(largest: int) -> Iterator[tuple[int, int, int]]:
    """(number, lo, hi): ranges of sizes, as far as ``largest``."""
    lo = 1
    for number in itertools.count():
        if lo > largest:
            return
        hi = max(lo, math.ceil(lo * RANGE) - 1)
        yield number, lo, hi
        lo = hi + 1


def _deal(sizes, tokens, want, number: int, deal: int, parts: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the first ``want`` parts of each set that hold ``least``
    shingles, the set of each signature, and which sets have fewer of them."""
    h = _mix(tokens + np.uint64(2 * (number * DEALS + deal) + 1))
    cell = np.repeat(np.arange(len(sizes)) * parts, sizes)
    # the high bits alone choose the part: parts << 2**24
    cell += ((h >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
    cells = len(sizes) * parts
    full = np.bincount(cell, minlength=cells).reshape(-1, parts) >= least
    # float sums of 32-bit numbers are exact up to 2**21 of them
    h = _mix(h)
    low = np.bincount(cell, (h & np.uint64(0xFFFFFFFF)).astype(np.float64), cells)
    high = np.bincount(cell, (h >> np.uint64(32)).astype(np.float64), cells)
    place = np.arange(parts, dtype=np.uint64) + np.uint64((number * DEALS + deal) << 32)
    mark = (low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))).reshape(-1, parts)
    mark = _mix(mark + _mix(place))
    rank = np.cumsum(full, axis=1)
    sent = full & (rank <= want[:, None])
    return mark[sent], np.repeat(np.arange(len(sizes)), sent.sum(axis=1)), rank[:, -1] < want


def signatures(sets: list[np.ndarray], threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) rows; two sets that link have one in common."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    found, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if not len(sizes) or not sizes[-1]:
        return found[0], of[0]
    for number, lo, hi in size_ranges(100 * int(sizes[-1]) // threshold):
        # the sets of this range, and smaller ones that may link to them
        a, b = np.searchsorted(sizes, [max(1, need(lo, threshold)), hi + 1])
        if a == b:
            continue
        parts = max(1, round(lo / PART), int(differing(np.array([hi]), hi, threshold)[0]) + 1)
        least = 2 if lo > 4 * PART and lo >= 2 * parts else 1
        left = np.arange(a, b)
        for deal in range(DEALS):
            tokens = np.concatenate([sets[order[i]] for i in left])
            want = differing(sizes[left], hi, threshold) + 1
            mark, which, short = _deal(sizes[left], tokens, want, number, deal, parts, least)
            found.append(mark)
            of.append(order[left[which]])
            left = left[short]
            if not len(left):
                break
        found.append(np.full(len(left), _mix(np.uint64([number]))[0]))
        of.append(order[left])
    return np.concatenate(found), np.concatenate(of)


class PrefixTree:
    """Path-compressed tree of sorted rank sequences."""

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray, members: list[int]):
        self.edge: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.ends: list[list[int]] = []
        self.longest: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.group: list[int] = []  # the component of all sets below, or -1
        order = sorted(members, key=lambda i: sequences[i].tolist())
        seqs = [sequences[i] for i in order]
        todo = [(0, len(order), 0, -1)] if order else []
        while todo:
            lo, hi, depth, parent = todo.pop()
            a, b = seqs[lo], seqs[hi - 1]
            limit = min(len(a), len(b))
            differ = np.nonzero(a[depth:limit] != b[depth:limit])[0]
            end = depth + int(differ[0]) if len(differ) else limit
            me = len(self.edge)
            self.edge.append(a[depth:end])
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(me)
            i = lo
            while i < hi and len(seqs[i]) == end:
                i += 1
            self.ends.append(order[lo:i])
            lengths = [len(s) for s in seqs[lo:hi]]
            self.longest.append(max(lengths))
            own = sizes[order[lo:hi]]
            self.low.append(int(own.min()))
            self.high.append(int(own.max()))
            self.group.append(-1)
            while i < hi:
                j, token = i, seqs[i][end]
                while j < hi and seqs[j][end] == token:
                    j += 1
                todo.append((i, j, end, me))
                i = j

    def look_again(self, find) -> None:
        """Note the subtrees whose sets are all connected by now."""
        for me in range(len(self.edge) - 1, -1, -1):  # children come after their parent
            found = {find(i) for i in self.ends[me]} | {self.group[c] for c in self.children[me]}
            self.group[me] = found.pop() if len(found) == 1 else -1


def tree_links(
    sets: list[np.ndarray], component: list, left: list[int], right: list[int], threshold: int = THRESHOLD
) -> list[tuple[int, int]]:
    """Links between sets of ``left`` and ``right`` that join what is not yet
    connected (a spanning forest over the given components and all links)."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    parent: list[int] = list(range(len(sets)))
    first: dict = {}
    for i, c in enumerate(component):
        parent[i] = first.setdefault(c, i)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    tokens, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    rank = np.empty(len(tokens), dtype=np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(tokens))
    n_shared = int((count > 1).sum())  # ranks of shingles that two sets hold; the others cannot overlap
    ranks, bounds = rank[inverse], np.concatenate([[0], np.cumsum(sizes)])
    sequences = []
    for i in range(len(sets)):
        r = ranks[bounds[i] : bounds[i + 1]]
        sequences.append(np.sort(r[r < n_shared]))
    tree = PrefixTree(sequences, sizes, right)
    links: list[tuple[int, int]] = []
    mask = np.zeros(n_shared + 1, dtype=bool)
    both = left is right or left == right
    for turn, x in enumerate(left):
        if turn % MAX_BATCH == 0:
            tree.look_again(find)
        nx, seq = int(sizes[x]), sequences[x]
        if not nx or not tree.edge:
            continue
        mask[seq] = True
        lowest, highest = need(nx, threshold), 100 * nx // threshold
        todo = [(0, 0, 0)]
        while todo:
            me, depth, overlap = todo.pop()
            if tree.low[me] > highest or tree.high[me] < lowest or tree.longest[me] < depth:
                continue
            if tree.group[me] >= 0 and find(tree.group[me]) == find(x):
                continue
            edge = tree.edge[me]
            overlap += int(np.count_nonzero(mask[edge]))
            depth += len(edge)
            # shingles still to come, in the subtree and in x
            left_in_x = len(seq) - (int(np.searchsorted(seq, edge[-1], side="right")) if len(edge) else 0)
            least = -(-threshold * (nx + max(tree.low[me], lowest)) // (100 + threshold))
            if overlap + min(tree.longest[me] - depth, left_in_x) < least:
                continue
            for y in tree.ends[me]:
                if (both and y <= x) or find(x) == find(y):
                    continue
                if 100 * overlap >= threshold * (nx + int(sizes[y]) - overlap):
                    links.append((x, y))
                    parent[find(x)] = find(y)
            todo.extend((c, depth, overlap) for c in tree.children[me])
        mask[seq] = False
    return links


def _classes(base: DataFrame, size: int) -> DataFrame:
    """(id, n, node, key, ...): size and class of every row's set; key is 64 bits of the class."""
    id_type = base.schema["id"].dataType.simpleString()
    extra = base.columns[2:]

    def keys(batches):
        shingler = Shingler(size)
        for batch in small(batches):
            found = list(shingler.sets(batch.column(1).to_pylist()))
            nodes = [class_key(s) for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(nodes, pa.binary()), pa.array(short_keys(nodes)), *batch.columns[2:]],
                ["id", "n", "node", "key", *extra],
            )

    return base.mapInArrow(keys, ", ".join([f"id {id_type}, n long, node binary, key long", *[f"{c} binary" for c in extra]]))


def short_keys(nodes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in nodes), np.int64)


def tied(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows (signature, class) with one row a signature; its other classes
    are tied to that one by a signature that only the two have."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]])
    head = key[first][np.cumsum(first) - 1]
    pairs = np.unique(np.stack([head, key], axis=1)[head != key], axis=0)
    own = _mix(_mix(pairs[:, 0].view(np.uint64)) + pairs[:, 1].view(np.uint64))
    return np.concatenate([sig[first], own, own]), np.concatenate([key[first], pairs[:, 0], pairs[:, 1]])


def _sent(base: DataFrame, size: int, threshold: int) -> DataFrame:
    """(sig, key): the signatures that each class sends out."""

    def send(batches):
        shingler = Shingler(size)
        sigs, keys, rows, known = [], [], 0, set()

        def flush():
            sig, key = tied(np.concatenate(sigs), np.concatenate(keys))
            for at in range(0, len(sig), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(sig[part].view(np.int64)), pa.array(key[part])], ["sig", "key"])

        for batch in small(batches):
            sets, nodes = [], []
            for s in shingler.sets(batch.column(0).to_pylist()):
                node = class_key(s)
                if len(s) and node not in known:
                    known.add(node)
                    sets.append(s)
                    nodes.append(node)
            if not sets:
                continue
            sig, of = signatures(sets, threshold)
            sigs.append(sig)
            keys.append(short_keys(nodes)[of])
            rows += len(sig)
            if rows >= SENT_ROWS:
                yield from flush()
                sigs, keys, rows, known = [], [], 0, set()
        if rows:
            yield from flush()

    return base.select("text").mapInArrow(send, "sig long, key long")


def _meetings(sent: DataFrame) -> DataFrame:
    """(u, v): each class of a signature with the first one, in sorted rows as they come."""

    def meet(batches):
        last, head = None, None
        for batch in batches:
            sig, key = (batch.column(i).to_numpy() for i in range(2))
            if not len(sig):
                continue
            first = np.concatenate([[True], sig[1:] != sig[:-1]])
            heads = key[first]
            if sig[0] == last:
                heads[0] = head
            u = heads[np.cumsum(first) - 1]
            last, head = sig[-1], u[-1]
            pairs = np.unique(np.stack([u, key], axis=1)[u != key], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["u", "v"])

    return sent.repartition("sig").sortWithinPartitions("sig").mapInArrow(meet, "u long, v long")


def _join_blocks(tasks: DataFrame, size: int, threshold: int) -> DataFrame:
    """tasks: (cluster, i, j, side, node, component, text) -> links (u, v)."""

    def links(t: pa.Table) -> pa.Table:
        nodes, side = t.column("node").to_pylist(), t.column("side").to_pylist()
        sets = list(Shingler(size).sets(t.column("text").to_pylist()))
        left = [k for k, s in enumerate(side) if s == 0]
        right = [k for k, s in enumerate(side) if s == 1] or left
        found = tree_links(sets, t.column("component").to_pylist(), left, right, threshold)
        return pa.table(
            {
                "u": pa.array([nodes[a] for a, _ in found], pa.binary()),
                "v": pa.array([nodes[b] for _, b in found], pa.binary()),
            }
        )

    return tasks.groupBy("cluster", "i", "j").applyInArrow(links, "u binary, v binary")


def text_hash(text) -> F.Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    threshold: int = THRESHOLD,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
    hashed: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least id linked to); with
    ``hashed`` also text_md5, which tells rows that share an id apart."""
    base = pick(docs, id=id_col, text=text_col)
    extra = {"text_md5": text_hash(F.col("text"))} if hashed else {}
    classes = written(_classes(base.withColumns(extra), size), "ngram-classes")
    near = _meetings(_sent(base, size, threshold))
    clusters = connected_components(near, "ngram-clusters").toDF("key", "cluster")

    # one text of each class in a cluster
    members = classes.join(clusters, "key")
    one = members.groupBy("node").agg(F.min("id").alias("o_id"), F.first("cluster").alias("cluster"), F.first("n").alias("n"))
    one = written(one, "ngram-members")

    def blocks(total_sets, total_shingles):
        return F.ceil(F.greatest(total_sets / block_sets, total_shingles / block_shingles, F.lit(1.0))).cast("int")

    sizes = one.groupBy("cluster").agg(blocks(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
    # dealt by id at every size: a broadcast where the classes happen to be few
    # would hide what the texts take elsewhere
    of_class = base.join(one.join(sizes, "cluster").hint("merge"), F.col("id").eqNullSafe(F.col("o_id")))

    def same_class(batches):
        # an id that repeats may carry texts of other classes, and a row may repeat
        shingler, done = Shingler(size), set()
        for batch in small(batches):
            keys = [class_key(s) for s in shingler.sets(batch.column(0).to_pylist())]
            keep = []
            for key, node in zip(keys, batch.column(1).to_pylist()):
                keep.append(key == node and key not in done)
                if keep[-1]:
                    done.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))

    texts = of_class.select("text", "node", "cluster", "blocks", "n").mapInArrow(
        same_class, "text string, node binary, cluster long, blocks int, n long"
    )
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    placed = written(texts.select("node", "cluster", "blocks", block.alias("block"), "n", "text"), "ngram-texts")
    inside = placed.select("cluster", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"), "node", F.col("node").alias("component"), "text")
    links = written(_join_blocks(inside, size, threshold), "ngram-links")
    large = placed.filter("blocks > 1")
    if placed.agg(F.max("blocks")).first()[0] in (None, 1):
        components = connected_components(links, "ngram-part")
    else:
        # each block with the first
        pairs = F.when(
            F.col("block") == 0,
            F.transform(F.sequence(F.lit(1), F.col("blocks") - 1), lambda j: F.struct(j.alias("j"), F.lit(0).alias("side"))),
        ).otherwise(F.array(F.struct(F.col("block").alias("j"), F.lit(1).alias("side"))))
        tasks = large.select("cluster", F.lit(0).alias("i"), F.explode(pairs).alias("p"), "node", "text")
        tasks = tasks.select("cluster", "i", "p.*", "node", F.col("node").alias("component"), "text")
        links = links.unionByName(written(_join_blocks(tasks, size, threshold), "ngram-first"))
        components = connected_components(links, "ngram-part")
        for more in _second_step(large, components, size, threshold, block_sets):
            links = links.unionByName(more)
        components = connected_components(links, "ngram-all")
    labelled = classes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    linked = labelled.filter("n > 0").join(least, "component")
    alone = labelled.filter("n = 0").withColumn("component_id", F.col("id"))
    cols = ["id", "n", "component_id", *extra]
    return linked.select(cols).unionByName(alone.select(cols)).toDF("doc_id", "n_shingles", "component_id", *extra)


def _second_step(large: DataFrame, components: DataFrame, size: int, threshold: int, block_sets: int) -> Iterator[DataFrame]:
    """Links between blocks of large clusters, blocks being cut anew so that
    most hold one component; pairs of blocks of the same component are done.
    The pairs go in rounds, each of which ships about twice the sets there are."""
    narrow = large.select("cluster", "node", "blocks", "n").join(components, "node", "left")
    narrow = written(narrow.withColumn("component", F.coalesce("component", "node")), "ngram-large")
    per = narrow.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"), F.first("blocks").alias("blocks"))
    # components as large as a block get blocks of their own; the others are mixed by hash
    own = F.col("k") >= block_sets // 2
    per = per.withColumn("own", own).withColumn("parts", F.when(own, F.ceil(F.col("k") / block_sets)).otherwise(F.col("blocks")).cast("int"))
    part = F.pmod(F.when(F.col("own"), F.xxhash64("node")).otherwise(F.xxhash64("component")), "parts").cast("int")
    label = F.when(F.col("own"), F.concat_ws("/", F.hex("component"), part.cast("string"))).otherwise(
        F.concat_ws("/", F.lit("~mixed"), part.cast("string"))
    )
    marked = narrow.join(per.select("cluster", "component", "own", "parts"), ["cluster", "component"])
    marked = marked.select("cluster", "node", "component", "own", label.alias("label"))
    cut = written(large.select("node", "text").join(marked, "node"), "ngram-second")
    names = cut.groupBy("cluster", "label").agg(F.first("own").alias("own"), F.first("component").alias("c"), F.count(F.lit(1)).alias("k"))
    names = written(names, "ngram-names")
    a = names.select("cluster", F.col("label").alias("i"), F.col("own").alias("own_i"), F.col("c").alias("c_i"), F.col("k").alias("k_i"))
    b = names.select("cluster", F.col("label").alias("j"), F.col("own").alias("own_j"), F.col("c").alias("c_j"), F.col("k").alias("k_j"))
    # pairs of block names of one cluster, never of documents
    pairs = a.join(b, "cluster").filter("i <= j and not (own_i and own_j and c_i = c_j)")
    pairs = written(pairs.select("cluster", "i", "j", F.expr("k_i + if(i < j, k_j, 0)").alias("k")), "ngram-pairs")
    shipped, held = pairs.agg(F.sum("k")).first()[0] or 0, names.agg(F.sum("k")).first()[0] or 0
    rounds = -(-shipped // max(1, 2 * held))
    turn = F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(max(1, rounds)))
    cols = ["cluster", "i", "j", "side", "node", "component", "text"]
    for k in range(rounds):
        now = pairs.filter(turn == k).select("cluster", "i", "j")
        lefts = cut.withColumn("i", F.col("label")).join(now, ["cluster", "i"]).withColumn("side", F.lit(0))
        rights = cut.withColumn("j", F.col("label")).join(now.filter("i <> j"), ["cluster", "j"]).withColumn("side", F.lit(1))
        yield written(_join_blocks(lefts.select(cols).unionByName(rights.select(cols)), size, threshold), "ngram-second-links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of each component stays (its least id), all columns as they
    were; of rows that share an id only those with a linked text go.  Rows
    without an id stay."""
    names = docs.columns
    at, text = names.index(id_col), names.index(text_col)
    found = near_duplicates(docs, id_col, text_col, hashed=True, **kw)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone"), "text_md5").distinct()
    renamed = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    same = (F.col(f"__c{at}") == F.col("__gone")) & (text_hash(F.col(f"__c{text}")) == F.col("text_md5"))
    return renamed.join(gone, same, "left_anti").toDF(*names)
