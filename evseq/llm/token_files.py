"""Operator 3: token ids in compressed binary files.

Documents are sorted by id over range partitions; each task tokenizes whole
texts, ends each with ``END_ID`` and writes packs of whole documents.  A pack is
one Parquet row, so files are committed by Spark and a lost executor costs one
task:

    part, pack     place in the order of ids
    doc_ids        ids of the pack's documents
    n_ids          number of token ids
    payload        magic 'CMR3', u32 documents, u32 blocks, u64 token ids, u32
                   symbols, u32 bytes of the symbols' table, u32 token ids of
                   each document, then for each block u32 bytes, u32 crc32 and
                   u32 symbols, then the table, then the blocks of
                   ``range_coder``

What is coded are symbols: the token ids of the pack, and the phrases (the ids
of a word or of the marks behind it) that occur ``LEAST`` times or more in it,
the commonest first.  A phrase goes as one symbol; all others go id by id.  The
table (zlib) holds the token ids of each symbol as u32 and, for those of one id,
the ids as u16; the stream of symbols starts with the spelling of the phrases.
So a block is coded on its own, and read with the table and those first symbols.

Token ids must fit 16 bits.  A text is split before white space that follows
other characters, where no token of a byte-level vocabulary of this kind can
reach across, and a word from the marks behind it.  Each distinct part goes to
the tokenizer once while it is remembered, many at once as lines of a text; a
text with the separators 1C to 1F goes to it whole.

Reading needs one small aggregate: the number of ids in each part gives where
every pack starts.

Defined cases: null and empty texts are one end id; null ids come first;
documents that share an id are ordered by a hash of the text; repeated rows
are kept; an empty table writes no packs; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evseq.llm import range_coder
from evseq.llm.common import pick
from evseq.session import shared_dir

END_ID = 2
PACK_IDS = 1 << 24
PART_BYTES = 32 << 20  # text of a range partition
MOST_PARTS = 20_000  # from there on the partitions grow
MOST_PHRASES = 500_000  # different ones of a pack, which ends there
MOST_SPELLED = 1 << 22  # or where these have so many ids
LEAST = 3  # times that a phrase of several ids occurs to be a symbol
SYMBOLS = 1 << 16
CACHE_CHUNKS = 500_000  # in two halves
TOGETHER = 250  # chunks to a call of the tokenizer
GROUP_BYTES = 8 << 20
SLICE = 1 << 20  # of an array that is spelled out
MAGIC = b"CMR3"
HEAD = struct.Struct("<4sIIQII")
#: white space but the blank
SPACE = "\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+")
#: separators that are white space to some only
ODD_SPACE = r"[\x1c-\x1f]"
#: texts in which white space holds a blank other than its last character
BLANKS = f"^ |  | $| [{SPACE}]"
#: a token that starts with a letter goes on only with letters
MARKS = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])"
CUT = "\x1e"  # one of the odd separators


class Encoder:
    """Token ids of whole texts as little-endian 16-bit bytes."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("token ids do not fit 16 bits")
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.apart = "|".join([BLANKS, *added])
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the cache before, whose chunks move over when met again
        line = self._tokenize(["\n"])[0]
        self.line = int.from_bytes(line, "little") if len(line) == 2 else None

    def _tokenize(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u2").tobytes() for e in got]

    def _tokenize_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without line ends or blanks but one in front: as lines
        of one text, since a line end before them is a token of its own."""
        raw = self._tokenize(["\n".join(chunks)])[0]
        ends = 2 * np.flatnonzero(np.frombuffer(raw, "<u2") == self.line)
        if len(ends) != len(chunks) - 1:
            return self._tokenize(chunks)
        return [raw[a:b] for a, b in zip([0, *(ends + 2).tolist()], [*ends.tolist(), len(raw)])]

    def _remember(self, met: set[str]) -> None:
        """Bring the chunks into the cache."""
        if len(self.cache) > CACHE_CHUNKS // 2:
            self.older, self.cache = self.cache, {}
        new = met.difference(self.cache)
        known = {c: self.older[c] for c in new if c in self.older}
        self.cache.update(known)
        new.difference_update(known)
        lines, rest = [], []
        for c in new:
            first = c[1:2] if c[:1] == " " else c[:1]
            (rest if self.line is None or not first or first.isspace() else lines).append(c)
        for some, tokenize in ((lines, self._tokenize_chunks), (rest, self._tokenize)):
            for at in range(0, len(some), TOGETHER):
                part = some[at : at + TOGETHER]
                self.cache.update(zip(part, tokenize(part)))

    def cut(self, texts: pa.Array) -> tuple[list[np.ndarray], list[str], list[str]]:
        """Of each text the numbers of its chunks, the different chunks, and
        after them in number the texts that are not cut."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd, apart = pc.match_substring_regex(texts, ODD_SPACE), pc.match_substring_regex(texts, self.apart)
        plain = pc.if_else(pc.or_(odd, apart), "", texts)
        plain = pc.replace_substring_regex(pc.replace_substring(plain, " ", CUT + " "), f"[{SPACE}]+", CUT + r"\0")
        parts = pc.split_pattern(pc.replace_substring_regex(plain, MARKS, r"\1" + CUT + r"\2"), CUT)
        coded = parts.flatten().dictionary_encode()
        own = np.split(coded.indices.to_numpy(), parts.offsets.to_numpy()[1:-1])
        words = coded.dictionary.cast(pa.string())
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), CUT)
        chunks = joined[0].as_py().split(CUT)
        apart = pc.indices_nonzero(pc.and_not(apart, odd)).to_pylist()
        if apart:
            numbers = {c: k for k, c in enumerate(chunks)}
            for i in apart:
                own[i] = np.array([numbers.setdefault(c, len(numbers)) for c in CHUNK.findall(texts[i].as_py())], dtype=np.int32)
            chunks = list(numbers)
        whole: dict[str, int] = {}
        for i in pc.indices_nonzero(odd).to_pylist():
            own[i] = np.array([whole.setdefault(texts[i].as_py(), len(chunks) + len(whole))], dtype=np.int32)
        return own, chunks, list(whole)

    def ids(self, chunks: list[str], whole: list[str]) -> list[bytes]:
        self._remember(set(chunks))
        return [*map(self.cache.__getitem__, chunks), *(self._tokenize([text])[0] for text in whole)]

    def encode(self, texts: list[str]) -> list[bytes]:
        own, chunks, whole = self.cut(pa.array(texts, pa.string()))
        ids, end = self.ids(chunks, whole), END_ID.to_bytes(2, "little")
        return [b"".join([*map(ids.__getitem__, numbers.tolist()), end]) for numbers in own]


@lru_cache(maxsize=1)
def _encoder(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


def _spelled(flat: np.ndarray, size: np.ndarray, at: np.ndarray, begin: np.ndarray | None = None) -> np.ndarray:
    """Entries ``at`` of a table one after the other; entry k is ``size[k]`` values of ``flat``."""
    begin = np.cumsum(size) - size if begin is None else begin
    parts = [flat[:0]]
    for k in range(0, len(at), SLICE):
        some = at[k : k + SLICE]
        n = size[some]
        ends = np.cumsum(n)
        place = np.repeat(begin[some] - ends + n, n)
        place += np.arange(len(place))
        parts.append(flat[place])
    return np.concatenate(parts)


class Pack:
    """Documents on their way into a payload: numbers of phrases in order of appearance."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.numbers: dict[str, int] = {}
        self.phrases = [END_ID.to_bytes(2, "little")]  # token ids by number
        self.sizes = np.ones(1, dtype=np.int64)
        self.stream: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.n_ids = self.n_spelled = 0

    def add(self, texts: pa.Array) -> None:
        own, chunks, whole = self.encoder.cut(texts)
        every = chunks + whole
        number = np.fromiter(map(self.numbers.get, every, repeat(-1)), np.int32, len(every))
        fresh = np.flatnonzero(number < 0)
        number[fresh] = np.arange(len(self.phrases), len(self.phrases) + len(fresh))
        n_chunks = int(np.searchsorted(fresh, len(chunks)))
        new = [every[k] for k in fresh.tolist()]
        ids = self.encoder.ids(new[:n_chunks], new[n_chunks:])
        self.numbers.update(zip(new[:n_chunks], number[fresh].tolist()))
        self.phrases += ids
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int64, len(ids)) // 2])
        self.n_spelled += sum(map(len, ids)) // 2
        number = np.append(number, np.int32(0))  # the end
        end = np.array([len(every)], dtype=np.int32)
        stream = number[np.concatenate([a for some in own for a in (some, end)])]
        starts = np.cumsum([0] + [len(a) + 1 for a in own[:-1]])
        self.stream.append(stream)
        self.lengths.append(np.add.reduceat(self.sizes[stream], starts))
        self.n_ids += int(self.lengths[-1].sum())

    def full(self) -> bool:
        return self.n_ids >= PACK_IDS or len(self.phrases) >= MOST_PHRASES or self.n_spelled >= MOST_SPELLED

    def payload(self) -> bytes:
        """The pack's bytes; no texts can follow."""
        lengths = np.concatenate(self.lengths).astype("<u4")
        sizes, table, stream = self._symbols()
        blocks = range_coder.encode(stream)
        places = np.array([(len(b), crc, n) for b, crc, n in blocks], dtype="<u4").reshape(-1, 3)
        table = zlib.compress(sizes.astype("<u4").tobytes() + table.astype("<u2").tobytes(), 1)
        head = HEAD.pack(MAGIC, len(lengths), len(blocks), self.n_ids, len(sizes), len(table))
        return b"".join([head, lengths.tobytes(), places.tobytes(), table, *(b for b, _, _ in blocks)])

    def _symbols(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many ids each symbol has, those of one id, and the stream."""
        sequence, size = np.concatenate(self.stream), self.sizes.copy()
        flat = np.frombuffer(b"".join(self.phrases), "<u2").astype(np.int64)
        self.numbers, self.phrases, self.stream = {}, [], []  # room for the coder
        count, begin = np.bincount(sequence, minlength=len(size)), np.cumsum(size) - size
        ids = np.flatnonzero(np.bincount(flat, minlength=SYMBOLS))
        room = SYMBOLS - len(ids)
        # phrases that save most beyond pairs
        own = np.flatnonzero((size > 2) & (count >= LEAST))
        own = own[np.argsort(-count[own] * ((size[own] - 1) // 2), kind="stable")[: room // 2]]
        times = count.copy()
        times[own] = 0
        times = np.repeat(times, size)
        inside = np.arange(len(flat)) - np.repeat(begin, size)
        two = np.flatnonzero((inside % 2 == 0) & (inside + 1 < np.repeat(size, size)) & (times > 0))
        pairs, which = np.unique(flat[two] << 16 | flat[two + 1], return_inverse=True)
        often = np.bincount(which, times[two], len(pairs)).astype(np.int64)
        best = np.flatnonzero(often >= LEAST)
        best = best[np.argsort(-often[best], kind="stable")[: room - len(own)]]
        place = np.full(len(pairs), -1)
        place[best] = np.arange(len(best))
        two, which = two[place[which] >= 0], place[which[place[which] >= 0]]
        kept = np.ones(len(flat), dtype=bool)
        kept[two + 1] = False
        times[two] = 0
        # symbols in order of their counts
        single = np.bincount(flat, times * kept, SYMBOLS)[ids].astype(np.int64)
        entries = np.concatenate([single, often[best], count[own]])
        order = np.argsort(-entries, kind="stable")
        symbol = np.empty(len(order), dtype=np.uint16)
        symbol[order] = np.arange(len(order))
        of_id = np.zeros(SYMBOLS, dtype=np.uint16)
        of_id[ids] = symbol[: len(ids)]
        of_pair, of_phrase = symbol[len(ids) : len(ids) + len(best)], symbol[len(ids) + len(best) :]
        # ids of each symbol, and the symbols of each phrase
        spelling = of_id[np.concatenate([ids, np.stack([pairs[best] >> 16, pairs[best] & 0xFFFF], 1).ravel(), flat])]
        sizes = np.concatenate([np.ones(len(ids), dtype=np.int64), np.full(len(best), 2), size[own]])
        from_ = np.concatenate([np.arange(len(ids)), len(ids) + 2 * np.arange(len(best)), len(ids) + 2 * len(best) + begin[own]])
        first = _spelled(spelling, sizes, order[sizes[order] > 1], from_)
        coded = of_id[flat]
        coded[two] = of_pair[which]
        ends = np.concatenate([[0], np.cumsum(kept)])
        size, begin = ends[begin + size] - ends[begin], ends[begin]
        size[own], begin[own] = 1, ends[-1] + np.arange(len(own))
        rest = _spelled(np.concatenate([coded[kept], of_phrase]), size, sequence, begin)
        return sizes[order], ids[order[order < len(ids)]], np.concatenate([first, rest])


def read_payload(payload: bytes) -> list[np.ndarray]:
    """Token ids of each document of a pack; checks all checksums."""
    if payload[:4] != MAGIC:
        raise ValueError("not a pack of token ids")
    _, n_docs, n_blocks, n_ids, n_symbols, n_table = HEAD.unpack_from(payload)
    at = HEAD.size
    lengths = np.frombuffer(payload, "<u4", n_docs, at)
    at += 4 * n_docs
    places = np.frombuffer(payload, "<u4", 3 * n_blocks, at).reshape(-1, 3)
    at += 12 * n_blocks
    try:
        table = zlib.decompress(payload[at : at + n_table])
    except zlib.error as e:
        raise ValueError("a pack's table is damaged") from e
    at += n_table
    blocks = []
    for size, crc, n in places.tolist():
        blocks.append((payload[at : at + size], crc, n))
        at += size
    stream = np.concatenate([np.zeros(0, np.uint16), *range_coder.decode(blocks)])
    sizes = np.frombuffer(table, "<u4", n_symbols).astype(np.int64)
    alone = sizes == 1
    by_symbol = np.zeros(n_symbols, dtype=np.uint16)
    by_symbol[alone] = np.frombuffer(table, "<u2", offset=4 * n_symbols)
    n_first = int(sizes[~alone].sum())
    flat = np.empty(int(sizes.sum()), dtype=np.uint16)
    one = np.repeat(alone, sizes)
    flat[one], flat[~one] = by_symbol[alone], by_symbol[stream[:n_first]]
    ids = _spelled(flat, sizes, stream[n_first:])
    if len(ids) != n_ids or lengths.sum() != n_ids:
        raise ValueError("a pack's lengths do not add up")
    ends = np.cumsum(lengths.astype(np.int64))
    return np.split(ids, ends[:-1])


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of some ``GROUP_BYTES`` of text, one document at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(), dtype=np.int64)
    start = done = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, done + GROUP_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    base = pick(docs, id=id_col, text=text_col)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, min(math.ceil(size / PART_BYTES), MOST_PARTS))
    ordered = base.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")
    shared = base.sparkSession.sparkContext.broadcast(tokenizer_json)
    id_type = base.schema["id"].dataType.simpleString()

    def pack(batches):
        encoder, part, number = _encoder(shared.value), TaskContext.get().partitionId(), 0
        ids: list = []
        packed = Pack(encoder)

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([[x for a in ids for x in a.to_pylist()]], pa.list_(ids[0].type)), pa.array([packed.n_ids], pa.int64()), pa.array([packed.payload()], pa.binary())],
                ["part", "pack", "doc_ids", "n_ids", "payload"],
            )

        for batch in batches:
            for some in _groups(batch):
                ids.append(some.column(0))
                packed.add(some.column(1))
                if packed.full():
                    yield row()
                    ids, packed, number = [], Pack(encoder), number + 1
        if ids:
            yield row()

    schema = f"part int, pack int, doc_ids array<{id_type}>, n_ids long, payload binary"
    ordered.select("id", "text").mapInArrow(pack, schema).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The packs with the number of ids before each."""
    packs = spark.read.parquet(path)
    sizes = packs.select("part", "pack", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row a part, at most MOST_PARTS
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("pack").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("part", "pack", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside"))
    starts = places.join(offsets, "part").select("part", "pack", (F.col("part_start") + F.col("inside")).alias("start"))
    return packs.join(starts, ["part", "pack"]).select("start", "doc_ids", "payload")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document: doc_id, start, and ids or, as a digest of them, n_tokens
    and ids_crc32 (over little-endian 32-bit integers)."""
    packs = _placed(spark, path)
    id_type = packs.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                documents = read_payload(batch.column(2)[i].as_py())
                sizes = np.array([len(d) for d in documents], dtype=np.int64)
                starts = batch.column(0)[i].as_py() + np.cumsum(sizes) - sizes
                columns = [batch.column(1)[i].values, pa.array(starts)]
                if digest:
                    crc = [zlib.crc32(d.astype("<u4").tobytes()) for d in documents]
                    columns += [pa.array(sizes), pa.array(crc, pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                else:
                    columns.append(pa.array([d.astype(np.int32) for d in documents], pa.list_(pa.int32())))
                    names = ["doc_id", "start", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rest = "n_tokens long, ids_crc32 long" if digest else "ids array<int>"
    return packs.mapInArrow(unpack, f"doc_id {id_type}, start long, {rest}")


def token_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents' token files to the shared folder and read them back."""
    with open(tokenizer_path, encoding="utf-8") as f:  # under 2 MB, on the driver; broadcast to the tasks
        tokenizer_json = f.read()
    path = shared_dir(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer_json, id_col, text_col)
    return read_tokens(docs.sparkSession, path, digest=True)
