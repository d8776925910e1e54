"""Operator 10: SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

The escaped text falls into marked words (a run of the space mark and what
follows it); no piece of the vocabulary reaches across their borders, which is
checked when the vocabulary is read.  The distinct new words of a batch are
sorted, which is the depth-first order of their trie; a stack holds the
forward state of the current path, so a common prefix is computed once.  The
pieces that may end a prefix are found by one step from those of the prefix
before: by the longest part of any piece that ends it.

The vocabulary is of the merge kind.  The best path by added piece scores is
not what such a model means (its scores are ranks of merges), so the forward
state of a prefix is the piece that ends the prefix's encoding: the one ending
there whose pair with the piece before it is left alone by the merges.  There
is exactly one, since a row of pieces is the encoding of a text if and only if
each adjacent pair is the encoding of its own text.  Following the states back
gives the ids of the library's ``encode``.  Characters outside the vocabulary
stand alone and become byte pieces.

Defined cases: null and empty texts have no pieces and decode to the empty
text; a text holding the space mark itself decodes with a space in its place,
as in the library; repeated rows are coded alike; an empty table gives no rows;
``encode_decode`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, positional

MARK = "▁"  # the escaped space
MARKS = (" ", MARK)
CACHE_WORDS = 600_000  # in two halves; about 150 MB a worker
MOST_KNOWN = 500_000  # steps and pairs
PIECE = 1 << 20  # characters split into words at once


class Vocabulary:
    """Pieces, scores and byte pieces of a model file's content."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.raw: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.raw.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.raw.append(piece.encode())
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece reaches across words")
        #: every part of a piece: the longest that ends a text is a state of the walk
        self.parts = {p[i:j] for p in self.ids for i in range(len(p)) for j in range(i + 1, len(p) + 1)}
        self.whole = {p for p in self.ids if self.merge(p) == [p]}
        self.steps: dict[str, tuple[str, tuple]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.known = 0  # steps and pairs remembered
        chars = set("".join(self.ids))
        # a line end outside the vocabulary stands alone, so it may part words too
        part = f" {MARK}" if "\n" in chars else f" {MARK}\n"
        alone = "" if "\n" in chars else "|\n"
        self.words = re.compile(f"[ {MARK}]*[^{part}]+|[ {MARK}]+{alone}")
        self.code = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by the merges themselves: the best pair first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def alone(self, char: str) -> bytes:
        """Ids of a character outside the vocabulary: its bytes' pieces."""
        return b"".join(self.byte_ids[b].to_bytes(4, "little") for b in char.encode())

    def step(self, moved: str) -> tuple[str, tuple]:
        """For a state with the next character: the new state, and the pieces
        that end it, longest first, each with its length and the pieces before
        it that are known to stay or not."""
        found = self.steps.get(moved)
        if found is None:
            self._count()
            state = moved
            while state and state not in self.parts:
                state = state[1:]
            ending = [state[i:] for i in range(len(state)) if state[i:] in self.whole]
            found = self.steps[moved] = (state, tuple((len(p), p, self.pairs.setdefault(p, {})) for p in ending))
        return found

    def stays(self, left: str, right: str) -> bool:
        """Whether the merges leave the two pieces side by side."""
        self._count()
        known = self.pairs[right][left] = self.merge(left + right) == [left, right]
        return known

    def _count(self) -> None:
        self.known += 1
        if self.known > MOST_KNOWN:
            self.known = 0
            self.steps.clear()
            for before in self.pairs.values():
                before.clear()


class Codec:
    """Encoder and decoder; words met before are remembered, up to a bound."""

    def __init__(self, model: bytes):
        self.vocabulary = Vocabulary(model)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the cache before, whose words move over when met again

    def _encode_words(self, words: Iterable[str]) -> None:
        """Depth-first over the trie of the words (their sorted order)."""
        v = self.vocabulary
        steps, step, stays, code = v.steps, v.step, v.stays, v.code
        path = ""
        last: list[str] = [""]  # last[i]: the piece that ends the encoding of path[:i]
        states: list[str] = [""]  # states[i]: the longest part of a piece that ends path[:i]
        for text in sorted(words):
            word = text.replace(" ", MARK)
            keep, limit = 0, min(len(path), len(word))
            while keep < limit and path[keep] == word[keep]:
                keep += 1
            del last[keep + 1 :], states[keep + 1 :]
            state = states[keep]
            for end in range(keep + 1, len(word) + 1):
                found = word[end - 1]  # a character outside the vocabulary stands alone
                state, ending = steps.get(state + found) or step(state + found)
                for size, piece, pairs in ending:
                    before = last[end - size]
                    if not before or pairs.get(before) or (before not in pairs and stays(before, piece)):
                        found = piece
                        break
                last.append(found)
                states.append(state)
            path = word
            parts, end = [], len(word)
            while end:
                piece = last[end]
                parts.append(code.get(piece) or v.alone(piece))
                end -= len(piece)
            parts.reverse()
            self.cache[text] = b"".join(parts)

    def _remember(self, met: set[str]) -> None:
        """Bring all words into the cache."""
        if len(self.cache) > CACHE_WORDS // 2:
            self.older, self.cache = self.cache, {}
        new = met.difference(self.cache)
        known = {w: self.older[w] for w in new if w in self.older}
        self.cache.update(known)
        new.difference_update(known)
        self._encode_words(new)

    def _code(self, words: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, words))

    def _encode_long(self, text: str) -> bytes:
        """Ids of a text piece by piece."""
        parts: list[bytes] = []
        at = 0
        while at < len(text):
            # cut before a mark that ends a word
            end = at + PIECE
            while end < len(text) and not (text[end] in MARKS and text[end - 1] not in MARKS):
                end += 1
            words = self.vocabulary.words.findall(text[at:end])
            self._remember(set(words))
            parts.append(self._code(words))
            at = end
        return b"".join(parts)

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each whole text; the new words of short ones are sorted together."""
        texts = [" " + t if t else "" for t in texts]
        words = {i: self.vocabulary.words.findall(t) for i, t in enumerate(texts) if len(t) <= PIECE}
        self._remember(set().union(*words.values()))
        coded = {i: self._code(own) for i, own in words.items()}
        out = (coded[i] if i in coded else self._encode_long(t) for i, t in enumerate(texts))
        return [np.frombuffer(ids, "<u4") for ids in out]

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.vocabulary.raw.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").replace(MARK, " ")[1:]


@lru_cache(maxsize=2)
def _codec(model: bytes) -> Codec:
    return Codec(model)  # one for a worker, with its words


def _groups(texts: list[str | None], size: int = PIECE):
    """Index ranges of texts of about ``size`` characters, so that new words are sorted together."""
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_batch(codec: Codec, texts: list[str | None]) -> list[np.ndarray]:
    return [ids for a, b in _groups(texts) for ids in codec.encode_all(texts[a:b])]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:  # on the driver; the content (under 1 MB) is broadcast
        return f.read()


def encode_decode(
    docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str = "decoded"
) -> DataFrame:
    """``docs`` plus the piece ids and the text decoded from them."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    renamed, names = positional(docs, text=text_col)
    out = renamed.withColumns({"__ids": F.lit(None).cast("array<int>"), "__decoded": F.lit(None).cast("string")})

    def code(batches):
        codec = _codec(model.value)
        for whole in batches:
            column = whole.schema.get_field_index("__text")
            for a, b in _groups(whole.column(column).to_pylist(), 4 * PIECE):
                batch = whole.slice(a, b - a)
                ids = encode_batch(codec, batch.column(column).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                coded = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                k = batch.schema.get_field_index("__ids")
                batch = batch.set_column(k, batch.schema.field(k), coded.cast(batch.schema.field(k).type))
                k = batch.schema.get_field_index("__decoded")
                yield batch.set_column(k, batch.schema.field(k), pa.array([codec.decode(i) for i in ids], pa.string()))

    return out.mapInArrow(code, out.schema).toDF(*names, ids_col, decoded_col)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_pieces, ids_crc32, decoded_sha256, exact (decoded
    text equals the text), made in one pass without sending the ids through Spark."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    base = pick(docs, doc_id=id_col, text=text_col)

    def code(batches):
        codec = _codec(model.value)
        for batch in batches:
            rows = {"n_pieces": [], "ids_crc32": [], "decoded_sha256": [], "exact": []}
            texts = batch.column(1).to_pylist()
            for a, b in _groups(texts):
                for text, ids in zip(texts[a:b], encode_batch(codec, texts[a:b])):
                    decoded = codec.decode(ids)
                    rows["n_pieces"].append(len(ids))
                    rows["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    rows["exact"].append(decoded == (text or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows["n_pieces"], pa.int64()), pa.array(rows["ids_crc32"], pa.int64()), pa.array(rows["decoded_sha256"], pa.string()), pa.array(rows["exact"], pa.bool_())],
                ["doc_id", *rows],
            )

    id_type = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(code, f"doc_id {id_type}, n_pieces long, ids_crc32 long, decoded_sha256 string, exact boolean")
