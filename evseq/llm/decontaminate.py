"""Operator 1: benchmark decontamination by Wu-Manber multi-pattern search.

The symbols are words.  The windows of the benchmark (10 consecutive words, or
a whole shorter item) are grouped by length m.  For each m a table of two-word
blocks gives how far the search may move on, buckets keyed by the last block
name the windows that can end here, and a direct comparison confirms them.  In
clean text most blocks are in no window, so the search looks at one word in
m - 1 only.

Windows are dealt into blocks of at most ``BLOCK_BYTES`` bytes; each block is
collected, broadcast and searched in a streaming pass over all documents, so
neither the driver nor a task holds more than one block.  There is no shuffle
of documents and no row limit.

Defined cases: a null or wordless text has no words and no hits; a null or
wordless item has no windows; items with a null id keep their windows under
the id ''; equal item ids are one item; repeated documents are searched one by
one; an empty benchmark gives no hits; an empty table gives no rows; other
columns, whatever their names, are ignored (``annotate`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evseq.llm.common import pick, positional, written

WINDOW = 10
BLOCK_BYTES = 16 << 20  # windows collected and broadcast at once
PIECE_BYTES = 1 << 20  # text turned into a word list at once
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: a-z, 0-9 and every byte of a non-ASCII character stay; A-Z is lowered; the rest separates
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
HIT_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(item, window): the distinct windows of every item, words joined by a space."""
    words = F.split(F.translate("text", UPPER, LOWER), NON_WORD)
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    return (
        pick(benchmark, item=item_col, text=text_col)
        .select(
            F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"),
            F.filter(words, lambda w: w != "").alias("words"),
        )
        .filter(n > 0)
        .select("item", F.explode(F.transform(starts, lambda s: F.array_join(F.slice("words", s, size), " "))).alias("window"))
        .distinct()
    )


class WuManber:
    """Search for word windows of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.length, self.patterns = length, patterns
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[bytes, ...]]]] = {}
        for p in patterns:
            for end in range(self.block, length + 1):
                key = b" ".join(p[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets.setdefault(key, {}).setdefault(p[0], []).append(p)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(start, window) of every occurrence, overlapping ones too."""
        m, get, default, two = self.length, self.shift.get, self.default, self.block == 2
        i, n = m - 1, len(words)
        while i < n:
            key = words[i - 1] + b" " + words[i] if two else words[i]
            step = get(key, default)
            if step:
                i += step
                continue
            start = i - m + 1
            for p in self.buckets[key].get(words[start], ()):
                if tuple(words[start : i + 1]) == p:
                    yield start, p
            i += 1


class Searcher:
    """All lengths of one block of windows."""

    def __init__(self, rows: Iterable[tuple[str, str]]):
        by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
        for item, window in rows:
            p = tuple(window.encode().split(b" "))
            by_length.setdefault(len(p), {}).setdefault(p, []).append(item)
        self.machines = [WuManber(p, m) for m, p in sorted(by_length.items())]
        self.longest = max(by_length, default=1)

    def search(self, text: str | None) -> tuple[int, list[list[int]], set[str]]:
        """Word count, merged hit spans [start, end) in words, item ids."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        carry: list[bytes] = []
        before = 0  # words ahead of carry
        raw = (text or "").encode().translate(_TO_WORDS)
        at = 0
        while at < len(raw):
            end = raw.find(b" ", at + PIECE_BYTES) if len(raw) - at > PIECE_BYTES else -1
            end = len(raw) if end < 0 else end
            words = carry + raw[at:end].split()
            for machine in self.machines:
                for start, p in machine.find(words):
                    found.append((before + start, before + start + machine.length))
                    items.update(machine.patterns[p])
            keep = min(len(words), self.longest - 1)
            before += len(words) - keep
            carry = words[len(words) - keep :]
            at = end
        return before + len(carry), merge_spans(found), items


def merge_spans(spans: Iterable[Iterable[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def in_block(n_blocks: int) -> Column:
    """Block of a row of ``windows``: by window and item, as many items may share a window."""
    return F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks))


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    out_col: str = "contamination",
) -> DataFrame:
    """``docs`` plus a struct: n_words, spans (hit word ranges [start, end)),
    items (ids of the items with occurring windows, sorted as strings)."""
    wins = written(windows(benchmark, item_col, item_text_col, window), "bench-windows")
    size = wins.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 16)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / BLOCK_BYTES))
    renamed, names = positional(docs, text=text_col)
    df = renamed.withColumn("__hits", F.lit(None).cast(HIT_TYPE))
    spark = docs.sparkSession
    for block in range(n_blocks):
        part = wins.filter(in_block(n_blocks) == block)
        rows = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])  # at most about BLOCK_BYTES

        def scan(batches, rows=rows):
            searcher = Searcher(rows.value)
            for batch in batches:
                k = batch.schema.get_field_index("__hits")
                out = []
                for text, old in zip(
                    batch.column(batch.schema.get_field_index("__text")).to_pylist(), batch.column(k).to_pylist()
                ):
                    n, spans, items = searcher.search(text)
                    if old:
                        spans, items = merge_spans(spans + old["spans"]), items | set(old["items"])
                    out.append({"n_words": n, "spans": spans, "items": sorted(items)})
                yield batch.set_column(k, batch.schema.field(k), pa.array(out, batch.schema.field(k).type))

        df = df.mapInArrow(scan, df.schema)
    return df.toDF(*names, out_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, spans, items, contaminated."""
    text_col = kw.pop("text_col", "text")
    hits = annotate(pick(docs, doc_id=id_col, text=text_col), benchmark, out_col="c", **kw)
    n_hit = F.aggregate("c.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return hits.select(
        "doc_id",
        "c.n_words",
        n_hit.alias("n_hit"),
        F.size("c.items").cast("long").alias("n_items"),
        "c.spans",
        "c.items",
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Documents without a hit, all columns as they were."""
    names = docs.columns
    marked = annotate(docs, benchmark, **kw).toDF(*[f"__c{i}" for i in range(len(names))], "__hits")
    return marked.filter(F.size("__hits.spans") == 0).drop("__hits").toDF(*names)
