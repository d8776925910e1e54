"""Operator 6: exact deduplication by a 128-bit content hash.

Rows are grouped by the MD5 of the text.  Two partial aggregates over narrow
rows (hash, id) give each group's size and keeper, so a group that holds a
third of all rows shuffles one partial row per task.  Only rows of groups with
more than one text are then compared with one reference text of their group
(a join on the hash whose big side may be split by AQE); rows whose bytes
differ from it form groups of their own, so a hash collision never merges two
texts.

Defined cases: a null text counts as the empty text; a null id is the smallest
id; rows that repeat the keeper's id and text are all marked kept
(``deduplicate`` leaves one of them); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import pick, positional, written


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _groups(keyed: DataFrame, keep: str) -> DataFrame:
    """(h, variant) -> group_size, keep_id, keep_rows from rows (h, variant, id)."""
    best = F.max if keep == "largest" else F.min
    # a struct ignores no null field: the flag puts null below every id
    rank = F.struct(F.col("id").isNotNull().alias("known"), "id", "n")
    per_id = keyed.groupBy("h", "variant", "id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("h", "variant").agg(F.sum("n").alias("group_size"), best(rank).alias("best"))


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    content_hash: Callable[[Column], Column] = md5_128,
) -> DataFrame:
    """Every row: doc_id, keep_id, group_size, kept, text_sha256, keep_rows (rows
    of the group with the keeper's id)."""
    base = pick(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    hashed = base.withColumn("h", content_hash(F.col("text")))
    narrow = written(
        hashed.select("id", "h", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256")), "exact-hashes"
    )
    several = narrow.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    shared = written(hashed.join(several, "h", "left_semi").select("id", "h", "text"), "exact-shared")
    reference = shared.groupBy("h").agg(F.min_by("text", F.struct(F.col("id").isNotNull(), "id")).alias("reference"))
    # bytes that differ from the reference of their hash: true collisions only
    apart = written(
        shared.join(reference, "h").filter(F.col("text") != F.col("reference")).select("id", "h", "text"), "exact-apart"
    )
    variants = apart.select(
        F.col("id").alias("v_id"),
        F.col("h").alias("v_h"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("v_sha"),
        F.col("text").alias("variant"),
    ).distinct()
    keyed = narrow.join(
        variants, (F.col("h") == F.col("v_h")) & _same("id", "v_id") & (F.col("text_sha256") == F.col("v_sha")), "left"
    ).select("id", "h", "text_sha256", "variant")
    groups = _groups(keyed, keep)
    g = groups.select(F.col("h").alias("g_h"), F.col("variant").alias("g_v"), "group_size", "best")
    return keyed.join(g, (F.col("h") == F.col("g_h")) & _same("variant", "g_v")).select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        "group_size",
        _same("id", "best.id").alias("kept"),
        "text_sha256",
        F.col("best.n").alias("keep_rows"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each group of equal texts, all columns as they were."""
    found = written(duplicate_groups(docs, id_col, text_col, **kw), "exact-groups")
    renamed, names = positional(docs, id=id_col, text=text_col)
    sha = F.sha2(F.encode(F.coalesce("__text", F.lit("")), "UTF-8"), 256)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("g_id"), F.col("text_sha256").alias("g_sha")).distinct()
    marked = renamed.withColumn("__sha", sha)
    left = marked.join(gone, _same("__id", "g_id") & (F.col("__sha") == F.col("g_sha")), "left_anti")
    if (found.agg(F.max("keep_rows")).first()[0] or 0) > 1:
        # rows that repeat a keeper's id and text
        left = left.dropDuplicates(["__id", "__sha"])
    return left.drop("__sha").toDF(*names)
