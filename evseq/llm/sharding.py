"""Operator 12: global shuffle into shards by a two-pass external shuffle.

1. Every record is scattered to one of B buckets by a seeded hash of its id and
   text; B is chosen so that a bucket holds about ``BUCKET_BYTES``.
2. A bucket, which fits in memory, is put in the order of its hashes (so that
   its order of arrival plays no part), shuffled by Fisher-Yates with numbers
   drawn from (seed, bucket), and written as Parquet.

The buckets one after another are the shuffled table.  The number of rows in
each bucket (a narrow table, summed up in two levels) gives every row its
position; shards are ranges of positions, so their counts are at most one
apart, and a slot is the place in the shard.

Equal records hash alike.  Those that repeat in full (found by a partial
aggregate over hashes) are scattered by their place in the scan as well, so a
record that makes up a third of the table is spread over all buckets.

Defined cases: a null text counts as no bytes, hashes apart from the empty text
and stays null; null ids are ids like any other; one record larger than a
bucket is a bucket's content by itself; an empty table gives no rows; all
columns are kept, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evseq.llm.common import positional, written
from evseq.session import shared_dir

SHARDS = 8
SEED = 12
BUCKET_BYTES = 32 << 20
ROW_BYTES = 64  # counted for a record besides its text
LEVEL = 4_096  # buckets summed up together
BROADCAST_BUCKETS = 4_000_000  # offsets of so many buckets may be sent to the tasks (64 MB)


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    """A uniformly random order of range(n)."""
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else ()):
        order[i], order[j] = order[j], order[i]
    return order


def scatter(docs: DataFrame, id_col: str, text_col: str, seed: int, bucket_bytes: int) -> DataFrame:
    """``docs`` by position plus ``__hash``, ``__salt`` and ``__bucket`` (pass 1)."""
    renamed, _ = positional(docs, id=id_col, text=text_col)
    hashed = renamed.withColumn("__hash", F.xxhash64(F.lit(seed), "__id", "__text", F.col("__text").isNull()))
    size = F.coalesce(F.octet_length("__text"), F.lit(0)) + ROW_BYTES
    narrow = written(hashed.select("__hash", size.cast("long").alias("size")), "shard-hashes")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    n = max(1, math.ceil(total / bucket_bytes))
    # repeated records, or different ones of one hash: no harm, they get a salt
    again = written(narrow.groupBy("__hash").count().filter("count > 1").select("__hash"), "shard-repeats")
    again = again.select(F.col("__hash").alias("__again"))
    placed = hashed.withColumn("__place", F.monotonically_increasing_id())
    salted = placed.join(again, F.col("__hash") == F.col("__again"), "left").withColumn(
        "__salt", F.when(F.col("__again").isNotNull(), F.col("__place")).otherwise(F.lit(0).cast("long"))
    )
    bucket = F.pmod(F.xxhash64(F.lit(seed), "__hash", "__salt"), F.lit(n).cast("long"))
    return salted.withColumn("__bucket", bucket).drop("__again", "__place")


def write_shuffled(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Shuffle all records and write them: ``<path>`` holds the columns
    ``__c0`` .. by position, ``__bucket`` and ``__slot`` (place in the bucket)."""
    scattered = scatter(docs, id_col, text_col, seed, bucket_bytes)
    taken = {docs.columns.index(id_col): "__id", docs.columns.index(text_col): "__text"}
    kept = [taken.get(i, f"__c{i}") for i in range(len(docs.columns))]
    out = scattered.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(kept)], "__bucket", F.lit(0).alias("__slot"))
    schema = out.schema

    def shuffle_bucket(t: pa.Table) -> pa.Table:
        bucket = t.column("__bucket")[0].as_py()
        keys = [t.column(c).to_numpy() for c in ("__salt", "__hash")]
        order = np.lexsort(keys)[fisher_yates(t.num_rows, np.random.default_rng([seed, bucket]))]
        t = t.select([*kept, "__bucket"]).take(pa.array(order))
        slot = pa.array(np.arange(t.num_rows), pa.int32())
        return pa.table([*t.columns, slot], names=schema.fieldNames())

    shuffled = scattered.select(*kept, "__hash", "__salt", "__bucket").groupBy("__bucket").applyInArrow(shuffle_bucket, schema)
    shuffled.write.parquet(path)


def shards(
    spark: SparkSession, path: str, columns: list[str], n_shards: int = SHARDS, shard_col: str = "shard", slot_col: str = "slot"
) -> DataFrame:
    """The written records under their names, with shard and slot."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes.withColumn("level", F.floor(F.col("__bucket") / LEVEL)), "shard-sizes")
    levels = sizes.groupBy("level").agg(F.sum("n").alias("n"))
    running = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)  # one row for LEVEL buckets
    levels = levels.select("level", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("level").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(levels, "level")
    offsets = offsets.select(F.col("__bucket").alias("__b"), (F.col("before") + F.col("ahead")).alias("__offset"))
    n_buckets, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_buckets <= BROADCAST_BUCKETS:  # 16 bytes a bucket; beyond it the join is shuffled
        offsets = F.broadcast(offsets)
    small, larger = divmod(total, n_shards)  # the first ``larger`` shards hold one row more
    edge = larger * (small + 1)
    placed = (
        rows.join(offsets, F.col("__bucket") == F.col("__b"))
        .withColumn("__at", F.col("__offset") + F.col("__slot"))
        .withColumn(
            "__shard",
            F.when(F.col("__at") < edge, F.expr(f"__at div {small + 1}"))
            .otherwise(F.expr(f"{larger} + (__at - {edge}) div {max(small, 1)}"))
            .cast("int"),
        )
        .withColumn("__place", F.col("__at") - F.col("__shard") * F.lit(small) - F.least("__shard", F.lit(larger)))
    )
    return placed.select(
        *[f"__c{i}" for i in range(len(columns))], "__shard", F.col("__place").cast("long").alias("__place")
    ).toDF(*columns, shard_col, slot_col)


def shuffle_into_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = SHARDS, path: str | None = None, **kw
) -> DataFrame:
    """Write the shuffled table below ``path`` (a fresh shared folder by default)
    and return it as read back: all columns, shard, slot."""
    path = path or shared_dir(docs.sparkSession, "shards")
    write_shuffled(docs, path, id_col, text_col, **kw)
    return shards(docs.sparkSession, path, docs.columns, n_shards)
