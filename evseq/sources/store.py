"""S4/S5 as an incremental, bucketed store.

One table, partitioned by day, bucketed by the group keys and sorted inside
the buckets.  A load replaces exactly the days it brings (dynamic partition
overwrite), so loading a day again leaves the table as it was.  Windows per
group read the buckets as they lie: no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def create_store(
    df: DataFrame, table: str, path: str, day: str, bucket_by: Sequence[str], sort_by: Sequence[str] = (), n_buckets: int = 8
) -> None:
    """An empty table with the columns of ``df`` (the day last), its files below ``path``."""
    keys = list(bucket_by)
    (
        df.limit(0)
        .select(*[c for c in df.columns if c != day], day)
        .write.format("parquet")
        .partitionBy(day)
        .bucketBy(n_buckets, *keys)
        .sortBy(*keys, *[c for c in sort_by if c not in keys and c != day])
        .option("path", path)
        .saveAsTable(table)
    )


def load_days(df: DataFrame, table: str) -> None:
    """Put the days of ``df`` into the store; days it does not bring stay."""
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE, None)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.unset(OVERWRITE) if before is None else spark.conf.set(OVERWRITE, before)


def read_store(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
