"""Helpers shared by the text operators: column picking and written stages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Select columns by exact name under new names.

    Spark resolves names without regard to case, so a table with ``text`` and
    ``TEXT`` cannot be addressed by name; positions can.
    """
    by_position = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return by_position.select(*[F.col(f"__c{df.columns.index(old)}").alias(new) for new, old in names.items()])


def positional(df: DataFrame, **names: str) -> tuple[DataFrame, Sequence[str]]:
    """Rename every column to ``__c<i>`` except the named ones, which get the
    reserved names ``__<key>``; the second value restores the old names."""
    taken = {df.columns.index(old): f"__{new}" for new, old in names.items()}
    return df.toDF(*[taken.get(i, f"__c{i}") for i in range(len(df.columns))]), list(df.columns)


def small(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows, so that a worker turns little text
    into Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind; else they stay until the
    driver happens to collect its garbage, whatever the size of the table."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as Parquet in the shared folder and read it back: lineage
    ends there, its shuffle files go, later branches prune columns, and a lost
    executor costs a read."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
