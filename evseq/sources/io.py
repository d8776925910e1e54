"""Scans and sinks.

All reads go through ``spark.read.parquet`` so Catalyst prunes columns and
pushes literal predicates into the Parquet scan.  Sinks write with Spark's
distributed writer (one file per task, so any size works) into a folder the
caller names; the round-trip helpers used by registered queries write below
the cluster checkpoint dir and read the result back.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_events(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Parquet scan of an event table, optionally with a declared schema.

    Only ``columns`` reach the scan's ReadSchema.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def load_date_range(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Rows whose date of ``ts_col`` lies in ``[start, end]`` (both inclusive).

    Expressed as a half-open range on the raw column so the bound is a literal
    comparison that Parquet min/max statistics (and partition pruning on a
    date-partitioned layout) can use.
    """
    lo = _dt.date.fromisoformat(start)
    hi = _dt.date.fromisoformat(end) + _dt.timedelta(days=1)
    col = F.col(ts_col)
    return df.filter((col >= F.lit(lo).cast("timestamp_ntz")) & (col < F.lit(hi).cast("timestamp_ntz")))


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Distributed Parquet write (optionally gzip, optionally partitioned)."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """JSON lines, one folder per entity when ``partition_by`` is given."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)
    return path


def round_trip_parquet(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    compression: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    write_parquet(df, path, compression=compression, partition_by=partition_by)
    back = spark.read.parquet(path)
    # partition columns come back last and typed by inference; restore order
    return back.select(*df.columns)


def round_trip_json(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    write_json(df, path, partition_by=partition_by)
    back = spark.read.schema(_json_schema(df, partition_by)).json(path)
    return back.select(*df.columns)


def _json_schema(df: DataFrame, partition_by: Sequence[str] | None) -> StructType:
    # data columns first, partition columns last: the layout Spark reads back
    part = list(partition_by or [])
    fields = [f for f in df.schema.fields if f.name not in part] + [df.schema[p] for p in part]
    return StructType(fields)
