"""SparkSession helpers.

The library never creates a session on its own inside an operator; callers pass
one in.  ``local_session`` is what tests and ``bench.py`` use; it alone sets
``spark.checkpoint.dir`` where nobody did.  ``shared_dir`` returns a folder under
that directory for lineage cuts and sink round trips, and raises when it is
unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "evseq") -> SparkSession:
    """A local session tuned the way the library expects a cluster to be tuned."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EVSEQ_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_local_folder(spark)
    return spark


def use_local_folder(spark: SparkSession) -> None:
    """For tests, the bench and smoke runs on one machine: a temporary folder as
    the checkpoint dir of a ``local[...]`` session that names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() or _configured(spark) or not re.match(r"local(\[|$)", sc.master):
        return
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="evseq-ckpt-"))


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint dir the session names; raises when it names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = _configured(spark)
    if not conf:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set: stages need a folder that driver and executors share")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint dir, visible to every executor."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/evseq-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage at a stage boundary: the rows are written as Parquet below
    the cluster's checkpoint dir and read back.  Later branches read only the
    columns they use instead of re-running the upstream plan, and a lost
    executor does not force a recompute from the source scan."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
