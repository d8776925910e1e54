"""Row-local cleaning gives the same rows on a stream as in batch."""

import os

import pytest

from evseq.fixtures import pitches_from_events
from evseq.session import shared_dir
from evseq.streaming import clean_stream

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_clean_stream_matches_batch(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    batch = clean_stream(pitches_from_events(events))
    stream_src = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    q = (
        clean_stream(pitches_from_events(stream_src))
        .writeStream.format("memory")
        .queryName("evseq_clean_stream")
        .option("checkpointLocation", shared_dir(spark, "stream"))
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("select * from evseq_clean_stream")
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0
