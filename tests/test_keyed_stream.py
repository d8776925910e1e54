"""Next events and contexts on a stream equal the batch operators for any cut."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from evseq.operators import model as L
from evseq.streaming.keyed import advance, next_event_stream

T0 = dt.datetime(2024, 3, 1, 12)
SCHEMA = "entity string, game int, ts timestamp, id long, code int"


def events():
    rng = random.Random(6)
    rows = []
    for i in range(120):
        who = rng.choice([("a", 1), ("a", 2), (None, 1)])
        rows.append((*who, T0 + dt.timedelta(seconds=rng.randrange(0, 900)), i, rng.randrange(4) if i % 11 else None))
    # one event a game, hours later, moves the watermark over all others
    late = [("a", 1), ("a", 2), (None, 1)]
    return rows, [(*g, T0 + dt.timedelta(hours=5, seconds=i), 1000 + i, 0) for i, g in enumerate(late)]


def batch(spark, rows, k):
    df = spark.createDataFrame(rows, SCHEMA).filter("code is not null")
    w = Window.partitionBy("entity", "game").orderBy("ts", "id")
    led = L.with_contexts(df, "code", k, ["ts", "id"], ["entity", "game"], strategy="direct")
    led = led.withColumn("next_code", F.lead("code").over(w)).filter("next_code is not null")
    return sorted(map(repr, led.select("entity", "game", "id", "code", "next_code", *[f"ctx_{j}" for j in range(1, k + 1)]).collect()))


@pytest.mark.parametrize("cuts, k", [(1, 1), (4, 2), (9, 3)])
def test_stream_equals_batch(spark, tmp_path, cuts, k):
    rows, ending = events()
    shuffled = rows[:]
    random.Random(cuts).shuffle(shuffled)  # arrival in any order within the delay
    for i in range(cuts):
        spark.createDataFrame(shuffled[i::cuts], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame(ending, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([("z", 9, T0 + dt.timedelta(hours=9), 5000, 0)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = next_event_stream(stream, "entity", "game", "ts", "id", "code", k=k, delay="2 hours")
    query = (
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(240)
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(repr, got.collect())) == batch(spark, rows + ending, k)


def test_advance_waits_for_the_watermark():
    pending, done, out = advance([[3000, 7, 1], [1000, 9, 0], [1000, 8, 2]], [], 2, 2)
    assert pending == [[3000, 7, 1]] and out == [(8, 2, 0, "2", None)] and done == [[8, 2], [9, 0]]
    pending, done, out = advance(pending, done, 3, 2)
    assert pending == [] and out == [(9, 0, 1, "0", "0,2")] and done == [[9, 0], [7, 1]]
