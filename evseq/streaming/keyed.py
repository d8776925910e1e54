"""M13 and L1's contexts on a stream: state per (entity, game).

An event can only be paired with the next one when no earlier event can still
arrive, so the state of a game holds its events that the watermark has not
passed, in any order of arrival, and the last finished event with the codes
before it.  When the watermark passes an event it is final: it is the next event
of the one before it, which is emitted.  State is bounded by the events of a game
within the delay; events later than that are dropped by Spark.  The rows equal
the batch operators' for any cut of the stream into micro-batches, once the
watermark has passed them; like there, a game's last event has no row.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def advance(pending: list, done: list, mark_ms: int, k: int) -> tuple[list, list, list]:
    """(still pending, last finished events, emitted rows).

    ``pending``: [time in microseconds, id, code]; ``done``: the last finished
    (id, code), newest last, at most ``k`` of them.
    """
    pending = sorted(pending, key=lambda e: (e[0], e[1]))
    out = []
    at = 0
    while at < len(pending) and pending[at][0] <= mark_ms * 1000:
        _, event, code = pending[at]
        if done:
            before = [c for _, c in reversed(done)]
            contexts = [",".join(map(str, before[:j])) if len(before) >= j else None for j in range(1, k + 1)]
            out.append((*done[-1], code, *contexts))
        done = [*done, [event, code]][-k:]
        at += 1
    return pending[at:], done, out


def next_event_stream(
    events: DataFrame,
    entity: str,
    game: str,
    time: str,
    event_id: str,
    code: str,
    k: int = 2,
    delay: str = "10 minutes",
    target: str = "next_code",
) -> DataFrame:
    """(entity, game, event_id, code, target, ctx_1 .. ctx_k) in append mode.

    Events of a game are ordered by (time, event_id); events without a time or a
    code are left out.
    """
    if k < 1:
        raise ValueError("contexts need k >= 1")
    rows = events.filter(F.col(time).isNotNull() & F.col(code).isNotNull())
    rows = rows.select(entity, game, F.col(time).alias("_time"), F.col(event_id).alias("_event"), F.col(code).cast("int").alias("_code"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    contexts = [f"ctx_{j}" for j in range(1, k + 1)]
    names = [entity, game, event_id, code, target, *contexts]
    schema = (
        f"`{entity}` {types[entity]}, `{game}` {types[game]}, `{event_id}` {types['_event']}, `{code}` int, `{target}` int, "
        + ", ".join(f"{c} string" for c in contexts)
    )

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, done = json.loads(state.get[0]) if state.exists else ([], [])
        for f in frames:
            micros = f["_time"].astype("datetime64[us]").astype("int64")
            pending += [[int(t), e, int(c)] for t, e, c in zip(micros, f["_event"].tolist(), f["_code"])]
        pending, done, out = advance(pending, done, state.getCurrentWatermarkMs(), k)
        state.update((json.dumps([pending, done]),))
        if pending:
            state.setTimeoutTimestamp(math.ceil(pending[0][0] / 1000) + 1)
        if out:
            yield pd.DataFrame([(*key, *row) for row in out], columns=names)

    marked = rows.withWatermark("_time", delay)
    return marked.groupBy(entity, game).applyInPandasWithState(
        step, schema, "held string", "append", GroupStateTimeout.EventTimeTimeout
    )
