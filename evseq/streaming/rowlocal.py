"""Row-local cleaning on a streaming DataFrame.

Only expressions that look at one row are used (required non-null filter,
strict literal maps, sentinel fills, presence flags, the count text); the
data-derived steps (top-k entities, rare merge, codes) need the whole history
and stay batch operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evseq.functions.exprs import concat_text, fill_null, flag_not_null, strict_map
from evseq.operators.filters import drop_nulls

HAND_CODES = {"R": 0, "L": 1}


def clean_stream(events: DataFrame, required: Sequence[str] = ("pitch_type", "release_speed")) -> DataFrame:
    """F2 + J2a + X1/M14 + M2 + X6 on every micro-batch (no state)."""
    out = drop_nulls(events, list(required))
    return out.withColumns(
        {
            "stand": strict_map("stand", HAND_CODES, "stand"),
            "p_throws": strict_map("p_throws", HAND_CODES, "p_throws"),
            "pitch_result": fill_null("type", "N/A"),
            "release_spin_rate": fill_null("release_spin_rate", -1.0),
            "balls_strikes": concat_text("balls", "strikes", sep="-"),
            "on_1b": flag_not_null("on_1b"),
            "on_2b": flag_not_null("on_2b"),
            "on_3b": flag_not_null("on_3b"),
        }
    ).drop("type")
