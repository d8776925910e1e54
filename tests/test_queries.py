"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import re

import pytest

from tests.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


def _names():
    from evseq.plans import learned  # noqa: F401  (registers its queries)
    from evseq.plans.catalog import QUERIES

    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from evseq.plans.catalog import ORACLE, QUERIES

    status, info, _ = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF)
    assert status in ("ok", "rows-only"), info


@pytest.mark.parametrize("name", ["M13_next_event_target", "W3_rolling_mean"])
def test_windows_per_game_run_over_blocks(spark, name):
    from evseq.plans.catalog import QUERIES

    plan = QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()
    per_game = re.findall(r"windowspecdefinition\(player_name#\d+, game_pk#\d+[^,]*, (\w+)", plan)
    assert per_game and set(per_game) == {"_blk"}


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["player_name", "game_pk", "event_id", "pitch_type", "pitch_type_code", "next_pitch_type_code"]
    assert df.count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
