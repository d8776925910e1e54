"""The ``pitches`` fixture view over the driver's ``events`` table.

The event table used by the library is one wide row per event of an entity.
The driver ships no such table, so tests and registered queries derive it from
``events`` with the view below (given in both Spark and DuckDB form; the two
give equal rows and types).  Everything downstream only sees column names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.sources.io import read_table


def _k() -> Column:
    return F.regexp_extract(F.col("props"), r"[0-9]+", 0).cast("int")


def pitches_from_events(events: DataFrame) -> DataFrame:
    """Spark form of the fixture view (one projection over ``events``)."""
    k = F.col("k")
    e = events.select("event_id", "ts", "user_id", "event_type", "value", _k().alias("k"))
    user5 = F.col("user_id") % 5
    return e.select(
        F.col("event_id"),
        F.concat(F.lit("P"), user5.cast("string")).alias("player_name"),
        user5.alias("pitcher"),
        (user5 * 1000 + F.dayofmonth("ts").cast("bigint")).alias("game_pk"),
        F.to_date("ts").cast("string").alias("game_date"),
        F.hour("ts").cast("int").alias("at_bat_number"),
        F.col("event_id").alias("pitch_number"),
        F.when(k < 2, F.lit("EP"))
        .when(k == 99, F.lit(None).cast("string"))
        .otherwise(F.upper(F.substring("event_type", 1, 2)))
        .alias("pitch_type"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("release_speed"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("value") * 10).alias("release_spin_rate"),
        F.when(k % 13 == 0, F.lit(float("nan")))
        .when(k % 19 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") / 2)
        .alias("effective_speed"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise((k * 3).cast("string")).alias("spin_axis"),
        F.when(F.col("user_id") % 3 == 0, F.lit("L")).otherwise(F.lit("R")).alias("stand"),
        F.when(F.col("user_id") % 2 == 0, F.lit("L")).otherwise(F.lit("R")).alias("p_throws"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 0, F.lit("B"))
        .when(k % 3 == 1, F.lit("S"))
        .otherwise(F.lit("X"))
        .alias("type"),
        F.when(k % 4 == 0, F.lit(None).cast("int")).otherwise(k % 10).alias("hit_location"),
        (k % 4).alias("balls"),
        (F.floor(k / F.lit(4.0)).cast("int") % 3).alias("strikes"),
        (k % 3).alias("outs_when_up"),
        (F.hour("ts").cast("int") % 9 + 1).alias("inning"),
        F.when(k % 5 == 0, F.col("user_id")).alias("on_1b"),
        F.when(k % 7 == 0, F.col("user_id")).alias("on_2b"),
        F.when(k % 11 == 0, F.col("user_id")).alias("on_3b"),
    )


def pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitches_from_events(read_table(spark, sf_dir, "events"))


# DuckDB text of the same view, used as a CTE in every oracle query.
PITCHES_SQL = """
pitches as (
select event_id,
  'P' || cast(user_id % 5 as varchar)                              as player_name,
  user_id % 5                                                      as pitcher,
  (user_id % 5) * 1000 + cast(day(ts) as bigint)                   as game_pk,
  cast(cast(ts as date) as varchar)                                as game_date,
  cast(hour(ts) as int)                                            as at_bat_number,
  event_id                                                         as pitch_number,
  case when k < 2 then 'EP' when k = 99 then null
       else upper(substr(event_type, 1, 2)) end                    as pitch_type,
  case when k % 17 = 0 then null else value end                    as release_speed,
  case when k % 7 = 0 then null else value * 10 end                as release_spin_rate,
  case when k % 13 = 0 then cast('NaN' as double)
       when k % 19 = 0 then null else value / 2 end                as effective_speed,
  case when k % 23 = 0 then null else cast(k * 3 as varchar) end   as spin_axis,
  case when user_id % 3 = 0 then 'L' else 'R' end                  as stand,
  case when user_id % 2 = 0 then 'L' else 'R' end                  as p_throws,
  case when k % 6 = 0 then null when k % 3 = 0 then 'B'
       when k % 3 = 1 then 'S' else 'X' end                        as type,
  case when k % 4 = 0 then null else k % 10 end                    as hit_location,
  k % 4 as balls, cast(floor(k / 4.0) as int) % 3 as strikes, k % 3 as outs_when_up,
  cast(hour(ts) as int) % 9 + 1                                    as inning,
  case when k % 5 = 0 then user_id end                             as on_1b,
  case when k % 7 = 0 then user_id end                             as on_2b,
  case when k % 11 = 0 then user_id end                            as on_3b
from (select *, cast(regexp_extract(props, '[0-9]+', 0) as int) as k from events) e
)"""


def with_pitches(*ctes: str) -> str:
    """``with pitches as (...), <ctes>`` prefix for oracle SQL."""
    parts = [PITCHES_SQL.strip()] + [c.strip() for c in ctes]
    return "with " + ",\n".join(parts) + "\n"
