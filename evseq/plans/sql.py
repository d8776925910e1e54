"""DuckDB oracle fragments: the workflow written once as plain SQL CTEs.

These texts are the independent check for the Spark operators (the driver runs
them on the same Parquet tables).  Each name mirrors a Spark stage:
``f`` required non-null, ``top``/``t`` top-2 entities, ``pe`` per-entity
shares, ``m`` rare labels merged, ``codes``/``c`` codes per entity, ``n``/``tgt``
next code per (entity, game), ``g1``/``g2``/``gs``/``sr`` game split,
``cx``/``cls``/``cnt``/``tot``/``clsl``/``mdl``/``scored`` the order-2
transition model (alpha 1) and its scores.
"""

from __future__ import annotations

from evseq.fixtures import with_pitches

ORD = "game_date, at_bat_number, pitch_number"

F = "f as (select * from pitches where pitch_type is not null and release_speed is not null)"
TOP = (
    "top as (select player_name from (select player_name, count(pitch_type) as c from f group by player_name) x "
    "order by c desc, player_name limit 2)"
)
T = "t as (select * from f where player_name in (select player_name from top))"
PE = (
    "pe as (select player_name, pitch_type, count(*) as count, "
    "cast(count(*) as double) / sum(count(*)) over (partition by player_name) as proportion "
    "from t group by player_name, pitch_type)"
)
M = (
    "m as (select t.* exclude (pitch_type), case when r.hit then 'other' else t.pitch_type end as pitch_type "
    "from t left join (select player_name, pitch_type, true as hit from pe where proportion < 0.03) r "
    "on t.player_name = r.player_name and t.pitch_type = r.pitch_type)"
)
CODES = (
    "codes as (select player_name, pitch_type, "
    "cast(dense_rank() over (partition by player_name order by pitch_type) - 1 as integer) as pitch_type_code "
    "from (select distinct player_name, pitch_type from m) d)"
)
C = (
    "c as (select m.*, codes.pitch_type_code from m join codes "
    "on m.player_name = codes.player_name and m.pitch_type = codes.pitch_type)"
)
N = (
    "n as (select *, lead(pitch_type_code) over (partition by player_name, game_pk order by "
    + ORD
    + ") as next_pitch_type_code from c)"
)
TGT = "tgt as (select * from n where next_pitch_type_code is not null and pitch_type_code is not null)"
G1 = (
    "g1 as (select player_name, game_pk, game_date, at_bat_number, pitch_number from tgt "
    "qualify row_number() over (partition by player_name, game_pk order by " + ORD + ") = 1)"
)
G2 = (
    "g2 as (select player_name, game_pk, row_number() over (partition by player_name order by "
    + ORD
    + ", game_pk) - 1 as i, count(*) over (partition by player_name) as g from g1)"
)
GS = (
    "gs as (select player_name, game_pk, case when i < floor(cast(0.8 as double) * g) then 'train' "
    "when i < floor(cast(0.9 as double) * g) then 'val' else 'test' end as split from g2)"
)
SR = "sr as (select tgt.*, gs.split from tgt join gs on tgt.player_name = gs.player_name and tgt.game_pk = gs.game_pk)"
CX = (
    "cx as (select *, '' as ctx_0, cast(pitch_type_code as varchar) as ctx_1, "
    "cast(pitch_type_code as varchar) || ',' || cast(lag(pitch_type_code) over (partition by player_name, game_pk order by "
    + ORD
    + ") as varchar) as ctx_2 from sr)"
)
CLS = "cls as (select player_name, cast(count(distinct pitch_type_code) as integer) as n_classes from codes group by player_name)"
CNT = (
    "cnt as (select player_name, o, ctx, nxt, count(*) as cnt from ("
    "select player_name, 0 as o, ctx_0 as ctx, next_pitch_type_code as nxt from cx where split = 'train' "
    "union all select player_name, 1, ctx_1, next_pitch_type_code from cx where split = 'train' and ctx_1 is not null "
    "union all select player_name, 2, ctx_2, next_pitch_type_code from cx where split = 'train' and ctx_2 is not null) u "
    "group by player_name, o, ctx, nxt)"
)
TOT = "tot as (select player_name, o, ctx, sum(cnt) as total from cnt group by player_name, o, ctx)"
CLSL = "clsl as (select player_name, n_classes, unnest(range(n_classes)) as i from cls)"
MDL = (
    "mdl as (select tot.player_name, tot.o, tot.ctx, cast(tot.total as bigint) as total, clsl.n_classes, "
    "list((cast(coalesce(cnt.cnt, 0) as double) + cast(1.0 as double)) / "
    "(cast(tot.total as double) + cast(1.0 as double) * clsl.n_classes) order by clsl.i) as p "
    "from tot join clsl on tot.player_name = clsl.player_name "
    "left join cnt on cnt.player_name = tot.player_name and cnt.o = tot.o and cnt.ctx = tot.ctx and cnt.nxt = clsl.i "
    "group by tot.player_name, tot.o, tot.ctx, tot.total, clsl.n_classes)"
)
SCORED = (
    "sc as (select cx.player_name, cx.game_pk, cx.game_date, cx.at_bat_number, cx.pitch_number, cx.split, "
    "cx.next_pitch_type_code as y, "
    "coalesce(m2.p, m1.p, m0.p, list_transform(range(cls.n_classes), lambda i: cast(1.0 as double) / cls.n_classes)) as p, "
    "case when m2.p is not null then 2 when m1.p is not null then 1 when m0.p is not null then 0 end as order_used "
    "from cx left join mdl m2 on m2.player_name = cx.player_name and m2.o = 2 and m2.ctx = cx.ctx_2 "
    "left join mdl m1 on m1.player_name = cx.player_name and m1.o = 1 and m1.ctx = cx.ctx_1 "
    "left join mdl m0 on m0.player_name = cx.player_name and m0.o = 0 and m0.ctx = cx.ctx_0 "
    "left join cls on cls.player_name = cx.player_name), "
    "scored as (select *, cast(list_position(p, list_max(p)) - 1 as integer) as pred from sc)"
)
TEST = "te as (select * from scored where split = 'test')"
MAPPING = "mp as (select player_name, pitch_type_code, pitch_type as name from codes)"

CLEAN = [F, TOP, T, PE, M, CODES, C]
TARGET = CLEAN + [N, TGT]
SPLIT = TARGET + [G1, G2, GS, SR]
MODEL = SPLIT + [CX, CLS, CNT, TOT, CLSL, MDL, SCORED]


def q(ctes: list[str], body: str) -> str:
    return with_pitches(*ctes) + body
