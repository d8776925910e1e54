"""Registered queries of the text operators and their DuckDB texts.

Each query applies one operator, with its production parameters, to its whole
table and derives the digest columns from the operator's real output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evseq.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    importance,
    ngram_join,
    pii,
    quality,
    sentencepiece_codec,
    sharding,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
)
from evseq.llm.common import table, tokenizer_path


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


OP1_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_start as (
  select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from item where len(w) > 0),
win as (
  select distinct cast(item_id as varchar) as item_id, array_to_string(w[s:s + 9], ' ') as x, least(len(w), 10) as m
  from item_start),
lens as (select distinct m from win),
doc_start as (
  select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as s from words, lens where len(w) >= m),
grams as (select doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') as x from doc_start),
hits as (select g.doc_id, g.m, g.s, win.item_id from grams g join win on g.x = win.x and g.m = win.m),
pos as (select distinct doc_id, unnest(range(s, s + m)) as p from hits),
n_pos as (select doc_id, count(*) as n_hit from pos group by doc_id),
ids as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_id, item_id from hits) group by doc_id)
select w.doc_id, cast(len(w.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join n_pos using (doc_id) left join ids using (doc_id)
"""


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"), keep="largest").drop("keep_rows")


OP6_SQL = """
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(g.t) as text_sha256
from documents d join (
  select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size from documents group by 1
) g on coalesce(d.text, '') = g.t
"""

def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of(k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(F.encode(pii.joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")


#: crc32 is computed from its polynomial: a table of 256 entries by eight shifts each
OP11_SQL = r"""
with table0 as (select range as b, range::bigint as c from range(256)),
crc_table as (
  select list(list_reduce(range(9), lambda a, i: case when i = 0 then a when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end, c)
    order by b) as tab from table0),
words as (
  select false as target, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all
  select true, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
pos as (select target, id, w, unnest(range(1, len(w) + 1)) as i from words),
feature as (
  select target, id, w[i] as f from pos
  union all
  select target, id, w[i] || ' ' || w[i + 1] from pos where i < len(w)),
bytes as (
  select f, hex(encode(f)) as x from (select distinct f from feature)),
crc as (
  select f, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::bigint),
    lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket
  from bytes, crc_table),
per as (select target, id, bucket, count(*) as n from feature join crc using (f) group by all),
doc_n as (select bucket, sum(n)::bigint as s from per where not target group by bucket),
item_n as (select bucket, sum(n)::bigint as t from per where target group by bucket),
total as (
  select (select coalesce(sum(s), 0) from doc_n)::double as s_all, (select coalesce(sum(t), 0) from item_n)::double as t_all),
gain as (
  select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as g
  from doc_n left join item_n using (bucket), total),
weights as (
  select id, sum(n)::bigint as n_features, floor(sum(n * g)::double / sum(n))::bigint as weight
  from per join gain using (bucket) where not target group by id),
scored as (
  select w.id as doc_id, len(w.w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    ('0x' || sha256('7:' || w.id)[1:8])::bigint as h
  from words w left join weights on weights.id = w.id where not target),
final as (
  select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, 25 * count(*) over () // 100 as k
  from final where n_words >= 20)
select f.doc_id, n_features, weight, score, case when r <= k then r end as rank
from final f left join ranked using (doc_id)
"""


def op12_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deviation that no long holds (many millions of vectors) is null here; the operator's is a decimal
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_ngram_join": op2_ngram_join,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pii": op7_pii,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_html_extract": op9_html_extract,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_importance": op11_importance,
    "op12_shuffle_shards": op12_shuffle_shards,
    "op13_whitening": op13_whitening,
}
ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op11_importance": OP11_SQL,
}
