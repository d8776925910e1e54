"""The corpus pipeline: documents in, clean and coded documents out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes every stage as Parquet in the shared folder and reads it
back, so a lost executor never costs more than the stage at hand.  All stages
but the last return the columns of ``docs`` as they are.

No SQL is given: the quality classifier cannot be said in SQL.  The tests hold
``run`` against a plain Python version of the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evseq.llm import decontaminate, exact_dedup, ngram_join, quality, sentencepiece_codec
from evseq.llm.common import table, tokenizer_path, written
from evseq.session import use_local_folder

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents whose score is under the threshold go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the row with the largest id stays."""
    return exact_dedup.deduplicate(docs, keep="largest")


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each component of linked documents the smallest id stays."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the piece ids of every text, and the text decoded from them."""
    return sentencepiece_codec.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", ngram_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"corpus-{i}")
    return docs
