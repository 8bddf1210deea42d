"""The corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, BPE encoding.

``run(spark, sf_dir)`` applies STAGES to ``documents``. Each stage reads all that its predecessor
kept, from a table in the shared folder; every stage but the last returns the columns of its input.

1. quality: documents that the rules reject go.
2. line_dedup: later occurrences of repeated three-line windows leave the texts (``n_chars`` follows);
   a document of which nothing is left goes, as all of it stands elsewhere.
3. near_duplicates: of each class of similar documents the one with the least doc_id stays.
4. decontamination: documents that hold a benchmark item go.
5. encoding: token counts and digests are appended.

Defined results: empty tables pass through; null texts fail the quality rules; rows that repeat a
doc_id and text keep one row from stage 3 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicarium.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from lexicarium.llm.queries import PIECES, RANKS
from lexicarium.llm.store import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, PIECES, RANKS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one_of_each_class(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, RANKS).drop("token_ids")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: The tokeniser's verdicts and ids have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
