"""A corpus pipeline of four stages, each a call of one corpus operator.

Each stage is written as Parquet in the shared folder and read again, so that a
lost executor costs no earlier stage.
"""

from __future__ import annotations

import uuid
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm import byte_bpe, decontaminate, near_dup, quality
from pitchlake.llm.common import cut, delete_folder, shared_folder, table
from pitchlake.llm.queries import RANKS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dup.one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of what they decode to."""
    return byte_bpe.digests(docs, Path(RANKS).read_bytes(), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder, docs = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    docs = cut(docs)
    delete_folder(spark, folder)
    return docs


QUERIES = {"pipeline": run}
#: The classifier and the tokenizer are not expressible in SQL; a test holds all
#: stages against plain Python.
ORACLE_SQL = None
ORACLE: dict[str, str] = {}
