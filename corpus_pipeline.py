"""The documents of a corpus made into training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. `run` writes what each makes to the
folder that all executors share and goes on from there, so lost executors never reach back beyond one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborlake.llm import decontaminate, jaccard_join, line_dedup, packing, quality_classifier
from laborlake.llm.common import table, written
from laborlake.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the resampling keeps."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without later copies of line runs; n_chars is counted anew."""
    return line_dedup.without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", pack),
]

#: Resampling, banded alignment and tokenizers are beyond SQL; tests hold every stage against a plainer version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
