"""The corpus pipeline: stages over ``documents``, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattlane.llm import stages
from wattlane.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Each stage is written as Parquet and read again as the next one's documents.
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", stages.classify),
    ("line dedup", stages.dedup_lines),
    ("SimHash near-dedup", stages.dedup_near),
    ("mixing sources", stages.mix_sources),
    ("SentencePiece encoding", stages.encode),
]

#: Classifier, mixing and encoding are beyond SQL; the stages have tests against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = stages.work_folder(shared_folder(spark))
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
