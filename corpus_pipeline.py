"""From raw documents to token files: five stages, each over all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from murmuro.llm import catalog
from murmuro.runtime import remove_folders, shared_folder

STAGES = catalog.STAGES

# Model training and tokenizers have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written to the shared folder and read back.

    A stage's input goes when its result has been written, and a stage removes the tables that the one before
    it wrote on the way (see `catalog.stage`); token files stay, their folder is a column of the result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/murmuro/{uuid.uuid4().hex}"
    done: list[str] = []
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        remove_folders(spark, done)
        done = [f"{folder}/{name}"]
    catalog.forget_stage(spark, docs)
    return docs
