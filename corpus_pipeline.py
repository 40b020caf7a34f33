"""The corpus pipeline: the stages that turn ``documents`` into token sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``, further ones included, whatever
their names. Between stages the rows are written as Parquet and read again. An empty table stays
empty; a text that is null counts as empty; rows with null ids and repeated rows go through every
stage like others. Near-dedup keeps all rows with a null id, and all rows of the doc_id it keeps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, near_dedup, quality, sentencepiece_codec, toxicity
from sluice.llm.common import remove, shared_folder, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

# Its classifiers are trained and its dedup is sketched; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)  # the next stage's rows are written: nothing reads these again
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
