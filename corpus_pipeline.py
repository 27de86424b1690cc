"""Five stages that turn raw documents into packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's
rows as Parquet in the shared checkpoint folder and reads them again, so no stage repeats the
work of an earlier one and a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from freightmill.llm.common import read_table, shared_folder
from freightmill.llm.decontaminate import drop_contaminated
from freightmill.llm.exact_dedup import drop_exact_duplicates
from freightmill.llm.jaccard_join import drop_near_duplicates
from freightmill.llm.packing import pack_documents
from freightmill.llm.toxicity import drop_toxic, train


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return drop_toxic(docs, train(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each distinct text, the one with the largest id."""
    return drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each group of near duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic_documents),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Toxicity is a trained model and packing follows tokenizer ids; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
