"""The corpus pipeline: toxicity, exact and near duplicates, benchmark decontamination, packing.

Each stage takes the documents its predecessor kept and applies its decisions
to all of them.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import fold, prepared, shared_folder, table
from kpiloom.llm.config_packing import packed
from kpiloom.llm.decontamination import decontaminated
from kpiloom.llm.exact_dedup import first_of_equal
from kpiloom.llm.near_dedup import first_of_similar
from kpiloom.llm.queries import byte_tokenizer
from kpiloom.llm.toxicity import fit, without_toxic
from kpiloom.operators.lineage import removed, stages_removed
from kpiloom.session import make_adaptive


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labels outside the held-out fold.

    Each row is decided by its text: null and empty texts, and tables without
    labels of both kinds, lose nothing.  Extra columns of any name are kept.
    """
    labels = table(prepared(make_adaptive(spark)), sf_dir, "labels")
    return without_toxic(docs, fit(docs, labels, fold(F.col("doc_id"), 5) != 0))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the smallest id; of repeated rows and rows without an id too.

    Null and empty texts are one group.  An empty table stays empty, and extra
    columns of any name are kept.
    """
    prepared(make_adaptive(spark))
    return first_of_equal(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of similar texts; rows without an id or without words stay.

    Rows of one id stay or go together.  An empty table stays empty, and extra
    columns of any name are kept.
    """
    prepared(make_adaptive(spark))
    return first_of_similar(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Each row is decided by its text: null and empty texts stay, repeated rows
    and rows without an id like any other.  Extra columns of any name are kept.
    """
    return decontaminated(docs, table(prepared(make_adaptive(spark)), sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and offset of each piece of each remaining row; null and empty texts are one closing token."""
    prepared(make_adaptive(spark))
    return packed(docs, byte_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Scores of a trained model, sketches and packing have no SQL form; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What a stage stored for itself, and its predecessor's rows, are deleted
    when it is written; the rows that the last stage reads stay.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/kpiloom-stages/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with stages_removed():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            removed(spark, before)
        before = f"{folder}/{name}"
        docs = spark.read.parquet(before)
    return STAGES[-1][1](spark, docs, sf_dir)
