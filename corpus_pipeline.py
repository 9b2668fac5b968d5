"""Pipeline over ``documents``: language, toxicity, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and is written and read back before the
next. All but the last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palaver.llm.bagminhash import near_duplicate_stage
from palaver.llm.common import table, written
from palaver.llm.decontaminate import decontamination_stage
from palaver.llm.langid import language_stage
from palaver.llm.packing import packing_stage
from palaver.llm.toxicity import toxicity_stage

STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
# Learned models and tokenizers are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
