"""Corpus pipeline: quality rules, near duplicates, benchmark decontamination,
personal data, packing.

Each stage takes (spark, docs, sf_dir); its result is written to the shared
folder as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``. An empty table passes through every
stage; the last returns its (empty) pieces. Near duplicates and the token
tables have no SQL form, so the pipeline is tested against a brute-force
version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import decontaminate, near_dedup, packing, pii, quality_rules
from parcelflow.llm.common import stored, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_duplicates", near_dedup.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("personal_data", pii.stage),
    ("best_fit_packing", packing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
