"""The corpus pipeline: five stages over documents, each written and read again.

Rejects toxic documents, then documents of low quality; keeps one document of
each group of near duplicates; removes documents with benchmark passages; packs
what is left into sequences of 2048 tokens. No stage can be expressed in SQL
alone (two are trained classifiers, one tokenizes), so ``ORACLE_SQL`` is None
and the tests compare the stages with brute-force versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dealcast.llm import stages
from dealcast.llm.common import table
from dealcast.session import delete_path, release, scratch_path, scratch_tables

STAGES = [
    ("toxicity", stages.toxicity),
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's rows are written under the shared
    checkpoint folder and read again; then its scratch tables go, and so do the
    rows that it has read."""
    root = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}")
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = f"{root}/{name}"
        before = set(scratch_tables())
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(out)
        release(spark, [t for t in scratch_tables() if t not in before])
        if read is not None:
            delete_path(spark, read)
        docs, read = spark.read.schema(rows.schema).parquet(out), out
    return docs
