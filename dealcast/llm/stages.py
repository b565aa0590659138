"""The operators as stages of the corpus pipeline: documents in, documents out.

A stage gives back the columns that it gets, whatever else they hold. Decisions
are taken back to the documents by id: rows that share an id are one document
and stay or go together, and a row without an id is known by its text.

The rows that a stage gives are lazy and read scratch tables of its own, which
stay until the session ends or ``session.release`` drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.llm import common as C

DROP_BROADCAST = 1_000_000  # ids that may be broadcast (16 MB)
_NAMELESS = 1 << 62         # numbers from here on stand for rows without an id


def _plain(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with an id for every row."""
    C.small_batches(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NAMELESS) + F.shiftrightunsigned(F.xxhash64("text"), 2))
    return docs.select(key.alias("doc_id"), F.col("text"))


def _without(docs: DataFrame, drop: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is not in ``drop`` (doc_id)."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NAMELESS) + F.shiftrightunsigned(F.xxhash64("text"), 2))
    drop = C.materialize(drop.select(F.col("doc_id").alias("_gone")).distinct())
    return docs.withColumn("_known_by", key).join(C.broadcast_if_small(drop, DROP_BROADCAST), F.col("_known_by") == F.col("_gone"), "left_anti").drop("_known_by")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic."""
    from dealcast.llm import toxicity as op
    found = op.toxicity(_plain(docs), C.table(spark, sf_dir, "labels"))
    return _without(docs, found.where("toxic"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 1."""
    from dealcast.llm import quality as op
    found = op.quality(_plain(docs), C.table(spark, sf_dir, "labels"))
    return _without(docs, found.where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five words, similarity 0.8): the smallest
    id's; of rows that repeat that id, the one with the smallest text hash."""
    from dealcast.llm.neardup import near_duplicates as op
    found = C.materialize(op(_plain(docs), size=5, percent=80))
    left = _without(docs, found.where(~F.col("kept")))
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NAMELESS) + F.shiftrightunsigned(F.xxhash64("text"), 2))
    return (left.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("_row"))
            .select("_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    from dealcast.llm import decontaminate as op
    found = op.decontaminate(_plain(docs), C.table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, with its sequence and offset."""
    from dealcast.llm import packing as op
    C.small_batches(spark)
    return op.packed_pieces(docs)
