"""Fitting on a bounded sample of labelled documents, inside Spark tasks.

The sample is the ``rows`` labelled texts whose ids have the smallest hash (a
top-k, so it is the same on every run and nothing larger than it meets in a
task). Its texts
are turned into sparse features where they are read; one task then gets the
features of at most ``rows`` documents and fits the model. Only the fitted
model, of fixed size, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dealcast.llm import common as C


def text_hash(text: str) -> Column:
    """A null text is an empty one."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, label): at most ``rows`` documents that may be learned
    from, those with the smallest hashes of their ids. A null id or label is left
    out. Of ids with one text only the smallest, so that copies of a text are one
    row. Its label
    is the one that most of these ids have, the larger one if there are two. An
    id with several texts has the one with the smallest hash."""
    ids = (docs.where(F.col(doc_id).isNotNull() & ~C.held_out(doc_id))
           .select(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash")))
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~C.held_out(doc_id))
             .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max((F.col(label) > 0).cast("int")).alias("label")))
    return (ids.join(known, "doc_id").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"), F.max("label").alias("label"))
            .groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), (F.avg("label") >= 0.5).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "text_hash", "label"))


def fit(docs: DataFrame, sample: DataFrame, featurize: Callable[[pa.Array], list[np.ndarray]],
        train: Callable[[list[np.ndarray], np.ndarray], bytes], doc_id: str = "doc_id", text: str = "text") -> bytes | None:
    """The model that ``train(features, labels)`` makes of the sample, or None
    if the sample is empty. ``sample`` is bounded (see above), so it is broadcast.
    Of rows that repeat an id one is learned from, so the task that fits gets at
    most as many documents as the sample has ids."""
    @C.task
    def features(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                rows = featurize(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in rows], pa.binary())],
                                                 names=["doc_id", "label", "features"])

    @C.task
    def model(batches: Iterator[pa.RecordBatch]):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        ids = np.concatenate([b.column(0).to_numpy() for b in parts])
        labels = np.concatenate([b.column(1).to_numpy() for b in parts]).astype(np.int64)
        rows = []
        for b in parts:  # views of the batches' buffers
            column = b.column(2)
            _, ends, data = column.buffers()
            at = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1]
            rows += [np.frombuffer(data, np.int32, (at[i + 1] - at[i]) // 4, at[i]) if at[i + 1] > at[i] else np.zeros(0, np.int32)
                     for i in range(len(column))]
        order = sorted(range(len(rows)), key=lambda i: (ids[i], rows[i].tobytes()))
        fitted = train([rows[i] for i in order], labels[order])
        yield pa.RecordBatch.from_arrays([pa.array([fitted], pa.binary())], names=["model"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    read = (texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
            .mapInArrow(features, "doc_id long, label int, features binary"))
    once = read.groupBy("doc_id").agg(F.min(F.struct("features", "label")).alias("m")).select("doc_id", "m.label", "m.features")
    found = once.coalesce(1).mapInArrow(model, "model binary").collect()
    return bytes(found[0].model) if found else None
