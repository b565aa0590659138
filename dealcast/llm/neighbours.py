"""Approximate nearest neighbours with a permutation index.

A bounded sample of distinct directions are the pivots: copies of a vector, and
its multiples, are one direction, however many rows they are. A vector is
represented by the order in which the pivots are near to it (cosine), and
posted in the inverted files of its ``posted`` nearest pivots. A query probes
the files of its ``probes`` nearest pivots. In a file, candidates are ranked by
the footrule distance of the two orders (the sum of the pivots' rank
differences), and the nearest ``rerank`` share of them is ranked again by the
cosine of the original vectors in double precision. A pair that meets in
several files counts in the one that is nearest to the query. The best of all
files is the result.

Every row is indexed; shares, not numbers, bound what is reranked, so the
index behaves alike at every size. Popular pivots' files are dealt out in blocks
of about ``block`` postings and ``block`` queries, so no task gets a whole hot
file. Recall is measured against brute force in the tests.

Defined results: vectors that are null, zero, or hold a null or non-finite
component, vectors without an id, and vectors of another dimension than most
take no part. Rows that repeat an id are rows of their own. A query has fewer
than ``top`` neighbours if it finds fewer. Equal scores go to the smaller id.
Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from dealcast.llm import common as C

PIVOTS = 256      # at most 256: ranks are bytes
POSTED = 4
PROBES = 64
RERANK = 0.2
LEAST = 16        # candidates of a file that are reranked in any case
BLOCK = 512


def _clean(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): the rows that take part, components as doubles."""
    v = F.col("v")
    good = (F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
            .where(good))


def _pivots(vectors: DataFrame, pivots: int) -> DataFrame:
    """(vec_id, v): of the directions with the smallest hashes the row with the
    smallest id. Only hashes of the directions are shuffled."""
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    named = vectors.withColumn("_most", most).withColumn(
        "_way", F.xxhash64(F.transform("v", lambda x: F.round(x / F.col("_most"), 9) + 0.0)))  # + 0.0: no negative zeros
    few = named.select("_way").distinct().orderBy("_way").limit(pivots)
    return (named.join(F.broadcast(few), "_way").groupBy("_way").agg(F.min(F.struct("vec_id", "v")).alias("p"))
            .orderBy("_way").select("p.vec_id", "p.v"))


def _orders(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each row, the pivots from the nearest to the farthest."""
    unit = x / np.abs(x).max(1, keepdims=True)  # so that no square over- or underflows
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")


def _indexed(clean: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, order): vectors and orders as bytes."""
    held = clean.sparkSession.sparkContext.broadcast(pivots)  # at most 256 vectors

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        dim = held.value.shape[1]
        for batch in batches:
            lists = batch.column(1)
            same = np.diff(lists.offsets.to_numpy()) == dim
            part = batch.filter(pa.array(same))
            x = part.column(1).flatten().to_numpy().reshape(-1, dim)
            order = _orders(x, held.value).astype(np.uint8) if len(x) else np.zeros((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in order], pa.binary())],
                names=["vec_id", "v", "order"])
    return clean.mapInArrow(rows, "vec_id long, v binary, `order` binary")


def _search(top: int, posted: int, rerank: float):
    """What one block of a file finds: the best ``top`` of each query."""
    def run(file: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"q": [], "query_id": [], "vec_id": [], "score": []}
        if file.num_rows and asked.num_rows:
            pivot = file.column("pivot")[0].as_py()
            row, ids = file.column("row").to_numpy(), file.column("vec_id").to_numpy()
            order = np.frombuffer(b"".join(file.column("order").to_pylist()), np.uint8).reshape(file.num_rows, -1)
            n = order.shape[1]
            rank = np.zeros(order.shape, np.int16)
            np.put_along_axis(rank, order.astype(np.int64), np.arange(n, dtype=np.int16)[None], 1)
            x = np.frombuffer(b"".join(file.column("v").to_pylist()), np.float64).reshape(file.num_rows, -1)
            x = x / np.abs(x).max(1, keepdims=True)
            length = np.sqrt((x * x).sum(1))
            files = order[:, :posted]
            for qrow, qid, qv, qo in zip(*(asked.column(f"q_{c}").to_pylist() for c in ("row", "vec_id", "v", "order"))):
                own = np.zeros(n, np.int16)
                own[np.frombuffer(qo, np.uint8)] = np.arange(n)
                # here only what has no file that is nearer to the query
                here = np.flatnonzero((own[files].min(1) == own[pivot]) & (row != qrow))
                if not len(here):
                    continue
                foot = np.abs(rank[here] - own).sum(1, dtype=np.int32)
                many = min(len(here), max(LEAST, int(np.ceil(rerank * len(here)))))
                if many < len(here):
                    here = here[np.lexsort((ids[here], foot))[:many]]
                q = np.frombuffer(qv, np.float64)
                q = q / np.abs(q).max()
                score = (x[here] * q).sum(1) / (length[here] * np.sqrt((q * q).sum()))  # equal rows, equal sums
                best = np.lexsort((ids[here], -score))[:top]
                out["q"] += [qrow] * len(best)
                out["query_id"] += [qid] * len(best)
                out["vec_id"] += ids[here][best].tolist()
                out["score"] += score[best].tolist()
        return pa.table([pa.array(out["q"], pa.int64()), pa.array(out["query_id"], pa.int64()), pa.array(out["vec_id"], pa.int64()),
                         pa.array(out["score"], pa.float64())], names=list(out))
    return run


def nearest(vectors: DataFrame, query_every: int = 50, top: int = 5, pivots: int = PIVOTS, posted: int = POSTED, probes: int = PROBES,
            rerank: float = RERANK, block: int = BLOCK, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of every row
    whose id is divisible by ``query_every``, among all other rows."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = _clean(vectors, vec_id, embedding)
    dims = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not dims:
        return empty
    sample = _pivots(clean.where(F.size("v") == dims[0].n), pivots).collect()
    unit = np.array([r.v for r in sample])
    unit /= np.abs(unit).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    index = C.materialize(_indexed(clean, unit).withColumn("row", F.monotonically_increasing_id()))

    def files(rows: DataFrame, number: int) -> DataFrame:
        number = min(number, len(sample))
        firsts = F.transform(F.sequence(F.lit(1), F.lit(number)), lambda i: F.conv(F.hex(F.substring("order", i, F.lit(1))), 16, 10).cast("int"))
        return rows.withColumn("pivot", F.explode(firsts))

    postings = files(index, posted)
    asked = files(index.where(F.col("vec_id") % query_every == 0), probes)
    # blocks of each file, by its numbers of postings and of queries: a row a pivot
    blocks = (postings.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))
              .join(asked.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")), "pivot")
              .select("pivot", F.ceil(F.col("n") / block).cast("int").alias("nb"), F.ceil(F.col("m") / block).cast("int").alias("mb")))
    blocks = F.broadcast(C.materialize(blocks))  # at most ``pivots`` rows
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (postings.join(blocks, "pivot").withColumn("b", F.pmod(F.xxhash64("row"), F.col("nb")).cast("int"))
            .withColumn("a", every("mb")).select("pivot", "a", "b", "row", "vec_id", "v", "order"))
    right = (asked.join(blocks, "pivot").withColumn("a", F.pmod(F.xxhash64("row"), F.col("mb")).cast("int"))
             .withColumn("b", every("nb")).select(*[F.col(c).alias(f"q_{c}") for c in ("pivot", "a", "b", "row", "vec_id", "v", "order")]))
    found = (left.groupBy("pivot", "a", "b").cogroup(right.groupBy("q_pivot", "q_a", "q_b"))
             .applyInArrow(_search(top, posted, rerank), "q long, query_id long, vec_id long, score double"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
