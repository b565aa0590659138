"""Ranked lexical search by dual trees.

A document's score for an item is a sum over the item's terms of a weight (by
the term's rarity) times an impact (by its count in the document and the
document's length), all in whole numbers. Both are vectors over the items'
terms, and none of their coordinates is negative.

The items form a tree, made once, and a task arranges each block of documents
that it reads as a tree as well. A node holds the largest value of each
coordinate below it, so the product of an item node and a document node bounds
every score between them. Pairs of nodes are taken from a queue, the largest
bound first: a pair whose bound is below the weakest kth best score of its
items (of all that the task has seen) is dropped with all that lies below it,
and others are split. At two leaves, each item is held against the maxima of
each few documents in the same way, and what is left is scored. Nothing that could
be among an item's best is lost: equality with the kth score is never dropped.

Texts are read once; the written vectors hold only terms of items. Document
counts, lengths and rarities are of all documents. A task gives at most k rows
an item. Items are taken in passes of about ``ITEM_ROWS`` (item, term) rows, so
that a pass's items and tree fit into a task whatever their number.

Defined results: a null or empty text has no terms and takes no part. Every row
of documents is one document, also repeated rows and those with a null id
(which come first among equal scores). Rows of items that share an id are one
item with the terms of all of them, but repeated rows count once; a null id is
an id. An empty table on either side gives no rows. Other columns are never
read, whatever their names. Terms are told apart by 64-bit hashes: a collision
of one of the items' terms with any word of the documents (a chance of about
items' terms times distinct words over 2 ** 64) would count as the term.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dealcast.llm import common as C

ITEM_ROWS = 10_000   # (item, term) rows of a pass over the documents
BLOCK_DOCS = 4096    # documents of a tree
BLOCK_ROWS = 1 << 20 # (document, term) rows of a tree, about
DOC_LEAF, ITEM_LEAF = 256, 8
TWIG = 4             # documents of a leaf that have a bound of their own
AXES = 128           # coordinates by which trees are split

#: Terms: [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+, only A-Z lower-cased.
RULE = C.ALNUM


# ------------------------------------------------------------------ trees

@dataclass
class Node:
    """Rows ``order[low:high]`` of a tree's vectors."""
    low: int
    high: int
    parts: tuple["Node", ...] = ()
    best: np.ndarray | None = None  # largest value of each coordinate
    terms: np.ndarray | None = None  # of item nodes: the coordinates of ``best``


def split(points: np.ndarray, leaf: int) -> tuple[np.ndarray, Node]:
    """An order of the points and the tree over it: halves along the line between
    two points that lie far apart."""
    order = np.arange(len(points))

    def build(low: int, high: int) -> Node:
        if high - low <= leaf:
            return Node(low, high)
        own = points[order[low:high]]
        one = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
        two = own[((own - one) ** 2).sum(1).argmax()]
        order[low:high] = order[low:high][np.argsort(own @ (two - one), kind="stable")]
        middle = low + -(-(high - low) // (2 * leaf)) * leaf
        return Node(low, high, (build(low, middle), build(middle, high)))
    return order, build(0, len(points))


def _points(columns: np.ndarray, values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Rows as unit vectors of ``AXES`` coordinates; each of theirs falls on one
    of these, with a sign, by a hash."""
    with np.errstate(over="ignore"):
        h = C.mix(columns.astype(np.uint64) + np.uint64(1))
    norm = np.sqrt(np.bincount(row, values ** 2, rows))
    own = values * np.where(h >> np.uint64(63), 1.0, -1.0) / np.where(norm > 0, norm, 1)[row]
    return np.bincount(row * AXES + (h % np.uint64(AXES)).astype(np.int64), own, rows * AXES).reshape(rows, AXES)


class Items:
    """The items' weighted vectors, in rows, and their tree."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, values: np.ndarray, kind: type):
        n = len(first) - 1
        row = np.repeat(np.arange(n), np.diff(first))
        self.order, self.root = split(_points(terms, values.astype(float), row, n), ITEM_LEAF)
        self.kind, self.n = kind, n
        self.vectors = [(terms[a:b], values[a:b].astype(kind)) for a, b in zip(first[self.order], first[self.order + 1])]
        self._maxima(self.root)

    def _maxima(self, node: Node) -> None:
        for part in node.parts:
            self._maxima(part)
        below = [(p.terms, p.best) for p in node.parts] or self.vectors[node.low:node.high]
        node.terms, at = np.unique(np.concatenate([t for t, _ in below]), return_inverse=True)
        node.best = np.zeros(len(node.terms), self.kind)
        np.maximum.at(node.best, at, np.concatenate([v for _, v in below]))

    def matrix(self, node: Node) -> np.ndarray:
        """(terms of the node, items) of a leaf."""
        out = np.zeros((len(node.terms), node.high - node.low), self.kind)
        for k, (terms, values) in enumerate(self.vectors[node.low:node.high]):
            out[np.searchsorted(node.terms, terms), k] = values
        return out


class Search:
    """An item's k best documents among all blocks that a task has shown."""

    def __init__(self, items: Items, k: int, weight: np.ndarray):
        self.items, self.k, self.weight = items, k, weight
        self.found: list[list[tuple]] = [[] for _ in range(items.n)]  # (-score, id is known, id), in order
        self.kth = np.zeros(items.n)  # what a score must reach
        self.scored = self.shown = 0  # (item, document) pairs

    def block(self, ids: np.ndarray, null: np.ndarray, first: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """Documents in rows ``first`` of (terms, values), with one term at least."""
        n = len(ids)
        row = np.repeat(np.arange(n), np.diff(first))
        order, root = split(_points(terms, values * self.weight[terms].astype(float), row, n), DOC_LEAF)
        present, column = np.unique(terms, return_inverse=True)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        by_place = np.argsort(place[row], kind="stable")
        column, values = column[by_place], values[by_place].astype(self.items.kind)
        start = np.concatenate([[0], np.cumsum(np.diff(first)[order])])  # of each document's terms, in the tree's order
        twigs = np.zeros((-(-n // TWIG), len(present)), self.items.kind)
        np.maximum.at(twigs, (place[row][by_place] // TWIG, column), values)

        def maxima(node: Node) -> np.ndarray:
            node.best = np.maximum(*map(maxima, node.parts)) if node.parts else twigs[node.low // TWIG:-(-node.high // TWIG)].max(0)
            return node.best

        maxima(root)
        shared: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of an item node: which of its terms are here, and where

        def bound(items: Node, docs: Node):
            if id(items) not in shared:
                here = np.minimum(np.searchsorted(present, items.terms), len(present) - 1)
                own = np.flatnonzero(present[here] == items.terms)
                shared[id(items)] = own, here[own]
            own, here = shared[id(items)]
            return items.best[own] @ docs.best[here]

        self.shown += n * self.items.n
        turn = 0
        queue = [(-bound(self.items.root, root), turn, self.items.root, root)]
        while queue:
            most, _, i, d = heapq.heappop(queue)
            if -most <= 0 or -most < self.kth[i.low:i.high].min():
                continue
            if i.parts or d.parts:
                for x in i.parts or (i,):
                    for y in d.parts or (d,):
                        turn += 1
                        heapq.heappush(queue, (-bound(x, y), turn, x, y))
                continue
            # two leaves: each item against each twig, the one with the largest bound first
            own, here = shared[id(i)]
            weights = self.items.matrix(i)[own]
            low = d.low // TWIG
            bounds = twigs[low:-(-d.high // TWIG)][:, here] @ weights
            lookup = np.zeros((len(present), i.high - i.low), self.items.kind)
            lookup[here] = weights
            left = np.flatnonzero((bounds >= np.maximum(self.kth[i.low:i.high], 1)).any(1))
            for t in left[np.argsort(-bounds[left].max(1), kind="stable")].tolist():
                least = np.maximum(self.kth[i.low:i.high], 1)
                some = np.flatnonzero(bounds[t] >= least)
                if not len(some):
                    continue
                x, y = (low + t) * TWIG, min(n, (low + t + 1) * TWIG)
                a, b = start[x], start[y]
                scores = np.add.reduceat(lookup[column[a:b]][:, some] * values[a:b, None], start[x:y] - a)  # (documents, items)
                self.scored += scores.size
                for k in np.flatnonzero((scores >= least[some]).any(0)).tolist():
                    self._offer(i.low + int(some[k]), scores[:, k], ids[order[x:y]], null[order[x:y]])

    def _offer(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.kth[item]) & (scores > 0))
        new = [(-int(scores[j]), not null[j], int(ids[j])) for j in good.tolist()]
        self.found[item] = sorted(self.found[item] + new)[:self.k]
        if len(self.found[item]) == self.k:
            self.kth[item] = -self.found[item][-1][0]


# ------------------------------------------------------------------ statistics

@dataclass
class Terms:
    """A pass's items: ``ids``, and the counts ``times`` of terms ``hashes[which]``
    in rows ``first``."""
    ids: list
    hashes: np.ndarray
    first: np.ndarray
    which: np.ndarray
    times: np.ndarray


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, times): the terms of each item, as 64-bit hashes."""
    kind = dict(items.dtypes)[item_id]

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                words = C.read_words(part.column(1), RULE)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(words.doc)), pa.array(words.hash.view(np.int64))], names=["item_id", "term"])
    own = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    return own.mapInArrow(rows, f"item_id {kind}, term long").groupBy("item_id", "term").agg(F.count("*").alias("times"))


def passes(terms: DataFrame, most: int = ITEM_ROWS) -> Iterator[Terms]:
    """All items in groups of about ``most`` rows of ``terms`` (a written table)."""
    groups = max(1, -(-terms.count() // most))
    for g in range(groups):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).orderBy(F.col("item_id").asc_nulls_first(), "term").collect()
        if own:
            hashes, which = np.unique(np.array([r.term for r in own], np.int64).view(np.uint64), return_inverse=True)
            new = [k for k, r in enumerate(own) if k == 0 or r.item_id != own[k - 1].item_id]
            yield Terms([own[k].item_id for k in new], hashes, np.array(new + [len(own)], np.int64), which, np.array([r.times for r in own], np.int64))


def vectors(docs: DataFrame, hashes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of documents with at least one word: how many,
    and how often each of the terms (numbers into the sorted ``hashes``) occurs,
    as little-endian 32-bit numbers."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                words = C.read_words(part.column(1), RULE)
                n = words.counts()
                at = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
                own = hashes[at] == words.hash
                key, count = np.unique(words.doc[own].astype(np.int64) * len(hashes) + at[own], return_counts=True)
                ends = 4 * np.searchsorted(key, np.arange(part.num_rows + 1) * len(hashes)).astype(np.int32)
                packed = [pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(x.astype("<i4"))])
                          for x in (key % len(hashes), count)]
                some = pa.array(n > 0)
                yield pa.RecordBatch.from_arrays([x.filter(some) for x in (part.column(0), pa.array(n), *packed)], names=["doc_id", "n", "terms", "counts"])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(rows, "doc_id long, n long, terms binary, counts binary")


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """In how many of the documents each term occurs. A task gives one row a
    term, so at most ``size`` sums come to the driver."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["term", "n"])
    out = np.zeros(size, np.int64)
    for r in found.select("terms").mapInArrow(rows, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    return out


# ------------------------------------------------------------------ the operator

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, rows = [], 0, 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            held.append(part)
            docs += part.num_rows
            rows += sum(len(x.as_py()) for x in part.column(2)) // 4
            if docs >= BLOCK_DOCS or rows >= BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held, docs, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _best(found: DataFrame, terms: Terms, n_docs: int, n_words: int, frequency: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item (its number)."""
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * frequency + 1))).astype(np.int64)
    values = weight[terms.which] * terms.times
    # sums of whole numbers are exact as doubles up to 2 ** 53, as one impact is below 10 ** 6
    exact = int(np.add.reduceat(values, terms.first[:-1]).max()) * 10 ** 6 < 1 << 53
    kind = np.float64 if exact else np.int64

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        search = Search(Items(terms.first, terms.which, values, kind), k, weight)
        for block in _blocks(batches):
            ids, n = block.column("doc_id").combine_chunks(), block.column("n").to_numpy()
            own, count = (block.column(x).to_pylist() for x in ("terms", "counts"))
            first = np.cumsum([0] + [len(x) // 4 for x in own])
            times = np.frombuffer(b"".join(count), "<i4").astype(np.int64)
            m = np.repeat(25 + 75 * n * n_docs // n_words, np.diff(first))
            search.block(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), first,
                         np.frombuffer(b"".join(own), "<i4").astype(np.int64), 10 ** 9 * times // (1000 * times + 8 * m))
        out = [(int(search.items.order[i]), doc if known else None, -score) for i, best in enumerate(search.found) for score, known, doc in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["item", "doc_id", "score"])
    return found.where(F.length("terms") > 0).mapInArrow(rows, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           item_rows: int = ITEM_ROWS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a
    score above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    C.small_batches(spark)
    kind = dict(items.dtypes)[item_id]
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for terms in passes(C.materialize(item_terms(items, item_id, text)), item_rows):
        found = C.materialize(vectors(docs, terms.hashes, doc_id, text))
        whole = found.agg(F.count("*").alias("n"), F.sum("n").alias("words")).first()
        if not whole.n:
            continue
        best = _best(found, terms, whole.n, whole.words, document_frequencies(found, len(terms.hashes)), k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
        names = spark.createDataFrame(list(enumerate(terms.ids)), f"item long, item_id {kind}")  # at most ITEM_ROWS rows
        first = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out = out.unionByName(first.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
