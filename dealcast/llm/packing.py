"""Best-fit packing of token pieces into fixed sequences, with local search.

Documents are tokenized whole and end with one id. Only longer ones are cut,
into pieces of ``capacity`` tokens; a full piece is a sequence of its own. All
other pieces are dealt by a hash into groups of about ``GROUP`` pieces, each
group is packed by one task, and a group leaves at most its last sequences
underfull, so the number of groups hardly counts in the result.

In a group, pieces go longest first into the fullest sequence with room
(best fit). Then underfull sequences exchange pieces: one is moved, one is
swapped for a smaller one, or two are swapped for one, whenever a fuller
sequence gets fuller by it, so that the sum of squared fills grows. Sequences
that become empty are dropped; the search ends when the total can't need fewer
sequences, or when a whole pass over the underfull ones finds no exchange.

Defined results: a null or empty text is one piece of the end id; every row
gives its pieces, repeated rows their own, rows with a null id too (their
doc_id is null). An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from dealcast.llm import common as C
from dealcast.llm.tokens import default_vocabulary, token_slices

CAPACITY = 2048
GROUP = 4096       # pieces that a task packs at once, about


# ------------------------------------------------------------------ pieces

def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, path: str | None = None,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of each document; ``ids``
    are little-endian unsigned 32-bit numbers."""
    path = path or default_vocabulary()

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for part, ids, offsets in token_slices(batches, path):
            n = part.num_rows
            sizes = np.diff(offsets) + 1
            ends = np.cumsum(sizes)
            whole = np.full(int(ends[-1]) if n else 0, end_id, "<u4")
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = ids
            cuts = -(-sizes // capacity)
            owner = np.repeat(np.arange(n), cuts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            first = (ends - sizes)[owner] + start
            bytes_at = np.concatenate([first * 4, [4 * len(whole)]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(bytes_at), pa.py_buffer(whole)])],
                names=["doc_id", "piece", "start", "length", "ids"])
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, piece int, start long, length long, ids binary"))


# ------------------------------------------------------------------ one group

def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of indices), longest piece first into the fullest bin with room."""
    bins: list[list[int]] = []
    with_gap: dict[int, list[int]] = {}
    gaps = 0  # bit g: a bin with a gap of g exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = gaps >> n
        if room:
            gap = n + (room & -room).bit_length() - 1
            own = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps &= ~(1 << gap)
            bins[own].append(i)
        else:
            gap, own = capacity, len(bins)
            bins.append([i])
        if gap - n:
            with_gap.setdefault(gap - n, []).append(own)
            gaps |= 1 << (gap - n)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins, each of which increases the sum of
    squared fills, until no bin has one or the bins are as few as the total
    allows. The sum is a whole number with a bound, so this ends."""
    total = int(lengths.sum())
    least = -(-total // capacity)
    owner = np.full(len(lengths), -1, np.int64)
    for b, own in enumerate(bins):
        owner[own] = b
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    alive = int((fill > 0).sum())

    def move(i: int, to: int) -> None:
        bins[owner[i]].remove(i)
        fill[owner[i]] -= lengths[i]
        bins[to].append(i)
        fill[to] += lengths[i]
        owner[i] = to

    def exchange(a: int):
        """(gap that stays in the target, what leaves a, what comes back, target)
        of the exchange that fills another underfull bin, as full as ``a`` at
        least, the most; a move before others."""
        gap = np.where((fill >= fill[a]) & (fill < capacity), capacity - fill, 0)
        gap[a] = 0
        if not gap.any():
            return None
        own = np.array(bins[a])
        own = own[np.argsort(lengths[own], kind="stable")]
        own_sizes = lengths[own]
        k = int(np.searchsorted(own_sizes, gap.max(), "right")) - 1
        if k >= 0:
            n = int(own_sizes[k])
            t = int(np.where(gap >= n, gap, capacity + 1).argmin())
            return int(gap[t]) - n, (int(own[k]),), None, t
        # one or two pieces for a smaller one: what may come back, by what may leave
        items = np.flatnonzero(gap[owner] > 0)
        back, room = lengths[items], gap[owner[items]]
        best = None
        # of one piece, or of a sum of two, the largest that is no larger than back + room does best
        for two in (False, True):
            if two:
                if len(own) < 2:
                    break
                x, y = np.triu_indices(len(own), 1) if len(own) <= 64 else _close_pairs(own_sizes, back + room)
                sums = own_sizes[x] + own_sizes[y]
                rank = np.argsort(sums, kind="stable")
                sums = sums[rank]
            else:
                sums = own_sizes
            at = np.searchsorted(sums, back + room, "right") - 1
            ok = np.flatnonzero(at >= 0)
            ok = ok[sums[at[ok]] > back[ok]]
            if len(ok):
                stays = room[ok] - (sums[at[ok]] - back[ok])
                k = int(ok[np.argmin(stays)])
                leave = (int(own[at[k]]),) if not two else (int(own[x[rank[at[k]]]]), int(own[y[rank[at[k]]]]))
                if best is None or int(stays.min()) < best[0]:
                    best = (int(stays.min()), leave, int(items[k]), int(owner[items[k]]))
                if best[0] == 0:
                    break
        return best

    changed = True
    while alive > least and changed:
        changed = False
        under = np.flatnonzero((fill > 0) & (fill < capacity))
        for a in under[np.argsort(fill[under], kind="stable")].tolist():
            while bins[a] and fill[a] < capacity and (found := exchange(a)):
                _, leave, back_item, target = found
                if back_item is not None:
                    move(back_item, a)
                for i in leave:
                    move(i, target)
                changed = True
            if not bins[a]:
                alive -= 1
                if alive <= least:
                    break
    return [b for b in bins if b]


def _close_pairs(sizes: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For many pieces: of each piece (sorted by size) with each bound, the
    largest partner that keeps the sum within it."""
    x, bound = np.repeat(np.arange(len(sizes)), len(bounds := np.unique(most))), np.tile(bounds, len(sizes))
    y = np.searchsorted(sizes, bound - sizes[x], "right") - 1
    y = np.minimum(y, x - 1)  # the smaller one of the pair, so that no piece is taken twice
    ok = y >= 0
    return y[ok], x[ok]


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece of a group."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, own in enumerate(bins):
        own = np.sort(np.array(own))
        where[own] = b
        offset[own] = np.cumsum(lengths[own]) - lengths[own]
    return where, offset


# ------------------------------------------------------------------ the operator

def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece and length, no longer than
    ``capacity``) with sequence_id and offset."""
    columns = pieces.columns
    named = pieces.withColumn("_row", F.monotonically_increasing_id())
    full = named.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    loose = named.where(F.col("length") < capacity)
    groups = max(1, -(-loose.count() // group))

    def rows(part: pa.Table) -> pa.Table:
        part = part.sort_by([("_row", "ascending")])
        where, offset = place(part.column("length").to_numpy(), capacity)
        base = part.column("_group").to_numpy()
        return (part.append_column("sequence_id", pa.array((base.astype(np.int64) << 32) + where))
                .append_column("offset", pa.array(offset)).drop_columns(["_group"]))

    schema = T.StructType(named.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    packed = loose.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("long")).groupBy("_group").applyInArrow(rows, schema)
    return full.unionByName(packed).select(*columns, "sequence_id", "offset")


def packed_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, path: str | None = None, keep_ids: bool = False,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32 (and
    ids with ``keep_ids``), sequence_id, offset. The ids are not shuffled
    unless they are asked for."""
    pieces = token_pieces(docs, capacity, end_id, path, doc_id, text).withColumn("ids_crc32", F.crc32("ids"))
    return pack(C.materialize(pieces if keep_ids else pieces.drop("ids")), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): whole sequences from placed pieces
    with ids. A sequence has at most ``capacity`` pieces."""
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return parts.select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"),
                        F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
