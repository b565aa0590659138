"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf. The leaves of a group are numbered in order; while several
nodes remain, each two consecutive ones (the last may be alone) become their
digest, up to the group's subroot, and the subroots in order of their groups
become the root in the same way.

A tree's nodes are labelled (level, number) and visited in the order of their
labels; what a node has to say to its parent waits in a priority queue under
the parent's label. Proofs go the other way: in reversed order each node gives
its children the siblings on their way up. The queue is an external one. Trees
are cut into blocks of ``2 ** BITS`` neighbouring nodes of a level; the messages
between blocks are rows that a shuffle deals out by the receiving block, and
within a block a heap holds them, so that no task has more than one block and a
group of any size is worked on by all tasks. A round of blocks leaves one node
in ``2 ** BITS``: five rounds reach 10 ** 18 leaves.

Defined results: rows ascend by their order column, nulls first; rows that tie
ascend by their leaf. Repeated rows are leaves of their own. A null group is a
group. An empty table has no rows and no root. A field that is null differs
from one that is empty. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dealcast.llm import common as C

BITS = 11
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUNS_BROADCAST = 500_000  # rows (32 MB) of the offsets that may be broadcast
_NODES = "g long, pos long, n long, digest string"


def digest_of(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


# ------------------------------------------------------------------ leaves

def leaf_digest(fields: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the fields, each with its UTF-8 length."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], number: str, total: str) -> DataFrame:
    """``df`` with each row's number from 0 in its group by ``order`` (nulls
    first) and the group's size. Rows are range-partitioned by group and order,
    so a group of any size is dealt over many tasks; only (partition, group)
    counts are summed up, in a window of at most one row a partition."""
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    # where rows tie in all of that, their place in the input still deals them out
    placed = df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(C.partitions(spark), *keys, F.col("_place"))
    rows = C.materialize(placed.sortWithinPartitions(*keys).drop("_place").withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    runs = rows.groupBy(*by, part.alias("_part")).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    runs = C.materialize(runs.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"), "_first", F.sum("_n").over(group).alias(total),
        F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    on = part == F.col("_of")
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (rows.join(C.broadcast_if_small(runs, RUNS_BROADCAST), on)
            .select(*df.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias(number), total))


# ------------------------------------------------------------------ one block

def forward(digests: list[str], levels: int) -> list[list[str]]:
    """Digests of a block's nodes, level by level, from those of its lowest one."""
    out: list[list[str]] = [list(digests)] + [[] for _ in range(levels)]
    queue = [((1, i >> 1), i, d) for i, d in enumerate(digests)] if levels else []
    heapq.heapify(queue)
    while queue:
        label, _, heard = heapq.heappop(queue)
        while queue and queue[0][0] == label:
            heard += heapq.heappop(queue)[2]
        level, number = label
        own = digest_of(heard)
        out[level].append(own)
        if level < levels:
            heapq.heappush(queue, ((level + 1, number >> 1), number, own))
    return out


def backward(nodes: list[list[str]], proof: str, path: str) -> list[tuple[str, str]]:
    """(proof, path) of each node of the lowest level, from those of the block's
    top. ``proof``: the siblings' digests, upward; ``path``: for each level L or
    R, where the sibling stands, or 1 for a node that is alone."""
    out: list[tuple[str, str]] = [("", "")] * len(nodes[0])
    queue = [((-(len(nodes) - 1), 0), proof, path)]
    while queue:
        (level, number), proof, path = heapq.heappop(queue)
        level, number = -level, -number
        if level == 0:
            out[number] = (proof, path)
            continue
        left, right = 2 * number, 2 * number + 1
        if right < len(nodes[level - 1]):
            heapq.heappush(queue, ((1 - level, -right), nodes[level - 1][left] + proof, "L" + path))
            heapq.heappush(queue, ((1 - level, -left), nodes[level - 1][right] + proof, "R" + path))
        else:
            heapq.heappush(queue, ((1 - level, -left), proof, "1" + path))
    return out


def fold(leaf: str, proof: str, path: str) -> str:
    """The root that a leaf and a proof lead to."""
    at = 0
    for side in path:
        other = "" if side == "1" else proof[at:at + 64]
        at += len(other)
        leaf = digest_of(other + leaf if side == "L" else leaf + other)
    return leaf


def _levels(n: int, bits: int, done: int) -> int:
    """Levels of a block's tree when ``done`` of its group's levels lie below."""
    return min(bits, max(0, (n - 1).bit_length() - done))


# ------------------------------------------------------------------ all blocks

def _tops(done: int, bits: int):
    def rows(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        n = block.column("n")[0].as_py()
        root = forward(block.column("digest").to_pylist(), _levels(n, bits, done))[-1]
        return pa.table({"g": [key[0].as_py()], "pos": [key[1].as_py()], "n": [n], "digest": root})
    return rows


def climb(nodes: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """Rounds of (g, pos, n, digest): the given lowest level first, the groups'
    roots last. ``nodes`` must be written."""
    n = nodes.agg(F.max("n")).first()[0] or 1
    rounds = [nodes]
    for done in range(0, (n - 1).bit_length(), bits):
        below = rounds[-1].select("g", "pos", "n", "digest")
        rounds.append(C.materialize(below.groupBy("g", F.shiftright("pos", bits).alias("_block")).applyInArrow(_tops(done, bits), _NODES)))
    return rounds


_SENT = "g long, pos long, proof string, path string, subroot string, root string"


def descend(rounds: list[DataFrame], sent: DataFrame, bits: int = BITS) -> DataFrame:
    """(g, pos, proof, path, subroot, root) for the second round's nodes, or for
    the lowest ones if there is only one round, from those of the groups' roots."""
    for k in range(len(rounds) - 2, 0, -1):
        sent = C.materialize(_deliver(rounds[k].select("g", "pos", "n", "digest"), sent, k, bits).applyInArrow(_suffixes(k, bits), _SENT))
    return sent


def _deliver(nodes: DataFrame, sent: DataFrame, k: int, bits: int):
    return nodes.groupBy("g", F.shiftright("pos", bits).alias("_block")).cogroup(sent.groupBy("g", "pos"))


def _suffixes(k: int, bits: int):
    def rows(block: pa.Table, sent: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        one = sent.to_pylist()[0]
        found = backward(forward(block.column("digest").to_pylist(), _levels(block.column("n")[0].as_py(), bits, k * bits)), one["proof"], one["path"])
        return pa.table([block.column("g"), block.column("pos"), [p for p, _ in found], [p for _, p in found],
                         pa.array([one["subroot"]] * len(found), pa.string()), [one["root"]] * len(found)], names=["g", "pos", "proof", "path", "subroot", "root"])
    return rows


def manifest(leaves: DataFrame, group: str = "lang", order: str = "doc_id", leaf: str = "leaf", check: str | None = None,
             keep_proofs: bool = False, bits: int = BITS) -> DataFrame:
    """One row a leaf: order column (as a long), group, leaf, subroot, root,
    proof_sha256 (of the siblings' digests in a row), folded_root (recomputed from
    the digest in column ``check``, or the leaf) and verified (that it equals
    the root); with ``keep_proofs`` also proof and path, for ``fold``."""
    own = leaves.select(F.col(group).alias("lang"), F.col(order).cast("long").alias("doc_id"), F.col(leaf).alias("leaf"),
                        F.col(check or leaf).alias("check"))
    rows = C.materialize(numbered(own, ["lang"], ["doc_id", "leaf"], "pos", "n"))
    groups = C.materialize(numbered(rows.select("lang").distinct(), [], ["lang"], "g", "n_groups").withColumnRenamed("lang", "_lang"))
    nodes = C.materialize(rows.join(C.broadcast_if_small(groups, RUNS_BROADCAST), F.col("lang").eqNullSafe(F.col("_lang")))
                          .select("g", "pos", "n", F.col("leaf").alias("digest"), "doc_id", "lang", "check"))
    rounds = climb(nodes, bits)
    # the subroots are the leaves of one more tree
    subroots = C.materialize(rounds[-1].join(groups, "g").select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"),
                                                                  F.col("n_groups").alias("n"), "digest"))
    above = climb(subroots, bits)
    root = above[-1].select("g", "pos", F.lit("").alias("proof"), F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"),
                            F.col("digest").alias("root"))
    sent = descend(above, root, bits)
    if len(above) > 1:
        sent = _deliver(subroots, sent, 0, bits).applyInArrow(_suffixes(0, bits), _SENT)
    of = subroots.select("pos", F.col("digest").alias("_subroot"))
    sent = C.materialize(sent.join(of, "pos").select(F.col("pos").alias("g"), F.lit(0).cast("long").alias("pos"), "proof", "path",
                                                     F.col("_subroot").alias("subroot"), "root"))
    sent = descend(rounds, sent, bits)

    def proofs(block: pa.Table, sent: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        one = sent.to_pylist()[0]
        digests = block.column("digest").to_pylist()
        found = backward(forward(digests, _levels(block.column("n")[0].as_py(), bits, 0)), one["proof"], one["path"])
        folded = [fold(c, *p) for c, p in zip(block.column("check").to_pylist(), found)]
        n = len(found)
        return pa.table([block.column("doc_id"), block.column("lang"), block.column("digest"), [one["subroot"]] * n, [one["root"]] * n,
                         [digest_of(p) for p, _ in found], folded, [f == one["root"] for f in folded],
                         *([[p for p, _ in found], [p for _, p in found]] if keep_proofs else [])],
                        names=["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
                               *(["proof", "path"] if keep_proofs else [])])

    schema = ("doc_id long, lang string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + (", proof string, path string" if keep_proofs else ""))
    return _deliver(nodes, sent, 0, bits).applyInArrow(proofs, schema)


def tampered_documents(docs: DataFrame, every: int = 7) -> DataFrame:
    """(doc_id, lang, leaf, check) of documents: ``check`` is the leaf that the
    row has after one is added to ``n_chars`` where ``every`` divides the crc32
    of its id's decimal text, else the leaf."""
    own = [F.col(c) for c in FIELDS]
    changed = [(F.col(c) + 1) if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    return docs.select("doc_id", "lang", leaf_digest(own).alias("leaf"), F.when(hit, leaf_digest(changed)).alias("changed")).select(
        "doc_id", "lang", "leaf", F.coalesce("changed", "leaf").alias("check"))
