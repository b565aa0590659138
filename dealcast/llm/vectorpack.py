"""Vector bin packing of training examples by the dot-product heuristic.

A sequence has three limits at once: tokens, segments (pieces of examples) and
tokens that bear loss. An example's demand is a vector of the three. A task
packs one sequence after the other from a pool of examples: of those that fit,
the one whose demand has the largest weighted dot product with what the
sequence has left goes in (each dimension in parts of its limit, weighted by
the pool's mean demand, so that the scarce dimension counts most), until none
fits. What is left of the tokens is then filled by cutting an example. So a
sequence is full, unless another limit is reached first; then it is cut back to
a power of two, at which sequences need no padding, and so is a task's last one.

Examples are tokenized, packed and written by the task that reads them: nothing
is shuffled, a task holds one pool (``WINDOW`` examples of at most a sequence
each), and every example is read once. Sequences hold examples that lie near
each other in the table; shuffle the sequences, or the table, for training.

Defined results: a null or empty text is one piece of the end id (and its
prompt); every row gives its own pieces, repeated rows and rows with a null id
too. An empty table gives no rows. Of ties, the example that the task read
first is taken. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from dealcast.llm import common as C
from dealcast.llm.tokens import SLICE_BYTES, byte_vocabulary, tokenizer

WINDOW = 2048  # examples in a task's pool; it is filled again when half are packed


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most."""
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("each limit must be 1 at least")


# ------------------------------------------------------------------ one task

class _Example:
    """One row's ids; the first ``prompt`` of them bear no loss."""

    __slots__ = ("doc_id", "ids", "prompt")

    def __init__(self, doc_id, ids: np.ndarray, prompt: int):
        self.doc_id, self.ids, self.prompt = doc_id, ids, prompt

    def loss(self, start: int, length: int) -> int:
        return max(0, start + length - max(start, self.prompt))

    def longest(self, start: int, tokens: int, loss: int) -> int:
        """Length of the longest piece from ``start`` within both bounds."""
        return min(len(self.ids) - start, tokens, max(0, self.prompt - start) + loss)


class Pool:
    """Pieces that wait, in the order in which they came, with their demands."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.items: list[tuple[_Example, int]] = []  # (example, start): the rest of it, or a part of its rest
        self.length = np.zeros(0, np.int64)
        self.loss = np.zeros(0, np.int64)
        self.alive = np.zeros(0, bool)
        self.count = 0
        self.tokens = self.losses = 0  # of all pieces that wait

    def add(self, pieces: list[tuple[_Example, int, int]]) -> None:
        """Take in (example, start, length); rows of packed pieces go."""
        keep = np.flatnonzero(self.alive)
        self.items = [self.items[i] for i in keep.tolist()] + [p[:2] for p in pieces]
        self.length = np.concatenate([self.length[keep], np.array([p[2] for p in pieces], np.int64)])
        self.loss = np.concatenate([self.loss[keep], np.array([e.loss(s, n) for e, s, n in pieces], np.int64)])
        self.alive = np.ones(len(self.items), bool)
        self.count = len(self.items)
        self.tokens, self.losses = int(self.length.sum()), int(self.loss.sum())

    def take(self, i: int) -> tuple[_Example, int, int]:
        n = int(self.length[i])
        self.alive[i] = False
        self.count -= 1
        self.tokens -= n
        self.losses -= int(self.loss[i])
        return (*self.items[i], n)

    def sequence(self) -> list[tuple[_Example, int, int]]:
        """The next sequence's pieces."""
        lim = self.limits
        left = [lim.tokens, lim.segments, lim.loss]
        weight = [self.tokens / self.count / lim.tokens ** 3, 1 / lim.segments ** 3, self.losses / self.count / lim.loss ** 3]
        packed: list[tuple[_Example, int, int]] = []
        while left[0] and left[1] and self.count:
            dot = self.length * (weight[0] * left[0]) + self.loss * (weight[2] * left[2]) + weight[1] * left[1]
            dot[~self.alive | (self.length > left[0]) | (self.loss > left[2])] = -1
            i = int(dot.argmax())
            if dot[i] < 0:
                break
            packed.append(self.take(i))
            left = [left[0] - int(self.length[i]), left[1] - 1, left[2] - int(self.loss[i])]
        if left[0] and left[1] and self.count:
            # none fits whole: the largest whose beginning fills the rest of the tokens is cut
            largest = np.where(self.alive & (self.length > left[0]), self.length, 0)
            while largest[i := int(largest.argmax())]:
                example, start = self.items[i]
                if example.loss(start, left[0]) <= left[2]:
                    packed.append((example, start, left[0]))
                    self.items[i] = (example, start + left[0])
                    self.length[i] -= left[0]
                    self.tokens -= left[0]
                    self.losses -= int(self.loss[i])
                    self.loss[i] = example.loss(start + left[0], int(self.length[i]))
                    self.losses += int(self.loss[i])
                    left[0] = 0
                    break
                largest[i] = 0
        fill = lim.tokens - left[0]
        if left[0] and fill & (fill - 1):
            packed = self._cut_back(packed, fill - (1 << (fill.bit_length() - 1)))
        return packed

    def _cut_back(self, packed: list[tuple[_Example, int, int]], extra: int) -> list[tuple[_Example, int, int]]:
        """``packed`` without its last ``extra`` tokens, which go back."""
        back = []
        while extra:
            example, start, length = packed.pop()
            off = min(extra, length)
            extra -= off
            if length > off:
                packed.append((example, start, length - off))
            back.append((example, start + length - off, off))
        self.add(back[::-1])
        return packed


def _sequences(examples: Iterator[_Example], limits: Limits, window: int) -> Iterator[list[tuple[_Example, int, int]]]:
    """All sequences of a task's examples: (example, start, length) each."""
    pool, coming = Pool(limits), []
    for example in examples:
        start = 0
        while start < len(example.ids):
            n = example.longest(start, limits.tokens, limits.loss)
            if n == limits.tokens:
                yield [(example, start, n)]
            else:
                coming.append((example, start, n))
            start += n
        if pool.count + len(coming) >= window:
            pool.add(coming)
            coming = []
            while pool.count > window // 2:
                yield pool.sequence()
    pool.add(coming)
    while pool.count:
        yield pool.sequence()


# ------------------------------------------------------------------ the operator

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("loss_tokens", pa.int64()), ("ids", pa.binary()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_examples(docs: DataFrame, limits: Limits = Limits(), end_id: int = 1, path: str | None = None, keep_ids: bool = True,
                  doc_id: str = "doc_id", text: str = "text", prompt: str | None = None, window: int = WINDOW) -> DataFrame:
    """Every piece with its place: doc_id, start (ids of its example before it),
    length, loss_tokens, ids (little-endian unsigned 32-bit; only with
    ``keep_ids``), ids_crc32, doc_tokens (ids of the example), sequence_id,
    offset. An example is the ids of the column ``prompt`` (if named; they bear
    no loss), those of ``text``, and the end id."""
    path = path or byte_vocabulary()

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[_Example]:
        model = tokenizer(path)
        for batch in batches:
            for part in C.text_slices(batch, "text", SLICE_BYTES):
                ids, at = model.ids(part.column(1))
                before, to = model.ids(part.column(2)) if prompt else (ids[:0], np.zeros(part.num_rows + 1, np.int64))
                for k, key in enumerate(part.column(0).to_pylist()):
                    yield _Example(key, np.concatenate([before[to[k]:to[k + 1]], ids[at[k]:at[k + 1]], [end_id]]).astype("<u4"), int(to[k + 1] - to[k]))

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 36
        out: list[tuple] = []
        held = 0
        for sequence in _sequences(examples(batches), limits, window):
            offset = 0
            for example, start, length in sequence:
                ids = example.ids[start:start + length].tobytes()
                out.append((example.doc_id, start, length, example.loss(start, length), ids if keep_ids else None, zlib.crc32(ids),
                            len(example.ids), number, offset))
                offset += length
                held += len(ids) * keep_ids
            number += 1
            if len(out) >= 4096 or held >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SCHEMA)], schema=_SCHEMA)

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *([F.col(prompt).alias("prompt")] if prompt else [])]
    placed = docs.select(*columns).mapInArrow(
        rows, "doc_id long, start long, length long, loss_tokens long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return placed if keep_ids else placed.drop("ids")


def instruction_examples(conversations: DataFrame, answers: str = "assistant") -> DataFrame:
    """(doc_id, turn, prompt, text) for ``pack_examples``: each answer with the
    turn before it. Joined by conversation and turn together, so that a
    conversation of any length is dealt out over all tasks."""
    turns = conversations.select(F.col("conv_id").alias("doc_id"), "turn", "role", "text")
    asked = turns.where(F.coalesce(F.col("role") != answers, F.lit(True))).select("doc_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    asked = asked.groupBy("doc_id", "turn").agg(F.min("prompt").alias("prompt"))
    return turns.where(F.col("role") == answers).join(asked, ["doc_id", "turn"], "left").select("doc_id", "turn", "prompt", "text")


def padding(placed: DataFrame, tokens: int = 2048) -> DataFrame:
    """(sequences, tokens, padded): how many ids the sequences of ``placed``
    hold, and how many more they take when padded to ``tokens``, except at a
    power of two."""
    fill = placed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    bare = F.col("fill").bitwiseAND(F.col("fill") - 1) == 0
    return fill.agg(F.count("*").alias("sequences"), F.coalesce(F.sum("fill"), F.lit(0)).alias("tokens"),
                    F.coalesce(F.sum(F.when(~bare, tokens - F.col("fill")).otherwise(0)), F.lit(0)).alias("padded"))
