"""Helpers shared by the operators: tables, scratch tables, checked broadcasts
and the vectorised word reader.

The word reader works on UTF-8 bytes. Every separator and every letter that is
lower-cased by the operators' word rules is ASCII, and all bytes of a
non-ASCII character are >= 0x80, so byte classes decide words exactly.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dealcast import session
from dealcast.session import materialize

__all__ = ["materialize"]

SLICE_BYTES = 1 << 20  # text bytes that a task turns into arrays at once; they take about 60 times as much


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are large: at most ``rows`` rows go to a Python worker at once, so
    that a batch takes some megabytes on either side. A smaller setting stays."""
    if not 0 < int(spark.conf.get(BATCH_ROWS, "0")) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted),
    else without: the join then shuffles both sides. ``df`` must be cheap to
    count (a written table)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def release(spark: SparkSession, *written: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    names = {os.path.basename(os.path.dirname(f)) for df in written for f in df.inputFiles()[:1]}
    session.release(spark, [t for t in session.scratch_tables() if os.path.basename(t) in names])


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Until the end, an action's shuffle files go when it ends; otherwise they
    stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def held_out(doc_id: str) -> Column:
    """True for the rows that no model learns from: crc32 of the id's decimal
    text is divisible by 5. A null id is never learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


# ------------------------------------------------------------------ tasks

def give_back() -> None:
    """Return freed memory to the system: Python workers are used again, and
    what one task has freed counts against the executor until then."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def task(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A mapper of a task's batches that gives its memory back at the end."""
    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            give_back()
    return run


# ------------------------------------------------------------------ Arrow slices

def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of text each
    (one row at least), so that a task's arrays stay small whatever the
    batch's rows hold."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the rows' offsets. Null: empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if col.offset:
        col = pa.concat_arrays([col])
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


# ------------------------------------------------------------------ words

class WordRule:
    """Which bytes belong to words, and A-Z in lower case."""

    def __init__(self, separators: bytes):
        self.is_word = np.ones(256, bool)
        self.is_word[np.frombuffer(separators, np.uint8)] = False
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32


#: Words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = WordRule(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))
#: Words between white space: [^\x20\x09-\x0D]+.
SPACED = WordRule(b" \t\n\v\f\r")

_MUL = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        for i, base in enumerate((_MUL, _INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POW[i] = np.cumprod(p)
    return _POW[0], _POW[1]


class Words:
    """The words of several texts: ``doc`` (row), ``start`` and ``end`` (byte
    offsets into ``data``, the lower-cased bytes) and 64-bit ``hash``."""

    __slots__ = ("doc", "start", "end", "hash", "data", "n_docs")

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)


def read_words(col: pa.Array, rule: WordRule, piece: int = 1 << 19) -> Words:
    """All words of every text. Long data is hashed in pieces of ``piece``
    bytes that end between words."""
    raw, offsets = text_bytes(col)
    data = rule.lower[raw]
    is_word = rule.is_word[raw]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([np.zeros(min(1, n), bool), is_word[:-1]])
    after = np.concatenate([is_word[1:], np.zeros(min(1, n), bool)])
    start = np.flatnonzero(is_word & (~before | edge[:-1]))
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    out = Words()
    out.data, out.start, out.end, out.n_docs = data, start, end, len(offsets) - 1
    out.doc = (np.searchsorted(offsets, start, "right") - 1).astype(np.int32)
    out.hash = np.zeros(len(start), np.uint64)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + piece, "right")))
            a, b = int(start[lo]), int(end[hi - 1])
            fwd, back = _powers(b - a + 1)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(_BYTE[data[a:b]] * fwd[:b - a], out=sums[1:])
            s, e = start[lo:hi] - a, end[lo:hi] - a
            out.hash[lo:hi] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64) * _INV)
            lo = hi
    return out


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, and the index of its
    first word."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(words.doc[:n] == words.doc[size - 1:])
    with np.errstate(over="ignore"):
        h = np.zeros(len(first), np.uint64)
        for t in range(size):
            h = mix(h * _MUL + words.hash[first + t])
    return h, first


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
