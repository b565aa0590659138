"""Token files with a minimal perfect hash index.

Documents are dealt by ranges of their id into shards, in ascending order (null
ids first, equal ids by the hash and bytes of their text). A task tokenizes its
range, and streams one file:

    payload   the raw ids, little-endian, 2 or 4 bytes each by the vocabulary
    index     the bit arrays of a minimal perfect hash function and their ranks
    slots     for each key: 64-bit fingerprint, offset and length in the
              payload (in ids), number of documents that share the id
    footer    sizes of all this, and a magic number

The hash function is built by levels: keys that alone hit a bit of a level's
array set it, the others go on to the next level. A key's slot is the number of
bits set before its own, over all levels, so a lookup reads a few bits, one
slot and the ids. A fingerprint that differs says that the key isn't there
(wrong with a chance of 2 ** -64). Keys are (id, how manieth with this id).

Files have names of their own for each attempt of a task, and only those of the
committed attempts are in the manifest, so a lost or repeated task leaves a
stray file at worst. They are written with pyarrow's file systems (file, hdfs,
s3, gs by the folder's URI).

Defined results: a null or empty text has the end id alone; every row of the
table has its ids in the files, also repeated rows and those with a null id. An
empty table gives no files. Other columns are never read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from dealcast.llm import common as C
from dealcast.llm.tokens import default_vocabulary, token_slices, tokenizer
from dealcast.session import scratch_path

MAGIC = b"TOKIDX01"
_FOOTER = struct.Struct("<8Q8s")   # keys, ids, bytes an id, levels, payload, index, ranks, slots (bytes), magic
_SLOT = np.dtype([("fingerprint", "<u8"), ("offset", "<u8"), ("length", "<u8"), ("copies", "<u4")])
_SPARE = 2          # bits for each key of a level
_BLOCK = 512        # bits for each stored rank
PARTS = 2           # tasks that read one file's documents
READ_IDS = 1 << 20  # ids that a reading task gives back at once, about


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's whole URI: a path without a scheme is one of the cluster's
    default file system for Spark, so it is for the tasks that open it too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


# ------------------------------------------------------------------ the hash function

def key_hash(ids: np.ndarray, null: np.ndarray, copy: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = C.mix(np.where(null, 0, ids).astype(np.int64).view(np.uint64) + null.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
        return C.mix(h + copy.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + null.astype(np.uint64))


def _spot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (C.mix(h + np.uint64(level + 1) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers a fixed set of distinct 64-bit hashes from 0 to n - 1: bits in
    64-bit words level by level, and the number of bits before each block."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.base = np.cumsum([0, *sizes])
        counts = np.bitwise_count(words).astype(np.uint64)
        counts = np.concatenate([counts, np.zeros(-len(counts) % (_BLOCK // 64), np.uint64)]).reshape(-1, _BLOCK // 64)
        self.ranks = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts.sum(1), dtype=np.uint64)])

    @classmethod
    def build(cls, hashes: np.ndarray) -> "PerfectHash":
        sizes, words, left = [], [np.zeros(0, np.uint64)], hashes
        while len(left):
            size = -(-_SPARE * len(left) // 64) * 64
            at = _spot(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("two keys have one hash")
        return cls(sizes, np.concatenate(words).astype("<u8"))

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; -1 for some that aren't in the set (others
        get a number that the fingerprint must refuse)."""
        return find_slots(hashes, self.sizes, lambda at: self.words[at], lambda at: self.ranks[at])

    def to_bytes(self) -> tuple[bytes, bytes]:
        return np.array(self.sizes, "<u8").tobytes() + self.words.astype("<u8").tobytes(), self.ranks.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, levels: int) -> "PerfectHash":
        sizes = np.frombuffer(data, "<u8", levels).astype(np.int64).tolist()
        return cls(sizes, np.frombuffer(data, "<u8", offset=8 * levels).copy())


def find_slots(hashes: np.ndarray, sizes: list[int], words, ranks) -> np.ndarray:
    """Slots from the index, of which ``words`` and ``ranks`` give what stands at
    some places: a word a level until the key is found, then its block's words."""
    out = np.full(len(hashes), -1, np.int64)
    left, base, per = np.arange(len(hashes)), 0, _BLOCK // 64
    for level, size in enumerate(sizes):
        if not len(left):
            break
        place = base + _spot(hashes[left], level, size)
        hit = (words(place // 64) >> (place % 64).astype(np.uint64)) & np.uint64(1) != 0
        at, rows = place[hit], left[hit]
        count = ranks(at // _BLOCK).astype(np.int64)
        for k in range(per):  # the whole words of the block before the key's own
            some = np.flatnonzero(k < at // 64 % per)
            if len(some):
                count[some] += np.bitwise_count(words(at[some] // _BLOCK * per + k)).astype(np.int64)
        below = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        out[rows] = count + np.bitwise_count(words(at // 64) & below).astype(np.int64)
        left = left[~hit]
        base += size
    return out


# ------------------------------------------------------------------ one file

def _write_shard(sink: pa.NativeFile, parts: Iterator, end_id: int, width: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Stream the ids of (batch, ids, offsets) parts and finish the file.
    Returns the ids and null flags of the documents, and the number of tokens."""
    keys, nulls, sizes, total = [], [], [], 0
    kind = f"<u{width}"
    for part, ids, offsets in parts:
        n = part.num_rows
        size = np.diff(offsets) + 1
        ends = np.cumsum(size)
        whole = np.full(int(ends[-1]), end_id, kind)
        inner = np.ones(len(whole), bool)
        inner[ends - 1] = False
        whole[inner] = ids
        sink.write(whole.tobytes())
        column = part.column(0)
        nulls.append(column.is_null().to_numpy(zero_copy_only=False))
        keys.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        sizes.append(size)
        total += len(whole)
    if not keys:
        return None
    key, null, size = np.concatenate(keys), np.concatenate(nulls), np.concatenate(sizes)
    new = np.ones(len(key), bool)  # the rows are sorted, so copies follow each other
    new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
    run = np.flatnonzero(new)[np.cumsum(new) - 1]
    copy = np.arange(len(key)) - run
    copies = np.bincount(run, minlength=len(key))[run]
    h = key_hash(key, null, copy)
    index = PerfectHash.build(h)
    slots = np.zeros(len(key), _SLOT)
    at = index.slot(h)
    slots["fingerprint"][at] = C.mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    slots["offset"][at] = np.cumsum(size) - size
    slots["length"][at] = size
    slots["copies"][at] = copies
    bits, ranks = index.to_bytes()
    for x in (bits, ranks, slots.tobytes()):
        sink.write(x)
    sink.write(_FOOTER.pack(len(key), total, width, len(index.sizes), total * width, len(bits), len(ranks), slots.nbytes, MAGIC))
    return key, null, total


class TokenFile:
    """Keyed access to one file: ``find`` gives slots, ``read`` the ids of one.

    Opening reads the footer and the levels' sizes. A few keys are looked up by
    reading their words, ranks and slots by position; for many (a tenth of the
    file's) the index and the slots are read once."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.source = fs.open_input_file(path)
        end = self.source.size()
        self.n_keys, self.n_ids, self.width, levels, payload, bits, ranks, slots, magic = _FOOTER.unpack(
            self.source.read_at(_FOOTER.size, end - _FOOTER.size))
        if magic != MAGIC or payload + bits + ranks + slots + _FOOTER.size != end:
            raise ValueError(f"{uri} is no whole token file")
        self.sizes = np.frombuffer(self.source.read_at(8 * levels, payload), "<u8").astype(np.int64).tolist()
        self._words, self._ranks, self._slots = payload + 8 * levels, payload + bits, payload + bits + ranks
        self._spans = (bits - 8 * levels, ranks, slots)
        self._whole: tuple | None = None

    def _at(self, start: int, places: np.ndarray, kind: np.dtype) -> np.ndarray:
        return np.frombuffer(b"".join(self.source.read_at(kind.itemsize, start + int(p) * kind.itemsize) for p in places), kind)

    def _load(self) -> None:
        words, ranks, slots = (self.source.read_at(n, at) for n, at in zip(self._spans, (self._words, self._ranks, self._slots)))
        self._whole = np.frombuffer(words, "<u8"), np.frombuffer(ranks, "<u8"), np.frombuffer(slots, _SLOT)

    def slots(self, places: np.ndarray) -> np.ndarray:
        return self._whole[2][places] if self._whole else self._at(self._slots, places, _SLOT)

    def find(self, ids: np.ndarray, null: np.ndarray, copy: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        if not self._whole and 10 * len(ids) >= self.n_keys:
            self._load()
        h = key_hash(ids, null, copy)
        if self._whole:
            words, ranks = (lambda at: self._whole[0][at]), (lambda at: self._whole[1][at])
        else:
            words, ranks = (lambda at: self._at(self._words, at, np.dtype("<u8"))), (lambda at: self._at(self._ranks, at, np.dtype("<u8")))
        at = find_slots(h, self.sizes, words, ranks)
        good = at >= 0
        good[good] = self.slots(at[good])["fingerprint"] == C.mix(h[good] ^ np.uint64(0x2545F4914F6CDD1D))
        return np.where(good, at, -1)

    def read(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.source.read_at(length * self.width, offset * self.width), f"<u{self.width}")

    def close(self) -> None:
        self.source.close()


# ------------------------------------------------------------------ the operator

@dataclass
class Manifest:
    """The files of a folder, in order: (file, n_keys, n_ids, has_null, low, high)."""
    files: list
    rows: DataFrame


def write_token_files(docs: DataFrame, folder: str, end_id: int = 1, path: str | None = None, shards: int | None = None,
                      doc_id: str = "doc_id", text: str = "text") -> Manifest:
    """Write ``docs`` to ``folder``. The manifest has a row a file, so it is as
    small as the number of ``shards`` (the session's shuffle partitions)."""
    path = path or default_vocabulary()
    spark = docs.sparkSession
    shards = shards or C.partitions(spark)
    folder = qualified(spark, folder)
    fs, local = file_system(folder)
    fs.create_dir(local, recursive=True)

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        width = 2 if tokenizer(path).model.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        uri = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tokens"
        here, at = file_system(uri)
        with here.open_output_stream(at) as sink:
            got = _write_shard(sink, token_slices(batches, path), end_id, width)
        if got is None:
            here.delete_file(at)
            return
        key, null, total = got
        own = key[~null]
        yield pa.RecordBatch.from_pylist([{"shard": shard, "file": uri, "n_keys": len(key), "n_ids": total, "has_null": bool(null.any()),
                                           "low": int(own[0]) if len(own) else None, "high": int(own[-1]) if len(own) else None}],
                                         schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_keys", pa.int64()),
                                                           ("n_ids", pa.int64()), ("has_null", pa.bool_()), ("low", pa.int64()), ("high", pa.int64())]))

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
             .repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order))
    found = C.materialize(dealt.mapInArrow(rows, "shard int, file string, n_keys long, n_ids long, has_null boolean, low long, high long"))
    return Manifest([r.asDict() for r in found.orderBy("shard").collect()], found)


def read_token_files(spark: SparkSession, manifest: Manifest, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the keys, by lookups.
    ``start`` counts the ids of all documents before. Each key goes to the files
    whose range holds it; repeated keys are asked for once."""
    files = manifest.files
    base = np.cumsum([0] + [f["n_ids"] for f in files])
    ranged = [i for i, f in enumerate(files) if f["low"] is not None]
    low = np.array([files[i]["low"] for i in ranged], np.int64)
    high = np.array([files[i]["high"] for i in ranged], np.int64)
    nulls = [i for i, f in enumerate(files) if f["has_null"]]

    @C.task
    def route(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            column = batch.column(0)
            null = column.is_null().to_numpy(zero_copy_only=False)
            own = column.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            first, last = np.searchsorted(high, own, "left"), np.searchsorted(low, own, "right")
            many = np.maximum(0, last - first)
            at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            shard = np.concatenate([np.array(ranged, np.int64)[at], np.array(nulls * bool(null.any()), np.int64)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.concat_arrays([pa.array(np.repeat(own, many)), pa.nulls(len(nulls) * bool(null.any()), pa.int64())])],
                names=["at", "doc_id"])

    @C.task
    def look(batches: Iterator[pa.RecordBatch]):
        at, file = -1, None
        try:
            for batch in batches:
                where = batch.column(0).to_numpy()
                for lo, hi in _runs(where):
                    if where[lo] != at:
                        if file is not None:
                            file.close()
                        at = int(where[lo])
                        file = TokenFile(files[at]["file"])
                    yield from _documents(file, int(base[at]), batch.column(1).slice(lo, hi - lo))
        finally:
            if file is not None:
                file.close()

    asked = keys.select(F.col(key).cast("long").alias("doc_id")).mapInArrow(route, "at int, doc_id long").distinct()
    # a file's keys go to PARTS tasks by their hash; the explicit number of partitions stays as it is
    parted = asked.repartition(max(1, len(files) * PARTS), "at", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).sortWithinPartitions("at", "doc_id")
    return parted.mapInArrow(look, "doc_id long, start long, n_tokens long, ids binary")


def _runs(where: np.ndarray) -> list[tuple[int, int]]:
    edges = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1, [len(where)]]).tolist()
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _documents(file: TokenFile, base: int, column: pa.Array) -> Iterator[pa.RecordBatch]:
    """The documents of some distinct keys in one file, ``READ_IDS`` ids at once."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    ids = column.fill_null(0).to_numpy(zero_copy_only=False)
    at = file.find(ids, null, np.zeros(len(ids), np.int64))
    ids, null, at = ids[at >= 0], null[at >= 0], at[at >= 0]
    copies = file.slots(at)["copies"].astype(np.int64)
    again = copies > 1  # all copies of a repeated id but the first
    more = np.arange(int((copies - 1).sum())) - np.repeat(np.cumsum(copies - 1) - (copies - 1), copies - 1) + 1
    ids, null = np.concatenate([ids, np.repeat(ids[again], copies[again] - 1)]), np.concatenate([null, np.repeat(null[again], copies[again] - 1)])
    slots = np.concatenate([file.slots(at), file.slots(file.find(ids[len(at):], null[len(at):], more))])
    order = np.argsort(slots["offset"], kind="stable")
    ids, null, slots = ids[order], null[order], slots[order]
    lo = 0
    ends = np.cumsum(slots["length"].astype(np.int64))
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + READ_IDS, "right")))
        values = [file.read(int(s["offset"]), int(s["length"])).astype("<u4").tobytes() for s in slots[lo:hi]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[lo:hi], pa.int64(), mask=null[lo:hi]), pa.array(base + slots["offset"][lo:hi].astype(np.int64)),
             pa.array(slots["length"][lo:hi].astype(np.int64)), pa.array(values, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
        lo = hi


def round_trip(docs: DataFrame, folder: str | None = None, **names) -> DataFrame:
    """Write the files, read every document back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, f"tokens/{uuid.uuid4().hex}")
    manifest = write_token_files(docs, folder, **names)
    found = read_token_files(spark, manifest, docs, names.get("doc_id", "doc_id"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
