"""Benchmark decontamination by a prefix-filtered set join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. An
item's windows are its runs of ``window`` consecutive words; an item of fewer
words is one window. A window is the sequence of its word shingles
(``shingle`` words, or the whole window if it is shorter), and a document
contains it if all of them follow each other there.

1. Every document keeps those of its shingles that may occur in a window, with
   their positions. A bitmap of fixed size over the windows' shingles sorts out
   the rest, so the corpus is read once and almost nothing of it is shuffled.
2. Shingles are ordered by rarity: the number of their occurrences in all
   documents, then the text. To hold a window of m shingles completely, a
   document must hold any m - m + 1 = 1 of them: the window's necessary prefix
   is its rarest shingle.
3. Prefixes are joined with the documents' shingles. A match fixes where the
   window would start; it must start in the document and end in it
   (positional and length bound).
4. Each candidate is verified shingle by shingle, as text, over the window.

Defined results: a null or empty text has no words and no hits. Every row of
``docs`` gives one row, also repeated ones and those with a null id. Items with
a null id or without words take no part; repeated items count once. Windows
that several items share count for each of them. An empty table gives no rows.
Other columns of either table are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from dealcast.llm import common as C

BITMAP_BITS = 24   # log2 of the bitmap's size: 2 MB, whatever the items hold
PREFIX_BROADCAST = 100_000  # rows of a prefix or window table that may be broadcast

_HITS = "doc_id long, n_words long, found array<struct<pos:int,size:int,shingle:string>>"


def _windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, window): each item's windows, as words joined by a space."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                words = C.read_words(part.column(1), C.ALNUM)
                ends = np.cumsum(words.counts())
                ids, out = [], []
                for d, key in enumerate(part.column(0).to_pylist()):
                    lo, hi = int(ends[d - 1]) if d else 0, int(ends[d])
                    own = [words.text(i).decode() for i in range(lo, hi)]
                    for k in range(max(1, len(own) - window + 1) if own else 0):
                        ids.append(key)
                        out.append(" ".join(own[k:k + window]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.string())],
                                                 names=["item_id", "window"])
    named = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("item_id"),
                                                           F.col(text).alias("text"))
    return named.mapInArrow(rows, "item_id string, window string").distinct()


def _split(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, len, size, off, shingle) of each window's shingles."""
    words = F.split("window", " ")
    size = F.least(F.lit(shingle), F.size(words))
    return (windows.select("window", words.alias("w"), F.size(words).alias("len"), size.alias("size"))
            .select("window", "w", "len", "size", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))).alias("off"))
            .select("window", "len", "size", "off",
                    F.array_join(F.slice("w", F.col("off") + 1, F.col("size")), " ").alias("shingle")))


def _bit(h: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (C.mix(h + np.uint64(size)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _bitmap(shingles: DataFrame) -> tuple[bytes, list[int]]:
    """The bitmap of (size, shingle) rows and the sizes that occur."""
    @C.task
    def bits(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            words = C.read_words(batch.column(1), C.ALNUM)
            out = set()
            for n in set(batch.column(0).to_pylist()):
                h, first = C.shingle_hashes(words, n)
                own = np.asarray(batch.column(0))[words.doc[first]] == n
                out |= {(n, b) for b in _bit(h[own], n).tolist()}
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int32()), pa.array([b for _, b in out], pa.int64())],
                                             names=["size", "bit"])
    got = shingles.select("size", "shingle").distinct().mapInArrow(bits, "size int, bit long").distinct().toArrow()
    flags = np.zeros(1 << BITMAP_BITS, bool)
    flags[got.column("bit").to_numpy()] = True
    return np.packbits(flags).tobytes(), sorted(set(got.column("size").to_pylist()))


def _found(docs: DataFrame, doc_id: str, text: str, bitmap: bytes, sizes: list[int]) -> DataFrame:
    """For each document its number of words, and its shingles that pass the bitmap."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        flags = np.unpackbits(np.frombuffer(held.value, np.uint8)).astype(bool)
        kind = pa.struct([("pos", pa.int32()), ("size", pa.int32()), ("shingle", pa.string())])
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                words = C.read_words(part.column(1), C.ALNUM)
                counts = words.counts()
                first_of = np.cumsum(counts) - counts
                doc, pos, size, shingle = [], [], [], []
                for n in sizes:
                    h, first = C.shingle_hashes(words, n)
                    hit = first[flags[_bit(h, n)]]
                    doc.append(words.doc[hit])
                    pos.append(hit - first_of[words.doc[hit]])
                    size.append(np.full(len(hit), n))
                    shingle += [" ".join([words.text(i + t).decode() for t in range(n)]) for i in hit.tolist()]
                d = np.concatenate(doc) if doc else np.zeros(0, int)
                order = np.argsort(d, kind="stable")
                offsets = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=part.num_rows))])
                values = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(pos).astype(np.int32) if pos else [], pa.int32()),
                     pa.array(np.concatenate(size).astype(np.int32) if size else [], pa.int32()),
                     pa.array(shingle, pa.string())], fields=list(kind)).take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                    names=["doc_id", "n_words", "found"])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(rows, _HITS)


def _verify(matched: DataFrame) -> DataFrame:
    """(row, start, window, len) of the candidates whose shingles all follow each other."""
    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out: dict[str, list] = {"row": [], "start": [], "window": [], "len": []}
            for r in batch.to_pylist():
                have = {(f["pos"], f["size"]): f["shingle"] for f in r["found"]}
                for c in r["candidates"]:
                    words, n, s = c["window"].split(" "), c["size"], c["start"]
                    if all(have.get((s + i, n)) == " ".join(words[i:i + n]) for i in range(len(words) - n + 1)):
                        for k, v in zip(out, (r["row"], s, c["window"], len(words))):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["row"], pa.int64()), pa.array(out["start"], pa.int32()), pa.array(out["window"], pa.string()),
                 pa.array(out["len"], pa.int32())], names=list(out))
    return matched.mapInArrow(rows, "row long, start int, window string, len int")


def find_windows(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = 13, shingle: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The join itself. Returns three tables:

    - rows: (row, doc_id, n_words), one for each row of ``docs``, ``row`` being
      a number of its own;
    - spans: (row, start, len, window), the windows that occur, by word position;
    - items: (window, item_id), the items that have a window.
    """
    named = C.materialize(_windows(items, item_id, item_text, window))
    split = C.materialize(_split(named.select("window").distinct(), shingle))
    bitmap, sizes = _bitmap(split)
    read = C.materialize(_found(docs, doc_id, text, bitmap, sizes).withColumn("row", F.monotonically_increasing_id()))
    found = read.where(F.size("found") > 0)
    spots = found.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.pos", "f.size", "f.shingle")
    rarity = spots.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    # the rarest shingle of each window; one that no document has rules the window out
    order = Window.partitionBy("window").orderBy(F.coalesce("seen", F.lit(0)), "shingle", "off")
    prefix = C.materialize(split.join(rarity, "shingle", "left").withColumn("_nth", F.row_number().over(order))
                           .where((F.col("_nth") == 1) & F.col("seen").isNotNull()).select("shingle", "window", "len", "size", "off"))
    # positional bound: the window starts in the text; length bound: it ends there
    near = (spots.select("row", "n_words", "pos", "shingle").join(C.broadcast_if_small(prefix, PREFIX_BROADCAST), "shingle")
            .withColumn("start", F.col("pos") - F.col("off"))
            .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words"))))
    asked = near.groupBy("row").agg(F.collect_set(F.struct("start", "window", "size")).alias("candidates"))
    spans = C.materialize(_verify(found.select("row", "found").join(asked, "row")))
    return read.select("row", "doc_id", "n_words"), spans, named


def decontaminate(docs: DataFrame, items: DataFrame, share: int = 20, **names) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_hit (words inside any
    window), items (ids, as sorted strings, of the items with a window in it)
    and contaminated: hit at all, and at least one word in ``share`` is."""
    rows, spans, named = find_windows(docs, items, **names)
    before = Window.partitionBy("row").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("len")).over(before), F.lit(0))
    hit = (spans.select("row", "start", "len").distinct()
           .withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest(reach, F.col("start"))))
           .groupBy("row").agg(F.sum("new").alias("n_hit")))
    of = (spans.select("row", "window").distinct().join(named, "window")
          .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    return (rows.join(hit.join(of, "row"), "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
