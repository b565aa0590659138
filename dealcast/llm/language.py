"""Language by compression.

For each language a zstandard raw-content dictionary holds texts of the
language. A text, reduced to its lower-case letters and single spaces, is cut
into blocks of ``BLOCK`` bytes, and the blocks are compressed with each of the
dictionaries: what a dictionary has in common with them needn't be stored. The
smallest total names the language. (In one piece a long text would mostly be
compressed by its own beginning, whatever the dictionary.) The score is the
share by which the smallest total beats the second smallest. A text whose margin
is narrower than ``margin`` is rejected in the column ``accepted``; its
``lang_pred`` stays the smallest.

Every language that a row outside the held-out fold names is learned, from at
most ``texts`` distinct texts of it (those with the smallest hashes), of each of
which blocks from all over the text (again by a hash) make up at most ``share``
bytes, ``size`` bytes in all. All dictionaries together have about ``total``
bytes, so that they fit into a task: with many languages each has less. The
dictionaries are put together in Spark tasks, one a language.

Predictions use whole texts and every language. Each language costs a
compression, so if there are more than ``shortlist`` of them, a few blocks of a
text put them in order, and a language is given up as soon as the blocks so far
make more than the second smallest total of the languages before it. Totals only
grow, so the smallest two, and with them the result, are those of all languages.

Defined results: null text, or text without any letter, is ``und`` with score 0
and not accepted; so is every text if there is nothing to learn from. Equal
sizes go to the language that sorts first; a single learned language has score
1. Every row gives one row. Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from dealcast.llm import common as C

TEXTS = 80           # sampled texts of a language
SHARE = 8192         # bytes of a sampled text
SIZE = 240 << 10     # bytes of a dictionary
TOTAL = 24 << 20     # bytes of all dictionaries, about
SHORTLIST = 16       # languages from which on a few blocks of a text put them in order
PROBE = 4            # blocks of a text that do so
BLOCK = 1024         # bytes that are compressed at once
LEVEL = 6
MARGIN = 0.02
UNKNOWN = "und"
PARTS = 64           # of a language, from which its sample is drawn
SAMPLE_BROADCAST = 200_000  # sampled texts' hashes that may be broadcast (6 MB)


def _letters(texts: pa.Array) -> pa.Array:
    """Lower-case letters (with their marks), words between single spaces."""
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+", " "), " ")


def _spread(data: bytes, most: int) -> list[bytes]:
    """At most ``most`` blocks of a text, drawn from all over it by their hash,
    in their order."""
    blocks = [data[k:k + BLOCK] for k in range(0, len(data), BLOCK)]
    if len(blocks) <= most:
        return blocks
    drawn = sorted(range(len(blocks)), key=lambda k: (zlib.crc32(blocks[k]), k))[:most]
    return [blocks[k] for k in sorted(drawn)]


def _total(model: zstandard.ZstdCompressor, blocks: list[bytes], most: int | None) -> int | None:
    """Bytes of all compressed blocks; None as soon as they are more than ``most``."""
    total = 0
    for x in blocks:
        total += len(model.compress(x))
        if most is not None and total > most:
            return None
    return total


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", texts: int = TEXTS, share: int = SHARE,
          size: int = SIZE, total: int = TOTAL) -> dict[str, bytes]:
    """A dictionary's content for each language."""
    known = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0) & ~C.held_out(doc_id))
             .select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("hash"), F.col(text).alias("text")))
    # of each language the texts with the smallest hashes, each once: first of each of its parts, so that no task gets more than
    # ``texts`` of a part from each other task, or ``PARTS`` times as many at the end
    dealt = known.groupBy("lang", "hash").agg(F.lit(1).alias("_one")).withColumn("_part", F.pmod("hash", F.lit(PARTS)))
    order = [F.xxhash64("hash"), F.col("hash")]
    first = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_place") <= texts)
    chosen = C.materialize(first.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= texts)
                           .select("lang", "hash", "place"))
    names = chosen.select("lang").distinct().count()
    if not names:
        return {}
    size = min(size, max(BLOCK, total // names))
    blocks = max(1, min(share, -(-2 * size // texts)) // BLOCK)

    @C.task
    def drawn(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                data = [b" ".join(_spread(x.encode(), blocks)) for x in _letters(part.column(2)).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(data, pa.binary())], names=["lang", "place", "data"])

    def content(part: pa.Table) -> pa.Table:
        # the dictionary's end is the nearest to the text: the first sampled texts go there
        own = {r["place"]: r["data"] for r in part.sort_by([("place", "ascending"), ("data", "descending")]).to_pylist()}
        return pa.table({"lang": part.column("lang")[:1], "data": [b" ".join(own[k] for k in sorted(own, reverse=True))[-size:]]})

    sample = (known.join(C.broadcast_if_small(chosen, SAMPLE_BROADCAST), ["lang", "hash"]).select("lang", "place", "text")
              .mapInArrow(drawn, "lang string, place int, data binary"))
    once = sample.groupBy("lang", "place").agg(F.min("data").alias("data"))
    found = once.groupBy("lang").applyInArrow(content, "lang string, data binary").collect()  # ``total`` bytes, about
    return {r.lang: bytes(r.data) for r in sorted(found)}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL,
            doc_id: str = "doc_id", text: str = "text", shortlist: int = SHORTLIST) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        names = list(held.value)
        models = []
        for k in names:
            d = zstandard.ZstdCompressionDict(held.value[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            models.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False))

        for batch in batches:
            for part in C.text_slices(batch, "text"):
                texts = _letters(part.column(1))
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                lang, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                for i in np.flatnonzero(letters).tolist() if models else []:
                    data = texts[i].as_buffer().to_pybytes()
                    blocks = [data[k:k + BLOCK] for k in range(0, len(data), BLOCK)]
                    order = list(range(len(models)))
                    if len(order) > shortlist:
                        probe = _spread(data, PROBE)
                        order.sort(key=lambda k: sum(len(models[k].compress(x)) for x in probe))
                    least = []  # the two smallest totals so far with their languages, equal ones in the languages' order
                    for k in order:
                        total = _total(models[k], blocks, least[1][0] if len(least) > 1 else None)
                        if total is not None:
                            least = sorted([*least, (total, k)])[:2]
                    lang[i] = names[least[0][1]]
                    score[i] = 1.0 if len(models) == 1 else (least[1][0] - least[0][0]) / least[1][0]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array((score >= margin) & np.array([x != UNKNOWN for x in lang]))],
                    names=["doc_id", "lang_pred", "score", "accepted"])
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, lang_pred string, score double, accepted boolean"))


def language(docs: DataFrame, margin: float = MARGIN, **names) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) and accepted of every row of ``docs``."""
    keep = {k: v for k, v in names.items() if k in ("doc_id", "text", "shortlist")}
    return (predict(docs, learn(docs, **{k: v for k, v in names.items() if k != "shortlist"}), margin, **keep)
            .withColumn("held_out", C.held_out("doc_id")))
