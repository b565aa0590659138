"""Toxicity categories by a classifier chain.

The categories are predicted one after the other. Each one's linear model sees
the text's features and the probabilities of all earlier categories. In
training these are out-of-fold: the sample is cut into ``FOLDS`` parts, and a
row's earlier probabilities come from models that didn't see its part, so a
later model learns from probabilities of the kind that it gets when it scores.

Labels mark whether a text is toxic. The chain's first categories are finer:
a labelled row has one if it is toxic and has a word of the category's list.
The last category is the label itself and decides.

Features are what a text has at all (not how often): lower-cased words and runs
of 4 and 5 bytes, hashed. What nearly no sample row has is left out. A model
keeps the ``KEEP`` features that tell its category best in its training rows
(of all others, however many rows have them) and is a logistic regression on
them. Features are counted by fold and category in Spark; the task that fits
gets only what some model keeps.

The fit uses at most ``sample`` labelled rows outside the held-out fold, one of
each distinct text, so copies of a text count once; scores use the whole text
only. Defined results: a null or empty text has no features
(its probabilities are those of the models' constants); every row gives one
row; without any labelled row all probabilities are 0. Other columns are never
read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window
from pyspark.sql import types as T

from dealcast.llm import common as C
from dealcast.llm.learning import labelled_texts, text_hash

BITS = 20
SAMPLE = 3000    # labelled rows that the fit may use
FOLDS = 4
SEEN = 3         # a feature counts if at least 3 of a model's training rows have it
SIZES = (4, 5)   # bytes of a run
KEEP = 512
TURNS = 120
PENALTY = 1e-3
CUT = 0.3

# The words of the finer categories.
CATEGORIES = {
    "insult": ("clown", "idiot", "loser", "moron", "scum"),
    "contempt": ("disgusting", "pathetic", "stupid", "trash", "worthless"),
}
LAST = "toxic"


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int, C.Words]:
    """(document, bucket) of every feature, with repeats; the number of texts; the words."""
    words = C.read_words(column, C.ALNUM)
    doc, out = [words.doc], [_bucket(C.mix(words.hash + np.uint64(1)))]
    # the words' bytes with one separator between them, so that runs don't see the marks
    size = words.end - words.start + 1
    at = np.cumsum(size) - size
    line = np.zeros(int(size.sum()), np.uint64)
    inside = np.ones(len(line), bool)
    inside[at + size - 1] = False
    pos = np.flatnonzero(inside)
    line[pos] = words.data[pos + np.repeat(words.start - at, size)[pos]] if len(pos) else 0
    owner = np.repeat(words.doc, size)
    for n in SIZES:
        m = max(0, len(line) - n + 1)
        h = np.full(m, n, np.uint64)
        with np.errstate(over="ignore"):
            for t in range(n):
                h = (h << np.uint64(8)) | line[t:t + m]
        own = owner[:m] == owner[len(line) - m:] if m else np.zeros(0, bool)
        doc.append(owner[:m][own])
        out.append(_bucket(C.mix(h[own])))
    return np.concatenate(doc), np.concatenate(out), words.n_docs, words


def _marks(words: C.Words) -> np.ndarray:
    """For each text a bit for each finer category that has a word in it."""
    bits = np.zeros(words.n_docs, np.int64)
    for k, listed in enumerate(CATEGORIES.values()):
        want = C.read_words(pa.array([" ".join(listed)]), C.ALNUM).hash
        bits[np.unique(words.doc[np.isin(words.hash, want)])] |= 1 << k
    return bits


def featurize(column: pa.Array) -> list[np.ndarray]:
    """Of each text: the bits of the finer categories, then its distinct buckets."""
    doc, bucket, n, words = text_features(column)
    bits = _marks(words)
    order = np.argsort(doc, kind="stable")
    ends = np.cumsum(np.bincount(doc, minlength=n))
    return [np.concatenate([bits[d:d + 1], np.unique(bucket[order[ends[d - 1] if d else 0:ends[d]]])]).astype(np.int32) for d in range(n)]


def targets(bits: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of each category, in the chain's order: whether a row has it."""
    toxic = (labels > 0).astype(np.float64)
    return [toxic * (bits >> k & 1) for k in range(len(CATEGORIES))] + [toxic]


def gains(seen: np.ndarray, yes: np.ndarray, n: int, ones: float) -> np.ndarray:
    """What knowing a feature adds to the likelihood of the rows that have it:
    ``seen`` of the ``n`` rows, ``yes`` of the ``ones`` rows of the category."""
    rate = (yes + 0.5 * (ones + 1) / (n + 2)) / (seen + 0.5)
    base = (ones + 0.5) / (n + 1)
    gain = seen * (rate * np.log(rate / base) + (1 - rate) * np.log(np.maximum(1 - rate, 1e-12) / (1 - base)))
    return np.where(seen < SEEN, 0, gain)


class Linear:
    """Logistic regression on the features (numbers below ``width``) that tell
    the label best, and on ``extra`` columns (the earlier probabilities)."""

    def __init__(self, at: np.ndarray, owner: np.ndarray, n: int, width: int, label: np.ndarray, extra: np.ndarray):
        ones = label.sum()
        base = (ones + 0.5) / (n + 1)
        gain = gains(np.bincount(at, minlength=width), np.bincount(at, label[owner] > 0, minlength=width), n, ones)
        self.at = np.sort(np.argsort(-gain, kind="stable")[:KEEP])
        self.at = self.at[gain[self.at] > 0]
        place = np.full(width, -1, np.int16)
        place[self.at] = np.arange(len(self.at))
        x = np.zeros((n, len(self.at) + extra.shape[1]), np.float32)
        spot = place[at]
        kept = spot >= 0
        x[owner[kept], spot[kept]] = 1
        del spot, kept
        x[:, len(self.at):] = extra
        # gradient steps with a moving average of squares (Adam)
        w, b = np.zeros(x.shape[1], np.float32), float(np.log(base / (1 - base)))
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        y = label.astype(np.float32)
        for t in range(1, TURNS + 1):
            d = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
            g, gb = x.T @ d / n + PENALTY * w, float(d.mean())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            step = 0.1 * (1 - t / (TURNS + 1))
            w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            b -= step * (mb / (1 - 0.9 ** t)) / ((vb / (1 - 0.99 ** t)) ** 0.5 + 1e-8)  # plain floats keep the arrays in 32 bits
        self.width = width
        self.weights, self.bias, self.extra = w[:len(self.at)].astype(np.float64), b, w[len(self.at):].astype(np.float64)

    def probability(self, at: np.ndarray, owner: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
        """``at`` and ``owner``: distinct (bucket, text) pairs."""
        value = np.zeros(self.width)
        value[self.at] = self.weights
        used = value != 0
        hit = used[at]
        z = np.bincount(owner[hit], value[at[hit]], minlength=n) + self.bias + extra @ self.extra
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, names: np.ndarray) -> bytes:
    """The chain: [(buckets, weights, bias, weights of earlier categories)].
    ``names``: the buckets, sorted, that some model may keep."""
    n = len(rows)
    bits = np.array([r[0] for r in rows])
    kept = [np.searchsorted(names, r[1:]) for r in rows]  # a row's buckets are distinct
    at = np.concatenate(kept)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(k) for k in kept])
    del kept
    earlier = np.zeros((n, 0), np.float32)
    chain = []
    for y in targets(bits, labels):
        whole = Linear(at, owner, n, len(names), y, earlier)
        chain.append((names[whole.at], whole.weights, whole.bias, whole.extra))
        outside = np.zeros(n, np.float32)
        for f in range(FOLDS):
            own = fold != f
            if own.all() or not own.any():
                continue
            new = (np.cumsum(own) - 1).astype(np.int32)
            kept = own[owner]
            part = Linear(at[kept], new[owner[kept]], int(own.sum()), len(names), y[own], earlier[own])
            other = (np.cumsum(~own) - 1).astype(np.int32)
            left = ~kept
            outside[~own] = part.probability(at[left], other[owner[left]], int((~own).sum()), earlier[~own])
        earlier = np.column_stack([earlier, outside]).astype(np.float32)
    return pickle.dumps(chain)


def names() -> list[str]:
    return [*CATEGORIES, LAST]


def score(docs: DataFrame, model: bytes | None, text: str = "text") -> DataFrame:
    """``docs`` with a probability p_<category> for each category of the chain."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    columns = [f"p_{c}" for c in names()]

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        chain = pickle.loads(held.value) if held.value is not None else None
        if chain:
            place = np.full(1 << BITS, -1, np.int32)
            used = np.unique(np.concatenate([c[0] for c in chain]))
            place[used] = np.arange(len(used))
            table = np.zeros((len(used), len(chain)))
            for k, c in enumerate(chain):
                table[place[c[0]], k] = c[1]
        for batch in batches:
            for part in C.text_slices(batch, text):
                n = part.num_rows
                got = np.zeros((n, len(columns)))
                if chain:
                    doc, bucket, _, _ = text_features(part.column(part.schema.get_field_index(text)))
                    at = place[bucket]
                    hit = at >= 0
                    pair = np.unique(doc[hit].astype(np.int64) * len(used) + at[hit])
                    for k, c in enumerate(chain):
                        z = np.bincount(pair // max(1, len(used)), table[pair % max(1, len(used)), k], minlength=n) if len(pair) else np.zeros(n)
                        got[:, k] = 1 / (1 + np.exp(-np.clip(z + c[2] + got[:, :k] @ c[3], -60, 60)))
                for k, name in enumerate(columns):
                    part = part.append_column(name, pa.array(got[:, k]))
                yield part

    schema = T.StructType(docs.schema.fields + [T.StructField(c, T.DoubleType()) for c in columns])
    return docs.mapInArrow(rows, schema)


def _unpack(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column.to_pylist()]


def _sampled(docs: DataFrame, sample: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, label, fold, features) of the sampled texts, an id once."""
    @C.task
    def features(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in featurize(part.column(2))], pa.binary())],
                                                 names=["doc_id", "label", "features"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    read = (texts.join(F.broadcast(sample), ["doc_id", "text_hash"]).select("doc_id", "label", "text")  # at most ``sample`` rows
            .mapInArrow(features, "doc_id long, label int, features binary"))
    return (read.groupBy("doc_id").agg(F.min(F.struct("features", "label")).alias("m"))
            .select("doc_id", "m.label", F.pmod(F.hash("doc_id"), F.lit(FOLDS)).alias("fold"), "m.features"))


def _counted(rows: DataFrame) -> DataFrame:
    """(bucket, c0, c1, ...): of each fold, how many rows have the bucket, then
    how many of each category. Bucket -1 is in every row."""
    wide = 1 + len(CATEGORIES) + 1

    @C.task
    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # some megabytes of features
                part = batch.slice(lo, 256)
                got = _unpack(part.column(2))
                label, fold = part.column(0).to_numpy(), part.column(1).to_numpy()
                marks = np.column_stack([np.ones(len(got)), *targets(np.array([r[0] for r in got]), label)])
                own = [np.concatenate([[-1], r[1:]]) for r in got]
                bucket, place = np.unique(np.concatenate(own), return_inverse=True)
                owner = np.repeat(np.arange(len(got)), [len(r) for r in own])
                table = [np.bincount(place, (marks[:, k] * (fold == f))[owner], minlength=len(bucket)).astype(np.int32)
                         for f in range(FOLDS) for k in range(wide)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *map(pa.array, table)],
                                                 names=["bucket", *(f"c{i}" for i in range(len(table)))])

    columns = [f"c{i}" for i in range(FOLDS * wide)]
    part = rows.select("label", "fold", "features").mapInArrow(count, "bucket int, " + ", ".join(f"{c} int" for c in columns))
    return part.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in columns))


def _kept(rows: DataFrame) -> np.ndarray:
    """The buckets, sorted, that one of the chain's models keeps: of each
    category the model of all rows and those of all folds but one."""
    wide = 1 + len(CATEGORIES) + 1
    counted = C.materialize(_counted(rows))
    all_rows = counted.where("bucket = -1").collect()
    if not all_rows:
        return np.zeros(0, np.int64)
    sizes = np.array(all_rows[0][1:], np.int64).reshape(FOLDS, wide)

    @C.task
    def best(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            table = np.stack([c.to_numpy() for c in batch.columns[1:]], 1).reshape(-1, FOLDS, wide)
            for m in range(-1, FOLDS):  # -1: all rows
                inside = np.arange(FOLDS) != m
                n, seen = sizes[inside].sum(0), table[:, inside].sum(1)
                for k in range(1, wide):
                    gain = gains(seen[:, 0], seen[:, k], n[0], n[k])
                    top = np.lexsort((bucket, -gain))[:KEEP]
                    top = top[gain[top] > 0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), (m + 1) * wide + k, np.int32)), pa.array(bucket[top]), pa.array(gain[top])],
                                                     names=["model", "bucket", "gain"])

    found = counted.where("bucket >= 0").mapInArrow(best, "model int, bucket int, gain double")
    order = Window.partitionBy("model").orderBy(F.desc("gain"), "bucket")
    top = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= KEEP).select("bucket").distinct()
    return np.array(sorted(r.bucket for r in top.collect()), np.int64)  # at most KEEP of each model


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE,
                 doc_id: str = "doc_id", text: str = "text") -> bytes | None:
    """The chain, or None if there is nothing to learn from."""
    rows = C.materialize(_sampled(docs, labelled_texts(docs, labels, label, sample, doc_id, text), doc_id, text))
    held = docs.sparkSession.sparkContext.broadcast(_kept(rows))

    @C.task
    def less(batches: Iterator[pa.RecordBatch]):
        used = np.zeros(1 << BITS, bool)
        used[held.value] = True
        for batch in batches:
            cut = [np.concatenate([r[:1], r[1:][used[r[1:]]]]).tobytes() for r in _unpack(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cut, pa.binary())], names=["doc_id", "label", "fold", "features"])

    @C.task
    def model(batches: Iterator[pa.RecordBatch]):
        parts = pa.Table.from_batches([b for b in batches], pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("fold", pa.int32()), ("features", pa.binary())]))
        if parts.num_rows:
            parts = parts.sort_by("doc_id").combine_chunks()
            fitted = train(_unpack(parts.column("features")), parts.column("label").to_numpy(), parts.column("fold").to_numpy(), held.value)
            yield pa.RecordBatch.from_arrays([pa.array([fitted], pa.binary())], names=["model"])

    found = (rows.mapInArrow(less, "doc_id long, label int, fold int, features binary").coalesce(1)
             .mapInArrow(model, "model binary").collect())
    return bytes(found[0].model) if found else None


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT, doc_id: str = "doc_id", text: str = "text", **fitting) -> DataFrame:
    """doc_id, held_out, a probability for each category and toxic (the last
    one's is at least ``cut``) of every row of ``docs``."""
    model = fit_toxicity(docs, labels, doc_id=doc_id, text=text, **fitting)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), C.held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return score(plain, model).drop("text").withColumn("toxic", F.col(f"p_{LAST}") >= cut)
