"""Quality classifier by supervised subword embeddings.

A document is the mean of learned vectors: one for each hashed word, each pair
of neighbouring words and each run of 3 and 4 characters, in the text as it is
(case and punctuation count). Pairs of the same word twice share one vector.
A linear layer and a softmax over the two labels follow. Vectors and layer are
trained by numpy stochastic gradient descent, one document a step.

The layer is linear in the mean, so a fitted model scores with one number a
feature, its vector times the difference of the two label weights: the softmax
of label 1 is the logistic function of their mean.

The fit uses at most ``sample`` labelled rows outside the held-out fold, one a
distinct text; scores use the text only. Defined results: a null or empty text has no features and
gets the share of label 1 in the sample; every row gives one row, in the order
and number of the input; without any labelled row all scores are 0.5. Other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dealcast.llm import common as C
from dealcast.llm.learning import fit, labelled_texts

BUCKETS = 1 << 17
DIM = 8
SAMPLE = 4000     # labelled rows that the fit may use
STEPS = 12_000    # documents shown, whatever the sample holds
RATE = 0.5

_CASED = C.WordRule(b" \t\n\v\f\r")
_CASED.lower = np.arange(256, dtype=np.uint8)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 17)).astype(np.int64)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(document, bucket) of every feature of the texts, and their number."""
    words = C.read_words(column, _CASED)
    raw, offsets = C.text_bytes(column)
    doc = [words.doc]
    out = [_bucket(C.mix(words.hash + np.uint64(1)))]
    pairs, first = C.shingle_hashes(words, 2)
    same = words.hash[first] == words.hash[first + 1] if len(first) else np.zeros(0, bool)
    doc.append(words.doc[first])
    out.append(np.where(same, 0, _bucket(C.mix(pairs + np.uint64(2)))))
    chars = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]  # in characters
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(at))
    for n in (3, 4):
        m = max(0, len(chars) - n + 1)
        h = np.full(m, n, np.uint64)
        with np.errstate(over="ignore"):
            for t in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + chars[t:t + m]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        inside = owner[:m] == owner[len(chars) - m:] if m else np.zeros(0, bool)
        doc.append(owner[:m][inside])
        out.append(_bucket(h[inside]))
    return np.concatenate(doc), np.concatenate(out), words.n_docs


def featurize(column: pa.Array) -> list[np.ndarray]:
    """Of each text: its distinct buckets, then how often each occurs."""
    doc, bucket, n = text_features(column)
    order = np.argsort(doc, kind="stable")
    ends = np.cumsum(np.bincount(doc, minlength=n))
    rows = []
    for d in range(n):
        got, times = np.unique(bucket[order[ends[d - 1] if d else 0:ends[d]]], return_counts=True)
        rows.append(np.concatenate([got, times]).astype(np.int32))
    return rows


def descend(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stochastic gradient descent: the buckets' vectors, the layer and its bias."""
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, 2), np.float32)
    share = np.bincount(np.clip(labels, 0, 1), minlength=2) + 0.5
    bias = np.log(share / share.sum()).astype(np.float32)
    rounds = -(-STEPS // len(rows))
    for done, i in enumerate(np.concatenate([rng.permutation(len(rows)) for _ in range(rounds)])[:STEPS]):
        rate = RATE * (1 - done / STEPS)
        half = len(rows[i]) // 2
        if not half:
            continue
        at, weight = rows[i][:half], rows[i][half:].astype(np.float32)
        weight /= weight.sum()
        own = vectors[at]
        mean = weight @ own
        z = mean @ layer + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[min(1, max(0, int(labels[i])))] -= 1          # gradient of the logits
        back = layer @ p
        layer -= rate * np.outer(mean, p)
        # a bucket's share of the mean is small: its step is scaled to the largest share
        vectors[at] = own - (rate / weight.max()) * weight[:, None] * back[None, :]
    return vectors, layer, bias


def train(rows: list[np.ndarray], labels: np.ndarray) -> bytes:
    """The fitted model: the difference of the biases and a number for each bucket."""
    vectors, layer, bias = descend(rows, labels)
    value = vectors @ (layer[:, 1] - layer[:, 0])
    return np.concatenate([[bias[1] - bias[0]], value]).astype(np.float32).tobytes()


def score(docs: DataFrame, model: bytes | None, doc_id: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """(doc_id, score) of every row; with ``keep``, the rows of ``docs`` with a
    column of that name."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def of(column: pa.Array) -> np.ndarray:
        if held.value is None:
            return np.full(len(column), 0.5)
        weights = np.frombuffer(held.value, np.float32)
        doc, bucket, n = text_features(column)
        total = np.bincount(doc, weights[1:][bucket], minlength=n)
        logit = weights[0] + total / np.maximum(1, np.bincount(doc, minlength=n))
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -60, 60)))

    @C.task
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in C.text_slices(batch, text if keep else "text"):
                got = pa.array(of(part.column(part.schema.get_field_index(text if keep else "text"))))
                if keep:
                    yield part.append_column(keep, got)
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), got], names=["doc_id", "score"])

    if keep:
        return docs.mapInArrow(rows, docs.schema.add(keep, "double"))
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(rows, "doc_id long, score double"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE,
                doc_id: str = "doc_id", text: str = "text") -> bytes | None:
    rows = labelled_texts(docs, labels, label, sample, doc_id, text).select("doc_id", "label")
    return fit(docs, rows, featurize, train, doc_id, text)


def quality(docs: DataFrame, labels: DataFrame, cut: float = 0.3, **names) -> DataFrame:
    """doc_id, held_out, score (0 to 1; higher: label 1 likelier) and predicted
    (1 if score >= ``cut``) of every row of ``docs``."""
    scored = score(docs, fit_quality(docs, labels, **names))
    return scored.select("doc_id", C.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
