import zlib

import numpy as np
import pytest
from conftest import rows

from dealcast.llm import vectorpack as V
from dealcast.llm.packing import sequences
from dealcast.llm.tokens import byte_vocabulary, tokenizer

EDGES = [(1, None), (2, ""), (None, "some words"), (3, "x"), (3, "x"), (4, "long text " * 4000), (5, "<|endoftext|> Don't\n\n stop  here")]


def check(examples, placed, limits):
    """``examples``: (doc_id, ids, prompt). Every id in one piece, places without
    gaps, all limits kept, digests right; the padded share."""
    got = placed.toPandas()
    of = {}
    for doc, ids, _ in examples:
        of.setdefault(doc, []).append(ids)
    assert got.length.sum() == sum(len(ids) for _, ids, _ in examples)
    pieces = {}
    for r in got.itertuples():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        pieces.setdefault(None if r.doc_id != r.doc_id else int(r.doc_id), []).append((r.start, r.length, r.doc_tokens, ids.tolist()))
    for doc, own in pieces.items():
        if len(of[doc]) == 1:
            own.sort()
            assert [p[0] for p in own] == np.cumsum([0] + [p[1] for p in own])[:-1].tolist()
            assert sum((p[3] for p in own), []) == of[doc][0] and {p[2] for p in own} == {len(of[doc][0])}
    pad = 0
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist()
        fill = seq.length.sum()
        assert fill <= limits.tokens and len(seq) <= limits.segments and seq.loss_tokens.sum() <= limits.loss
        pad += (limits.tokens - fill) if fill & (fill - 1) else 0
    return got, pad / max(1, got.length.sum())


def encoded(docs, prompts=None):
    model = tokenizer(byte_vocabulary()).model
    out = []
    for k, (d, t) in enumerate(docs):
        p = model.encode((prompts[k] or "") if prompts else "", add_special_tokens=False).ids
        out.append((d, p + model.encode(t or "", add_special_tokens=False).ids + [1], len(p)))
    return out


def test_edge_cases(spark):
    d = spark.createDataFrame([(*x, 7, 8) for x in EDGES], "doc_id long, text string, length int, sequence_id int")
    got, pad = check(encoded(EDGES), V.pack_examples(d), V.Limits())
    assert pad == 0 and len(got[got.doc_id == 3]) == 2 and got.doc_id.isna().sum() >= 1
    assert V.pack_examples(d.limit(0)).count() == 0
    assert "ids" not in V.pack_examples(d, keep_ids=False).columns


@pytest.mark.parametrize("limits", [V.Limits(), V.Limits(2048, 4, 2048), V.Limits(512, 256, 100), V.Limits(64, 2, 5), V.Limits(1, 1, 1)])
def test_all_limits_hold_on_a_whole_table(spark, docs, limits):
    """No padding while every id bears loss: a sequence that another limit ends
    is cut back to a power of two."""
    part = docs.where("n_chars < 600") if limits.tokens < 600 else docs
    have = [(r.doc_id, r.text) for r in part.collect()]
    _, pad = check(encoded(have), V.pack_examples(part, limits, window=64), limits)
    assert pad == 0
    left = V.padding(V.pack_examples(part, limits, keep_ids=False), limits.tokens).first()
    assert left.padded == 0 and left.tokens == sum(len(x[1]) for x in encoded(have))


def test_prompts_bear_no_loss(spark):
    rng = np.random.default_rng(3)
    have = [(k, "word " * int(rng.integers(0, 400)), "ask " * int(rng.integers(0, 600))) for k in range(200)] + [(900, "a " * 5000, "b " * 5000), (901, None, None)]
    d = spark.createDataFrame(have, "doc_id long, text string, prompt string")
    want = encoded([(k, t) for k, t, _ in have], [p for *_, p in have])
    limits = V.Limits(2048, 16, 700)
    got, pad = check(want, V.pack_examples(d, limits, prompt="prompt"), limits)
    assert got.loss_tokens.sum() == sum(len(ids) - p for _, ids, p in want) and pad < 0.02


def plain_choice(pool, limits):
    """The heuristic once more, by loops: which of (length, loss) go into the
    next sequence, whole ones only."""
    mean = [sum(x[i] for x in pool) / len(pool) for i in (0, 1)]
    left, taken, pool = [limits.tokens, limits.loss, limits.segments], [], list(enumerate(pool))
    while pool and left[2]:
        fit = [(k, x) for k, x in pool if x[0] <= left[0] and x[1] <= left[1]]
        if not fit:
            break
        k, x = max(fit, key=lambda p: (p[1][0] * mean[0] * left[0] / limits.tokens ** 3 + p[1][1] * mean[1] * left[1] / limits.loss ** 3
                                       + left[2] / limits.segments ** 3, -p[0]))
        taken.append(k)
        pool.remove((k, x))
        left = [left[0] - x[0], left[1] - x[1], left[2] - 1]
    return taken


def test_the_choice_is_the_largest_dot_product():
    rng = np.random.default_rng(0)
    for _ in range(30):
        limits = V.Limits(256, 6, 128)
        pool = V.Pool(limits)
        pieces = []
        for k in range(40):
            n = int(rng.integers(1, 200))
            pieces.append((V._Example(k, np.zeros(n, "<u4"), max(0, n - int(rng.integers(0, 100)))), 0, n))
        pool.add(pieces)
        want = plain_choice([(n, e.loss(0, n)) for e, _, n in pieces], limits)
        got = [e.doc_id for e, _, n in pool.sequence() if n == len(e.ids)]
        assert got == want[:len(got)] and len(got) >= len(want) - 1  # the cut back may take the last


def test_few_examples_are_cut_and_few_sequences_made():
    rng = np.random.default_rng(1)
    have = [V._Example(k, np.zeros(int(n), "<u4"), 0) for k, n in enumerate(rng.integers(5, 1500, 5000))]
    seqs = list(V._sequences(iter(have), V.Limits(), V.WINDOW))
    total = sum(len(e.ids) for e in have)
    assert len(seqs) <= -(-total // 2048) + 11
    assert sum(map(len, seqs)) < 1.2 * len(have)


def test_instruction_examples_and_whole_sequences(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    ex = V.instruction_examples(conv)
    assert ex.count() == conv.where("role = 'assistant'").count() and ex.where("prompt is not null").count() > 0
    placed = V.pack_examples(ex, V.Limits(512, 32, 256), prompt="prompt")
    left = V.padding(placed, 512).first()
    assert left.padded < 0.1 * left.tokens
    whole = sequences(placed).collect()
    assert sum(len(s.ids) for s in whole) == 4 * left.tokens
    again = V.pack_examples(ex, V.Limits(512, 32, 256), prompt="prompt", keep_ids=False)
    assert rows(again) == rows(placed.drop("ids"))
