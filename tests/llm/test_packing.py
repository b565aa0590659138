import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from dealcast.llm import packing, tokens
from dealcast.llm.tokens import byte_vocabulary, default_vocabulary, tokenizer

EDGES = [(1, None), (2, ""), (None, "some words"), (3, "x"), (3, "x"), (4, "long text " * 4000), (5, "<|endoftext|> Don't")]


ODD = ["Don't", "it's", "I'LL", "Ünïcode", "straße", "ÀÉ.", "x", "<|endoftext|>", "<|ENDOFTEXT|>", "a1b2", "ß!!", "ǅ", "İ", "éa", "Σας", "日本語",
       "🙂", "...", ".a", "a..", "a,b.", "\x1c", "\x85z", "\x85", "\xa0", "\u2003", "\u3000", "\u205f", "\u1680", " q", "ª", "µ", "K", "ﬁ", "foo**.", "''",
       "﷽", "½", "É!", "Ÿ.", "x́", "́", "long" * 30, "2024-01-01"]


@pytest.mark.parametrize("path, limit", [(default_vocabulary(), 1 << 25), (byte_vocabulary(), 1 << 25), (default_vocabulary(), 2000), (byte_vocabulary(), 2000)])
def test_tokenizers_equal_the_library(path, limit, monkeypatch):
    """Also when the memory is so small that its generations go all the time."""
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) + rng.choice([" ", "\n", "\t", "\r\n", "  ", " \n ", ""]) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    texts += ["", None, " ", "\n\n", "a \u00a0\n b"]
    monkeypatch.setattr(tokens, "MEMO_BYTES", limit)
    own = type(tokenizer(path))(path)
    for lo in range(0, len(texts), 100):
        ids, at = own.ids(pa.array(texts[:50] + texts[lo:lo + 100], pa.string())[50:])
        for i, t in enumerate(texts[lo:lo + 100]):
            assert ids[at[i]:at[i + 1]].tolist() == own.model.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_the_memory_keeps_what_comes_again(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 30_000)
    own = type(tokenizer(default_vocabulary()))(default_vocabulary())
    asked = []
    plain = own._encode
    own._encode = lambda words: asked.extend(words) or plain(words)
    for k in range(40):
        own.ids(pa.array(["again and again " + " ".join(f"once{chr(97 + k % 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}q{chr(97 + k // 26)}" for i in range(200))]))
    assert asked.count("again") == 1 and own.young.bytes + own.old.bytes < 80_000
    own.ids(pa.array(["2024 " + "x" * 50] * 3))
    assert not {"2024", "x" * 50} & set(own.young.names.to_pylist())


def check(docs, placed, capacity=2048):
    """Whole documents, gapless places, right digests."""
    model = tokenizer(default_vocabulary()).model
    want = sorted(model.encode(t or "", add_special_tokens=False).ids + [0] for _, t in docs)
    got = placed.toPandas()
    for r in got.sort_values(["doc_id", "start"], na_position="first", kind="stable").itertuples():
        assert r.start == r.piece * capacity and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * capacity
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == (seq.length.cumsum() - seq.length).tolist() and seq.length.sum() <= capacity
    assert sum(map(len, want)) == got.length.sum()
    return got, want


def test_edge_cases(spark):
    d = spark.createDataFrame([(*x, 7, 8) for x in EDGES], "doc_id long, text string, length int, sequence_id int")
    got, want = check(EDGES, packing.packed_pieces(d, keep_ids=True))
    assert len(got[got.doc_id == 3]) == 2 and got[got.doc_id.isna()].shape[0] == 1
    long = got[got.doc_id == 4].sort_values("piece")
    assert np.concatenate([np.frombuffer(x, "<u4") for x in long.ids]).tolist() in want
    assert packing.packed_pieces(d.limit(0)).count() == 0


def test_whole_small_table(spark, docs):
    got, want = check([(r.doc_id, r.text) for r in docs.collect()], packing.packed_pieces(docs, keep_ids=True))
    whole = [np.concatenate([np.frombuffer(x, "<u4") for x in g.sort_values("piece").ids]).tolist() for _, g in got.groupby("doc_id")]
    assert sorted(whole) == want
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 2048)
    seqs = packing.sequences(packing.packed_pieces(docs, keep_ids=True)).collect()
    assert sum(len(s.ids) for s in seqs) == 4 * got.length.sum() and all(len(s.ids) <= 4 * 2048 for s in seqs)


def test_local_search_never_worsens_and_beats_best_fit():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(600, 1000, 800), rng.integers(650, 720, 800), rng.integers(1, 2047, 800), np.full(50, 683), np.array([1])):
        bins = packing.best_fit(lengths, 2048)
        before = len(bins)
        better = packing.improve([list(b) for b in bins], lengths, 2048)
        assert sorted(i for b in better for i in b) == list(range(len(lengths)))
        assert max(lengths[b].sum() for b in better) <= 2048 and len(better) <= before
    assert len(packing.improve(packing.best_fit(np.array([1000, 700, 700, 1048, 648, 700]), 2048), np.array([1000, 700, 700, 1048, 648, 700]), 2048)) == 3
    third = rng.integers(650, 720, 800)
    assert len(packing.improve(packing.best_fit(third, 2048), third, 2048)) < len(packing.best_fit(third, 2048))


def test_groups_are_whole(spark, docs):
    pieces = packing.C.materialize(packing.token_pieces(docs).withColumn("ids_crc32", packing.F.crc32("ids")).drop("ids"))
    one, many = packing.pack(pieces), packing.pack(pieces, group=16)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(one.select(*cols)) == rows(many.select(*cols))


def exchanges_left(bins, lengths, capacity):
    """Every move, swap and two-for-one swap that would still help, by loops."""
    fill = [sum(int(lengths[i]) for i in b) for b in bins]
    for a, own in enumerate(bins):
        for t, other in enumerate(bins):
            if a == t or not fill[a] <= fill[t] < capacity:
                continue
            leaves = [int(lengths[i]) for i in own] + [int(lengths[i] + lengths[j]) for k, i in enumerate(own) for j in own[k + 1:]]
            for gain in [int(lengths[i]) for i in own] + [n - int(lengths[j]) for n in leaves for j in other]:
                if 0 < gain <= capacity - fill[t]:
                    return a, t, gain
    return None


@pytest.mark.parametrize("capacity, low, high, n", [(100, 20, 60, 60), (100, 31, 36, 120), (100, 1, 9, 80), (2048, 650, 720, 150), (64, 1, 64, 90)])
def test_the_search_ends_only_when_no_exchange_is_left(capacity, low, high, n):
    """No limit on sources, steps or pieces: also with many equal pieces that
    nothing can take."""
    rng = np.random.default_rng(n)
    for stuck in (0, n // 3):
        lengths = np.concatenate([rng.integers(low, high, n), np.full(stuck, capacity // 2 + 1)])
        bins = packing.improve(packing.best_fit(lengths, capacity), lengths, capacity)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert len(bins) == -(-int(lengths.sum()) // capacity) or exchanges_left(bins, lengths, capacity) is None


def test_pairs_of_many_pieces():
    sizes = np.sort(np.random.default_rng(4).integers(1, 50, 90))
    for most in (3, 40, 77, 98):
        x, y = packing._close_pairs(sizes, np.array([most]))
        want = max((int(a + b) for i, a in enumerate(sizes) for b in sizes[i + 1:] if a + b <= most), default=0)
        assert (x != y).all() and max((sizes[x] + sizes[y]).tolist(), default=0) == want
