import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from dealcast.llm import tokenfiles
from dealcast.llm.tokens import default_vocabulary, tokenizer

EDGES = [(5, "a b"), (5, "a b"), (5, "zz top"), (None, None), (None, "x"), (-3, ""), (9, "Hello, World! <|endoftext|>"), (10, "long text " * 5000)]


def plain(docs):
    model = tokenizer(default_vocabulary()).model
    ids = [(d, model.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in docs]
    return sorted([(d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids], key=str)


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_edge_cases(spark, shards):
    d = spark.createDataFrame([(*x, 7, 8) for x in EDGES], "doc_id long, text string, start int, shard int")
    got = tokenfiles.round_trip(d, shards=shards).collect()
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=str) == plain(EDGES)
    got.sort(key=lambda r: r.start)
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    assert tokenfiles.round_trip(d.limit(0)).count() == 0


def test_round_trip_and_keyed_access(spark, docs, tmp_path):
    manifest = tokenfiles.write_token_files(docs, str(tmp_path), shards=4)
    got = tokenfiles.read_token_files(spark, manifest, docs)
    have = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted([(r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in got.collect()], key=str) == plain(have)
    some = spark.createDataFrame([(3,), (3,), (17,), (10**9,), (-1,)], "doc_id long")
    assert [r.doc_id for r in tokenfiles.read_token_files(spark, manifest, some).orderBy("doc_id").collect()] == [3, 17]
    first = tokenfiles.TokenFile(manifest.files[0]["file"])
    at = first.find(np.array([manifest.files[0]["low"], 10**9]), np.zeros(2, bool), np.zeros(2, int))
    assert at[0] >= 0 and at[1] == -1
    slot = first.slots(at[:1])[0]
    assert first._whole is None and first.find(np.arange(10**6), np.zeros(10**6, bool), np.zeros(10**6, int))[slot["length"] * 0 + manifest.files[0]["low"]] == at[0]
    assert first._whole is not None and first.slots(at[:1])[0] == slot
    assert first.read(int(slot["offset"]), int(slot["length"]))[-1] == 1
    first.close()


def test_perfect_hash_is_minimal_and_survives_bytes():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    index = tokenfiles.PerfectHash.build(h)
    assert np.array_equal(np.sort(index.slot(h)), np.arange(len(h)))
    again = tokenfiles.PerfectHash.from_bytes(index.to_bytes()[0], len(index.sizes))
    assert np.array_equal(again.slot(h), index.slot(h)) and 64 * len(index.words) < 4 * len(h)
    assert tokenfiles.PerfectHash.build(h[:0]).slot(h[:3]).tolist() == [-1, -1, -1]


def test_a_cut_file_is_refused(spark, docs, tmp_path):
    manifest = tokenfiles.write_token_files(docs.limit(5), str(tmp_path), shards=1)
    path = manifest.files[0]["file"].removeprefix("file:")
    data = open(path, "rb").read()
    (tmp_path / "cut").write_bytes(data[10:])
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(str(tmp_path / "cut"))


def test_the_whole_table_is_in_order(spark, docs):
    got = sorted(tokenfiles.round_trip(docs).collect(), key=lambda r: r.doc_id)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    assert len(rows(docs.select("doc_id"))) == len(got)


def test_reading_has_tasks_for_every_file_and_streams_them(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "READ_IDS", 1000)
    manifest = tokenfiles.write_token_files(docs, str(tmp_path), shards=5)
    assert all(f["file"].startswith("file:") for f in manifest.files)
    got = tokenfiles.read_token_files(spark, manifest, docs)
    assert got.rdd.getNumPartitions() == len(manifest.files) * tokenfiles.PARTS
    file = tokenfiles.TokenFile(manifest.files[0]["file"])
    low, high = manifest.files[0]["low"], manifest.files[0]["high"]
    batches = list(tokenfiles._documents(file, 0, pa.array(range(low, high + 1))))
    assert len(batches) > 1 and sum(b.num_rows for b in batches) == manifest.files[0]["n_keys"]
    assert [x for b in batches for x in b.column(1).to_pylist()] == sorted(x for b in batches for x in b.column(1).to_pylist())
    file.close()
