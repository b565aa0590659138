import random
import zlib

import numpy as np
import pyarrow as pa
import zstandard

from dealcast.llm import language as L


def tongue(k):
    """Words of an invented language: syllables of its own."""
    rng = random.Random(k)
    own = ["".join(rng.choice("bcdfghjklmnprstvz") + rng.choice("aeiouyäöüéñ") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    return lambda r, n: " ".join(r.choice(own) for _ in range(n))


def test_every_language_is_learned(spark):
    rng = random.Random(5)
    rows = [(k * 20 + i, f"l{k:03d}", tongue(k)(rng, 60)) for k in range(150) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    assert sorted(L.learn(docs)) == [f"l{k:03d}" for k in range(150)]
    got = {r.doc_id: r for r in L.language(docs).collect()}
    held = [(got[d], lang) for d, lang, _ in rows if got[d].held_out]
    assert len(held) > 150 and np.mean([r.lang_pred == lang for r, lang in held]) >= 0.97


def test_a_repeated_id_or_text_is_no_larger_sample(spark):
    """A third of the rows share an id, another third a text."""
    rng = random.Random(6)
    say = tongue(1)
    own = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 5)
    rows = [(own, "a", say(rng, 30)) for _ in range(300)] + [(1000 + i, "a", "the same words again") for i in range(300)]
    rows += [(2000 + i, "a" if i % 2 else "b", (say if i % 2 else tongue(2))(rng, 30)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = L.learn(docs, texts=40, share=1024)
    assert set(found) == {"a", "b"} and found["a"].count(b"the same words again") <= 1
    assert len(found["a"]) <= 40 * 1025 and L.learn(docs, size=2000, texts=40) != found
    assert max(map(len, L.learn(docs, total=4096).values())) <= 2048


def test_blocks_come_from_the_whole_text():
    data = b"".join(b"%08d" % k for k in range(10_000))
    blocks = L._spread(data, 8)
    at = [int(b[:8]) if b[:8].isdigit() else -1 for b in blocks]
    assert len(blocks) == 8 and at == sorted(at) and at[-1] > 5000 and all(b in data for b in blocks)
    assert L._spread(b"short", 8) == [b"short"] and L._spread(b"", 8) == []


def test_predictions_equal_plain_compression(spark):
    """Sizes by plain loops, with a compressor made anew for each block."""
    rng = random.Random(7)
    words = {k: tongue(k) for k in "abc"}
    dictionaries = {k: words[k](rng, 400).encode() for k in "abc"}
    texts = [(i, words[rng.choice("abc")](rng, rng.choice([1, 5, 40, 900])).title() + " 12, " * (i % 3)) for i in range(60)] + [(99, "!!"), (100, None)]

    def plain(text):
        letters = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
        if not letters:
            return "und", 0.0
        data = letters.encode()
        sizes = {}
        for k, d in dictionaries.items():
            sizes[k] = 0
            for at in range(0, len(data), L.BLOCK):
                own = zstandard.ZstdCompressor(level=L.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                               write_content_size=False, write_checksum=False)
                sizes[k] += len(own.compress(data[at:at + L.BLOCK]))
        best, second = sorted(sizes.items(), key=lambda x: (x[1], x[0]))[:2]
        return best[0], (second[1] - best[1]) / second[1]

    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in L.predict(docs, dictionaries).collect()}
    for i, text in texts:
        lang, score = plain(text)
        assert (got[i].lang_pred, round(got[i].score, 12)) == (lang, round(score, 12)) and got[i].accepted == (score >= L.MARGIN and lang != "und")
    two = {r.doc_id: r.lang_pred for r in L.predict(docs, dictionaries, shortlist=2).collect()}
    assert np.mean([two[i] == got[i].lang_pred for i, _ in texts]) > 0.95


def test_no_language_is_left_out_by_the_probe(spark):
    """Twenty languages; the blocks that the probe draws are of others than the rest of the text."""
    rng = random.Random(9)
    names = [f"l{k:02d}" for k in range(20)]
    words = {n: tongue(50 + k) for k, n in enumerate(names)}
    dictionaries = {n: words[n](rng, 400).encode() for n in names}
    texts = []
    for i in range(12):
        data = L._letters(pa.array([words[names[i]](rng, 3000)]))[0].as_py().encode()
        drawn = [data.index(x) for x in L._spread(data, L.PROBE)]
        others = L._letters(pa.array([" ".join(words[n](rng, 40) for n in names if n != names[i])]))[0].as_py().encode()
        cut = [data[k:k + L.BLOCK] for k in range(0, len(data), L.BLOCK)]
        for at in drawn:  # a block of other languages in the place of a drawn one, if it is drawn again
            cut[at // L.BLOCK] = (others * 3)[at % 97:at % 97 + L.BLOCK]
        texts.append((i, b"".join(cut).decode(errors="ignore")))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    whole = {r.doc_id: r for r in L.predict(docs, dictionaries, shortlist=len(names)).collect()}
    for few in (1, 2, 16):
        got = {r.doc_id: r for r in L.predict(docs, dictionaries, shortlist=few).collect()}
        assert got == whole, few
    assert [whole[i].lang_pred for i, _ in texts] == names[:12]
