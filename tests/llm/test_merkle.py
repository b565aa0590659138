import hashlib
import zlib

import pytest
from conftest import rows

from dealcast.llm import merkle as M

EDGES = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 2), (None, "c", "en", None, 3), (2, None, None, "s", None), (2, "", None, "s", 0),
         (7, "é" * 5000, "fr", "t", 5), (-4, "x:y", "fr", "t", None), (9, "lone", "zz", "t", 4), (10, "y", "", "t", 4)]


def manifest(docs, **how):
    return M.manifest(M.tampered_documents(docs), check="check", **how)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(docs):
    """The manifest by lists: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, text, lang, source, n):
        return sha("".join(map(enc, (d, source, lang, n, text))))

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            out.append((i & 1, level[i ^ 1] if i ^ 1 < len(level) else ""))
            i >>= 1
        return out

    groups = {}
    for r in docs:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([leaf(*r) for r in sorted(groups[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for g, x in enumerate(langs):
        for i, r in enumerate(sorted(groups[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))):
            way = siblings(trees[x], i) + siblings(top, g)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            cur = leaf(*r[:4], r[4] + 1) if hit and r[4] is not None else leaf(*r)
            for side, s in way:
                cur = sha(s + cur if side else cur + s)
            out.append((r[0], leaf(*r), trees[x][-1][0], top[-1][0], sha("".join(s for _, s in way)), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def table(spark, docs):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in docs], "doc_id long, text string, lang string, source string, n_chars long, leaf string, pos int, g int")


@pytest.mark.parametrize("bits", [1, 2, 11])
def test_edge_cases(spark, bits):
    got = manifest(table(spark, EDGES), bits=bits).drop("lang")
    assert rows(got) == plain(EDGES)


def test_small_tables(spark):
    one = EDGES[6:7]
    assert rows(manifest(table(spark, one)).drop("lang")) == plain(one)
    assert manifest(table(spark, EDGES).limit(0)).count() == 0


@pytest.mark.parametrize("bits", [3, 11])
def test_a_whole_table_of_any_block_size(spark, docs, bits):
    have = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    got = manifest(docs, bits=bits, keep_proofs=True)
    assert rows(got.drop("lang", "proof", "path")) == plain(have)
    for r in got.collect()[:20]:
        assert M.fold(r.leaf, r.proof, r.path) == r.root and sha(r.proof) == r.proof_sha256
        assert r.verified == (r.folded_root == r.root)


def test_many_groups_and_a_hot_one(spark):
    have = [(i, f"t{i}", f"g{i}" if i % 3 else "hot", "s", i) for i in range(300)]
    assert rows(manifest(table(spark, have), bits=2).drop("lang")) == plain(have)


def test_one_block():
    nodes = M.forward([sha(str(i)) for i in range(5)], 3)
    assert [len(x) for x in nodes] == [5, 3, 2, 1]
    for i, (proof, path) in enumerate(M.backward(nodes, "", "")):
        assert M.fold(sha(str(i)), proof, path) == nodes[-1][0] and len(path) == 3
    assert M.forward(["a"], 0) == [["a"]] and M.backward([["a"]], "p", "L") == [("p", "L")]
    assert M.forward(["a"], 2)[-1] == [M.digest_of(M.digest_of("a"))]  # a node that is alone goes up by its own digest
