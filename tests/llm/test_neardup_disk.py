import random

import pytest
from brute import near_duplicates as brute
from conftest import rows

from dealcast.llm import common, neardup
from dealcast.llm.neardup import near_duplicates

GROUPS = ["g", "rep", "comp", "minor", "side"]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}


@pytest.fixture(scope="module")
def few_words():
    """Texts of a dozen words: every pair of words is in many texts, and few texts are alike."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(12)}" for _ in range(70)) for _ in range(200)]
    docs = list(enumerate(texts)) + [(500 + i, texts[i] + " w1") for i in (3, 50)]
    return docs, sorted(brute(docs, 2), key=str)


def test_texts_are_moved_only_for_documents_with_a_partner(spark, monkeypatch, few_words):
    """Long lists of unlike documents: their sketches decide, no text is read out
    for them, and a step's shuffle files go when it ends."""
    docs, want = few_words
    written, write = [], common.materialize

    def noted(df):
        out = write(df)
        if out.columns == GROUPS:
            written.append(out)
        return out
    monkeypatch.setattr(common, "materialize", noted)
    monkeypatch.setattr(neardup, "SHORT", 4)
    before = shuffle_files(spark)
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=2)
    left = shuffle_files(spark) - before
    assert written[-1].select("rep").distinct().count() < 100  # the last comparison, of long lists; 201 before
    assert not left
    assert rows(found) == want
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_portions_and_blocks_lose_nothing(spark, monkeypatch):
    """Lists in several portions; blocks that are cut into several groups."""
    for name, value in (("PORTION", 1500), ("BLOCK", 40), ("SIDE", 8), ("SHORT", 4)):
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(120):
        words = base[:rng.choice([30, 52, 60])]
        for at in rng.sample(range(len(words)), rng.choice([1, 2, 4, 6])):
            words[at] = f"x{rng.randrange(10**9)}"
        docs.append((i, " ".join(words)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_duplicates(d, size=2)) == sorted(brute(docs, 2), key=str)
