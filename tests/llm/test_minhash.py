import numpy as np
import pytest

from tripwright.llm import minhash
from tripwright.llm.components import components

from .helpers import ODD, empty, table

SF = "/root/testdata/sf0.001"


def sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(texts):
    s = [sets(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(s[i]), root(i), root(i) == i) for i in range(len(s))}


def result(spark, docs):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}


def test_small_tables_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert result(spark, spark.read.parquet(f"{SF}/documents.parquet")) == brute([d.text for d in docs])


def test_near_copies_and_a_common_passage(spark):
    """A group of near copies of one another, and documents that share half of their words without being alike."""
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(10**6)}"
    base, half = [word() for _ in range(120)], [word() for _ in range(60)]
    texts = []
    for _ in range(60):
        w = list(base)
        for i in rng.integers(0, 120, 3):
            w[i] = word()
        texts.append(" ".join(w))
    texts += [" ".join(half + [word() for _ in range(30)]) for _ in range(60)]
    assert result(spark, table(spark, texts)) == brute(texts)


def test_odd_rows(spark):
    assert result(spark, table(spark, ODD)) == brute(ODD)
    assert minhash.near_duplicates(empty(spark)).count() == 0
    rows = table(spark, ["a b c d e f", "x", "A b c d e F", "y z"]).selectExpr("if(doc_id = 3, null, if(doc_id = 1, 0, doc_id)) as doc_id", "text")
    assert result(spark, rows) == {0: (2, 0, True), 2: (2, 0, False)}
    assert {(r.doc_id, r.text) for r in minhash.keep_one(rows).collect()} == {(0, "a b c d e f"), (None, "y z")}


@pytest.mark.parametrize("n", [1, 3, 40, 5000])
def test_sketch_fills_and_agrees_with_the_similarity(n):
    rng = np.random.default_rng(n)
    hits = []
    for _ in range(6):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.concatenate([a[: max(1, n * 6 // 7)], rng.integers(0, 2**63, n // 7, dtype=np.uint64)])
        x, y = minhash.sketch(a), minhash.sketch(b)
        assert x.max() < np.iinfo(np.uint64).max and np.array_equal(x, minhash.sketch(a[::-1].copy()))
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        hits.append((x == y).mean() - j)
    assert abs(np.mean(hits)) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, 7), (7, 55), (55, 100), (3, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 10 for i in range(10, 41)}, 7: 7, 55: 7, 100: 7}
