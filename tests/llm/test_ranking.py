import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import helpers
from tripwright.llm import queries
from tripwright.llm import ranking as R

SF = "/root/testdata/sf0.001"


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, k=10):
    """(item, rank, doc, score) of documents (id, text) and items (id, text) by scoring all of them."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            if doc is None or not bag:
                continue
            m = 25 + 75 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                        for t in words(text) if t in bag)
            if score > 0:
                scores.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=rng.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("documents, terms", [(4096, 16384), (40, 8)])
def test_blocks_of_any_size_against_brute_force(spark, monkeypatch, documents, terms):
    monkeypatch.setattr(R, "DOCUMENTS", documents)
    monkeypatch.setattr(R, "TERMS", terms)
    texts = corpus(1, 500) + ["w1 w2 w3"] * 40 + helpers.ODD
    docs = helpers.table(spark, texts)
    asked = [(i, t) for i, t in enumerate(corpus(2, 12) + ["w1 w1 w59", None, "", "nothing of this", "Été x w59 w58 " + "w7 " * 3000])]
    got = R.rank(docs, spark.createDataFrame(asked, "item_id long, text string")).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute(list(enumerate(texts)), asked)


def test_odd_rows(spark):
    """Rows without id, repeated rows, repeated items, empty tables."""
    docs = [(None, "red fox"), (1, "red fox"), (1, "red hen"), (1, "red hen"), (2, None), (3, ""), (4, "blue hen")]
    items = [(7, "red"), (7, "red"), (7, "zebra"), (None, "red"), (8, "hen")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rank", "2 as score", "'x' as terms", "0 as block")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as n", "2 as floor")
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in R.rank(d, i).collect())
    assert got == brute(docs, [(7, "red"), (8, "hen")])
    assert R.rank(helpers.empty(spark), i).count() == 0
    assert R.rank(d, i.limit(0)).count() == 0
    assert R.rank(d.where("text is null"), i).count() == 0


def test_bounds_leave_out_work():
    """Documents of two unlike kinds: an item of one kind has none of the other's leaves scored."""
    rng = np.random.default_rng(3)
    n, width = 2048, 80
    rows = np.repeat(np.arange(n), 5)
    cols = np.concatenate([np.sort(rng.choice(40, 5, replace=False)) + (40 if i % 2 else 0) for i in range(n)])
    docs = R._Rows.of(rows, cols, rng.integers(1, 1000, len(rows)), n)
    items = R._Rows.of(np.repeat([0, 1], 4), np.array([1, 5, 9, 20, 41, 50, 60, 79]), rng.integers(1, 1000, 8), 2)
    search = R._Search(docs, np.arange(n), items, np.zeros(2, np.int64), width, 10)
    scored = []
    bounds = search.bounds
    search.bounds = lambda rows, level, node: (scored.append(len(rows)), bounds(rows, level, node))[1]
    got = {i: list(zip(s.tolist(), d.tolist())) for i, s, d in search.run()}
    for i in range(2):
        dense = np.zeros(width, np.int64)
        dense[items.cols[i * 4 : i * 4 + 4]] = items.vals[i * 4 : i * 4 + 4]
        scores = docs.products(dense)
        best = np.lexsort((np.arange(n), -scores))[:10]
        assert got[i] == list(zip(scores[best].tolist(), best.tolist()))
    assert sum(scored) < 2 * n


def test_small_tables_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op11_ranked_search(spark, SF).collect()
    assert sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute(docs, items)
