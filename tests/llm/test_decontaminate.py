import re

from tripwright.llm import decontaminate as D

from .helpers import ODD, empty, table, untouched


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(10, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [
    (11, "The quick brown fox jumps over the lazy dog while seven wizards boxed 12 times."), (2, "short ITEM é"), (30, "short item é"),
    (4, None), (5, "!!! ..."), (6, "one"), (7, "a b c d e f g h i j"),
]
TEXTS = ODD + [
    "x the QUICK brown-fox jumps over the lazy dog while seven wizards y", "short item éa", "Short, item: é. one", "a b c d e f g h i j " * 3,
    "brown fox jumps over the lazy dog while seven", "zero\x00one\x7ftwo",
]


def result(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in D.contamination(docs, bench).collect()}


def test_against_brute_force(spark):
    assert result(spark, table(spark, TEXTS), ITEMS) == {i: brute(t, ITEMS) for i, t in enumerate(TEXTS)}
    assert result(spark, table(spark, TEXTS), []) == {i: (len(words(t)), 0, []) for i, t in enumerate(TEXTS)}
    assert result(spark, empty(spark), ITEMS) == {}


def test_shuffled_windows(spark, monkeypatch):
    """Beyond the bound of the broadcast the result is the same."""
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert result(spark, table(spark, TEXTS), ITEMS) == {i: brute(t, ITEMS) for i, t in enumerate(TEXTS)}


def test_documents_and_spans(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    rows = table(spark, ["x, (A b c d e f g h i j k) y!", "x y", None, "x y"]).selectExpr("* except (doc_id)", "if(doc_id = 3, null, doc_id) as doc_id")
    assert {(r.doc_id, r.text) for r in D.decontaminate(rows, bench).collect()} == {(1, "x y"), (2, None), (None, "x y")}
    got = {(r.doc_id, r.text) for r in D.remove_spans(rows, bench).collect()}
    assert got == {(0, "x, () y!"), (1, "x y"), (2, None), (None, "x y")}


def test_repeated_ids(spark):
    bench = spark.createDataFrame([(1, "p q")], "item_id long, text string")
    rows = table(spark, ["p q", "r", "p q"]).selectExpr("7 as doc_id", "text")
    assert sorted((r.n_words, r.n_hit) for r in D.contamination(rows, bench).collect()) == [(1, 0), (2, 2), (2, 2)]


def test_columns_of_any_name(spark):
    bench = spark.createDataFrame([(1, "p q")], "item_id long, text string")
    docs = table(spark, ["x p q y", "r", None])
    assert untouched(D.decontaminate(docs, bench), docs) and untouched(D.remove_spans(docs, bench), docs)
