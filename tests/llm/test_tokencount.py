import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tripwright.llm import tokencount as T
from tripwright.llm.tokenizer_files import PIECES

from .helpers import ODD, empty, table

SF = "/root/testdata/sf0.001"
COSTS, BYTE = T.piece_costs(PIECES)


def brute(word):
    """Tokens of one pre-token, each prefix scored for this word alone."""
    text, best = T.MARK + word, [0]
    for end in range(1, len(text) + 1):
        options = [best[end - 1] + BYTE * len(text[end - 1].encode())]
        options += [best[b] + COSTS[text[b:end]] for b in range(max(0, end - 20), end) if text[b:end] in COSTS]
        best.append(min(options))
    return best[-1] % T.MANY


def expected(text):
    words = [w.decode() for w in (text or "").encode().split()]
    return len(words), len(set(words)), sum(map(brute, words))


def test_odd_rows(spark):
    texts = ODD + ["x" * 3000, "日本 word 😀", "the" * 90 + "日" * 400 + " a " + "base64" * 500]
    got = {r.doc_id: (r.n_words, r.n_distinct_words, r.n_tokens) for r in T.token_counts(table(spark, texts), PIECES).collect()}
    assert got == {i: expected(t) for i, t in enumerate(texts)}
    assert T.token_counts(empty(spark), PIECES).count() == 0


def test_small_tables(spark):
    docs = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet' where length(text) < 3000").fetchall()
    got = {r.doc_id: (r.n_words, r.n_distinct_words, r.n_tokens) for r in T.token_counts(spark.read.parquet(f"{SF}/documents.parquet"), PIECES).collect()}
    assert len(got) == 200 and all(got[d] == expected(t) for d, t in docs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="thenig é日", min_size=1, max_size=12).filter(lambda x: x.strip()), max_size=8))
def test_shared_prefixes_change_nothing(words):
    trie = T.Trie(COSTS, BYTE)
    assert [trie.insert(T.MARK + w) for w in words + words[::-1]] == [brute(w) for w in words + words[::-1]]


def test_a_full_trie_starts_anew(monkeypatch):
    monkeypatch.setattr(T, "NODES", 10)
    trie = T.Trie(COSTS, BYTE)
    words = ["thereabouts", "therefore", "thin", "thereabouts"] * 3
    assert [trie.insert(T.MARK + w) for w in words] == [brute(w) for w in words]


def test_a_word_of_some_megabytes():
    """One word, a text without blanks, is scored within the trie's depth and without a node per character."""
    trie, word = T.Trie(COSTS, BYTE), "QmFzZTY0" * 150_000
    short = "QmFzZTY0" * 100
    assert trie.insert(T.MARK + short) == brute(short)
    n = trie.insert(T.MARK + word)
    per = (brute("QmFzZTY0" * 300) - brute("QmFzZTY0" * 200)) / 100
    assert abs(n - per * 150_000) < 20 and len(trie.score) <= T.DEPTH + 2
