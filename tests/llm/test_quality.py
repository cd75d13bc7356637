from tripwright.llm import quality

from .helpers import ODD, empty, table, untouched


def measures(text):
    words = (text or "").encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    chars = "".join(w.decode() for w in words)
    return len(words), len(chars), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_measures(spark):
    texts = [x for x in ODD if len(x or "") < 20000] + ["a b c d a b c", "x y\nx y\n x y", "# * é|< >", "a a a a", "\x1c \x85"]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality(table(spark, texts)).collect()}
    assert got == {i: measures(t) for i, t in enumerate(texts)}
    assert quality.quality(empty(spark)).count() == 0


def test_lines_of_a_host(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    short = lambda i: " ".join(f"s{i}x{k}" for k in range(52))
    line = " ".join(f"menu{k}" for k in range(55))
    many = [f"{own(i)}\n  {line.upper()} " for i in range(30)]
    depleted = [f"{short(i)[:40]}\n{line}" for i in range(3)]
    copies = [own(99) + "\n" + own(98)] * 40
    texts = many + depleted + copies
    docs = table(spark, texts)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert all(got[i].n_removed_words == 55 and got[i].kept for i in range(30))
    assert all(got[i].depleted and not got[i].kept for i in range(30, 33))
    assert all(got[i].n_removed_words == 120 and got[i].depleted for i in range(33, 73))
    left = quality.clean_documents(docs)
    assert untouched(left, docs) and {r.doc_id: r.text for r in left.collect()} == {i: own(i) for i in range(30)}

    # copies spared: they count as one text, and the first holder keeps a line
    got = {r.doc_id: r for r in quality.quality(docs, spare_copies=True).collect()}
    assert got[0].n_removed_words == 0 and got[0].kept
    assert all(got[i].n_removed_words == 55 and got[i].kept for i in range(1, 30))
    assert all(got[i].depleted and not got[i].kept for i in range(30, 33))
    assert all(got[i].kept and got[i].n_removed_words == 0 for i in range(33, 73))
    left = {r.doc_id: r for r in quality.clean_documents(docs, spare_copies=True).collect()}
    assert set(left) == {i for i in got if got[i].kept}
    assert left[0].text == many[0] and left[5].text == own(5) and left[40].text == copies[0] and left[5].n_words == "n_words 5"
    # on another host each, no line is common
    apart = table(spark, texts).selectExpr("* except (source)", "cast(doc_id as string) as source")
    assert quality.quality(apart).where("n_removed_words > 0").count() == 0


def test_missing_and_repeated_ids(spark):
    rows = table(spark, ["w " * 60, "x", "x"]).selectExpr("if(doc_id = 0, null, 5) as doc_id", "text", "cast(null as string) as source")
    assert quality.quality(rows).count() == 3
    assert quality.clean_documents(rows.unionAll(rows)).count() == 0


def verdicts(rows, max_docs=20):
    """The whole verdict by the rules: (doc_id, lost words, kept) of rows (doc_id, source, text)."""
    norm = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(y.decode() for y in x.encode().split()))
    holders = {}
    for d, s, t in rows:
        for x in (t or "").split("\n"):
            if x.encode().split():
                holders.setdefault((s, norm(x)), set()).add(d)
    out = []
    for d, s, t in rows:
        n, _, _, _, again = measures(t)
        lost = sum(len(x.encode().split()) for x in (t or "").split("\n") if x.encode().split() and len(holders[s, norm(x)]) > max_docs)
        failed = n < 50 or 100 * again > 50 * n
        out.append((d, lost, not failed and 100 * (n - lost) >= 50 * n))
    return sorted(out)


def test_small_tables_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect() if len(r.text or "") < 20000]
    held = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for limit in (20, 1):
        got = quality.quality(held, max_docs=limit).collect()
        assert sorted((r.doc_id, r.n_removed_words, r.kept) for r in got) == verdicts(rows, limit)
