import numpy as np
from pyspark.sql import functions as F

from tripwright.llm import components as C
from tripwright.llm import lines as L

from .helpers import ODD, empty, table, untouched

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, n):
    x = list(text)
    for _ in range(n):
        at, what = int(rng.integers(len(x) + 1)), rng.integers(3)
        x[at : at + int(what > 0)] = ["é"] * int(what < 2)
    return "".join(x)


def test_distance_and_segments(spark):
    rng = np.random.default_rng(4)
    rows = []
    for n in (0, 1, 2, 3, 9, 30, 70, 200):
        for _ in range(40):
            a = "".join(rng.choice(list("abé日"), n))
            rows += [(a, edited(rng, a, int(rng.integers(5))) if a else "x"), (a, "".join(rng.choice(list("ab"), n)))]
    pairs = spark.createDataFrame(rows, "a string, b string")
    for edits in (1, 2, 3):
        got = pairs.select(L.within_edits(F.col("a"), F.col("b"), edits).alias("x"), (F.levenshtein("a", "b") <= edits).alias("y"), "a", "b")
        assert got.where("x is null or x <> y").count() == 0
        near = pairs.where((F.levenshtein("a", "b") <= edits) & (F.least(F.length("a"), F.length("b")) > edits))
        near = near.select(F.when(F.length("a") < F.length("b"), F.col("a")).otherwise(F.col("b")).alias("s"), F.when(F.length("a") < F.length("b"), F.col("b")).otherwise(F.col("a")).alias("t"))
        keys = F.arrays_overlap(F.array(*L._index_keys(F.col("s"), F.length("s"), edits)), F.array_compact(F.array(*L._probe_keys(F.col("t"), F.length("t"), edits))))
        assert near.where(~keys).count() == 0


def brute(texts):
    """Removed lines per document: of linked lines, the first by document stays."""
    rows = [(i, k, x.strip(" \t\r\x0b\x0c")) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n"))]
    rows = [r for r in rows if r[2]]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, (_, _, x) in enumerate(rows):
        for j in range(i):
            y = rows[j][2]
            if abs(len(x) - len(y)) <= 2 and (x == y or (len(set(x) ^ set(y)) <= 4 and distance(x, y) <= 2)):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    out = {i: [] for i in range(len(texts))}
    for i, (doc, pos, _) in enumerate(rows):
        if root(i) != i:
            out[doc].append(pos)
    return out


def result(spark, docs):
    return {r.doc_id: list(r.removed) for r in L.line_report(docs).collect()}


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abcdefgh "), int(rng.integers(26, 60)))).strip() + "end" for _ in range(25)]
    texts = ODD + ["\n".join(edited(rng, pool[i], int(rng.integers(4))) for i in rng.integers(0, 25, 6)) for _ in range(40)]
    assert result(spark, table(spark, texts)) == brute(texts)
    assert L.line_report(empty(spark)).count() == 0


def test_segments_around_one_edit(spark):
    rng = np.random.default_rng(6)
    rows = []
    for n in (24, 25, 31, 64, 90):
        for _ in range(60):
            a = "".join(rng.choice(list("abcé"), n))
            rows.append(tuple(sorted((a, edited(rng, a, 1)), key=len)))
    pairs = spark.createDataFrame(rows, "s string, t string").where("levenshtein(s, t) <= 1")
    keys = lambda c: F.array(*L._around_keys(F.col(c), F.length(c), 8))
    assert pairs.where(~F.arrays_overlap(keys("s"), keys("t"))).count() == 0


def test_lines_that_share_a_half(spark):
    """Many lines with the same beginning and ends of their own, and pairs among them."""
    rng = np.random.default_rng(7)
    ends = ["".join(rng.choice(list("abcdefgh"), 30)) for _ in range(40)]
    texts = ["the same beginning in all the lines " + x for e in ends for x in (e, e[:12] + "X" + e[12:])]
    assert result(spark, table(spark, texts)) == brute(texts)


def test_a_large_group_of_near_equal_lines(spark):
    texts = [f"This page was shown {i:05d} times before today" for i in range(100)]
    got = result(spark, table(spark, texts))
    assert got == brute(texts)


def test_small_tables(spark):
    """Every line of a document is there once more at most in what stays, and a second run finds nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = L.remove_lines(docs).cache()
    assert left.columns == docs.columns and 0 < left.count() <= docs.count()
    assert L.duplicate_lines(left).count() == 0
    kept = [x.strip() for r in left.collect() for x in (r.text or "").split("\n") if x.strip()]
    assert len(kept) == len(set(kept))


def test_ids(spark):
    line = "the same line in every document here"
    rows = table(spark, [line, line + "\n" + line, line + "."]).selectExpr("if(doc_id = 0, null, 4) as doc_id", "text")
    got = sorted((r.doc_id or -1, r.n_lines, list(r.removed)) for r in L.line_report(rows).collect())
    assert got == [(-1, 1, [0]), (4, 1, []), (4, 2, [1])]
    assert sorted((r.doc_id, r.text) for r in L.remove_lines(rows).collect()) == [(4, line), (4, line + ".")]


def test_two_edits_by_default(spark):
    """The threshold is a number of this test: two edits are linked by default, three are not."""
    base = "a line of some length that stands in several documents"
    texts = [base, base.replace("some", "sxme").replace("several", "severel"), "zzz" + base[3:-3] + "zzz"]
    assert L.EDITS == 2 and result(spark, table(spark, texts)) == {0: [], 1: [0], 2: []}


def test_segments_around_two_edits(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in (24, 25, 31, 64, 90):
        for _ in range(60):
            a = "".join(rng.choice(list("abcé"), n))
            rows.append(tuple(sorted((a, edited(rng, a, 2)), key=len)))
    pairs = spark.createDataFrame(rows, "s string, t string").where("levenshtein(s, t) <= 2")
    keys = lambda c: L._around_two_keys(F.col(c), F.length(c), 8)
    assert pairs.where(~F.arrays_overlap(keys("s"), keys("t"))).count() == 0


def test_short_lines(spark):
    """Lines of any length are compared, those of no more characters than edits as well."""
    rng = np.random.default_rng(9)
    texts = ["\n".join("".join(rng.choice(list("abé"), int(rng.integers(0, 9)))) for _ in range(4)) for _ in range(30)] + ["x", "yz", "", " "]
    assert result(spark, table(spark, texts)) == brute(texts)
    far = ["abcdefgh", "ijklmnop", "qrstuvwx", "abcdefgh"]
    assert result(spark, table(spark, far)) == {0: [], 1: [], 2: [], 3: [0]}


def test_small_tables_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 70").orderBy("doc_id")
    texts = [r.text for r in docs.collect()]
    assert result(spark, docs) == brute(texts)


def test_columns_of_any_name(spark):
    docs = table(spark, ["a line that stands here twice", "a line that stands here twice\nand something else altogether", None, ""])
    left = L.remove_lines(docs)
    assert untouched(left, docs) and {r.doc_id: r.text for r in left.collect()} == {
        0: "a line that stands here twice", 1: "and something else altogether", 2: None, 3: ""}


def test_texts_of_some_megabytes(spark):
    rng = np.random.default_rng(10)
    long = "\n".join("".join(rng.choice(list("abcdefgh "), 500)).strip() for _ in range(2000)) + "\n" + "z" * 1_000_000
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in L.line_report(table(spark, [long, long])).collect()}
    assert got == {0: (2001, 0), 1: (2001, 2001)}


def test_keys_are_made_for_wanted_lines_only(spark, monkeypatch):
    """No filter on a scan works keys out, and an index key is worked out where it is written only."""
    plans, real = [], L.materialize
    from tripwright.llm import components

    def watch(df, name="stage"):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(L, "materialize", watch)
    monkeypatch.setattr(components, "materialize", watch)
    texts = ["the same beginning in all the lines " + x for x in ("one thing", "another of them", "a third", "one thin")]
    assert L.line_report(table(spark, texts)).count() == 4
    assert len(plans) > 5
    for plan in plans:
        for line in plan.splitlines():
            if "Filter" in line:
                assert "transform(" not in line and "substring" not in line and "xxhash64(line" not in line, line


def test_counts_rule_out_no_link(spark):
    rng = np.random.default_rng(12)
    rows = []
    for n in (1, 3, 20, 90, 700):
        for _ in range(60):
            a = "".join(rng.choice(list("abcéXYZ 0123.,日"), n))
            rows += [(a, edited(rng, a, int(rng.integers(3)))), (a, "".join(rng.choice(list("abcéXYZ 0123.,日"), n)))]
    pairs = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", L._counts(F.col("a")).alias("x"), L._counts(F.col("b")).alias("y"))
    allowed = pairs.withColumn("ok", L._counts_allow("x", "y", 2))
    assert allowed.where("levenshtein(a, b) <= 2 and not ok").count() == 0
    assert allowed.where("levenshtein(a, b) > 10 and not ok").count() > 80


def test_many_lines_with_a_word_replaced(spark):
    """A family of long lines, each with one word replaced, and pairs of near ones among them."""
    rng = np.random.default_rng(13)
    w = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(30)]
    family = []
    for i in range(60):
        x = list(w)
        x[int(rng.integers(30))] = "".join(rng.choice(list("mnopqrst"), 7))
        family.append(" ".join(x))
    texts = family + [edited(rng, x, 2) for x in family[::6]]
    assert result(spark, table(spark, texts)) == brute(texts)


def test_long_lines_meet_by_few_keys(spark):
    """Lines two edits apart share a key wherever the edits are and on whichever side of a class's border their lengths."""
    rng = np.random.default_rng(21)
    rows = []
    for n in (30, 31, 32, 33, 34, 39, 40, 41, 95, 96, 97, 200, 255, 256, 257, 258, 300):
        for _ in range(60):
            a = "".join(rng.choice(list("abé日"), n))
            rows.append((a, edited(rng, edited(rng, a, 1), 1)))
    sides = [spark.createDataFrame([(i, r[k], len(r[k])) for i, r in enumerate(rows)], "id long, line string, n int") for k in (0, 1)]
    keys = [L._keyed(side, 2).distinct() for side in sides]
    assert keys[0].join(keys[1], ["id", "key"]).select("id").distinct().count() == len(rows)
    # the three parts and the moved ones of every length took twelve; the middle of a class takes two, its ends one each
    many = spark.createDataFrame([(i, "".join(rng.choice(list("abcdefgh"), 60 + i)), 60 + i) for i in range(200)], "id long, line string, n int")
    assert L._keyed(many, 2).count() < 6 * 200


def test_small_buckets_are_compared_as_they_are(spark):
    """Buckets of a few unlike lines are not dealt anew by narrower keys, and their links are found."""
    members = spark.createDataFrame([(k, i, 0) for k in range(5) for i in range(10 * k, 10 * k + 3 + k)], "key long, id long, n int")
    linked = lambda pairs: pairs.where("floor(a / 10) = floor(b / 10) and b - a = 1 and a % 10 > 0")
    offered = []

    def confirm(pairs):
        offered.extend((r.a, r.b) for r in pairs.collect())
        return linked(pairs)

    def refine(ids):
        raise AssertionError("no bucket is large")

    got = C.linked_members(members, confirm, lambda n, m: F.lit(True), refine, few=8)
    assert {r.id: r.component for r in got.collect()} == {10 * k + i: 10 * k + 1 for k in range(5) for i in range(1, 3 + k)}
    assert len(offered) == len(set(offered)) == sum((3 + k) * (2 + k) // 2 for k in range(5))


def test_larger_buckets_go_on_to_narrower_ones(spark):
    """What small buckets leave to the large ones is met there: lines of one beginning, more of them than are compared at once."""
    rng = np.random.default_rng(22)
    start = "a beginning that a good number of lines have in common, "
    tails = ["".join(rng.choice(list("abcdefghijkl"), 40)) for _ in range(L.FEW + 9)]
    texts = [start + t for t in tails] + [start + edited(rng, t, 2) for t in tails[3:9]] + [tails[0], tails[1] + "x"]
    assert result(spark, table(spark, texts)) == brute(texts)
