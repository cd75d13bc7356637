import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm import helpers
from tripwright.llm import queries
from tripwright.llm import runs as R

SF = "/root/testdata/sf0.001"


def brute(w):
    """(start, length, period) by trying every period at every place."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q):
                seg = w[i : i + size]
                if all(any(seg[k] != seg[k + d] for k in range(size - d)) for d in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts(seed, count):
    rng, out = random.Random(seed), []
    for _ in range(count):
        w = [rng.randrange(rng.choice([1, 2, 3, 5, 20])) for _ in range(rng.randrange(0, 70))]
        n = len(w)
        if n > 4 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(1 + (n - a) // 4)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            if rng.random() < 0.4:
                w = w + w
        out.append(w)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_brute_force(seed):
    cases = texts(seed, 800)
    ids = np.array([x for w in cases for x in w], np.int64)
    assert R.runs_of(ids, list(map(len, cases))) == [brute(w) for w in cases]


def test_unions_of_any_size():
    """Small sets into a large one, and sets of like size, give the same adjacent pairs."""
    rng = random.Random(1)
    for _ in range(300):
        all_of = rng.sample(range(1000), rng.randrange(2, 200))
        cuts = [all_of[0::7], all_of[1::7], [x for k in range(2, 7) for x in all_of[k::7]]] if len(all_of) > 7 else [all_of[:1], all_of[1:]]
        sets = [sorted(x) for x in cuts if x]
        owner = {x: k for k, s in enumerate(sets) for x in s}
        want = sorted(all_of)
        united, pairs = R._unite([list(s) for s in sets])
        assert united == want
        assert sorted(pairs) == [(x, y) for x, y in zip(want, want[1:]) if owner[x] != owner[y]]


def test_table_with_odd_rows(spark):
    long = "w " * 60000 + " ".join(f"u{i}" for i in range(60000)) + " a b c" * 20000
    docs = helpers.table(spark, [*helpers.ODD, long, "a b a b a b a b", "a b a b a b a b"])
    got = R.periodic_runs(docs).collect()
    assert len(got) == docs.count()
    want = {r.doc_id: (r.text or "").encode().split() for r in docs.collect()}
    for r in got:
        w = want[r.doc_id]
        assert r.n_words == len(w)
        found = [(x.start, x.length, x.period) for x in r.runs]
        if len(w) <= 200:
            assert found == brute(w)
        assert r.collapsed == collapsed([x.decode() for x in w], found)
    by = {r.doc_id: [tuple(x) for x in r.runs] for r in got}
    assert by[len(helpers.ODD)] == [(0, 60000, 1), (120000, 60000, 3)]
    assert by[5] == [(0, 12000, 3)]
    assert R.periodic_runs(helpers.empty(spark)).count() == 0


def test_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a a a a a a a"), (None, None), (3, "")], "doc_id long, text string")
    got = {(r.doc_id, r.n_words, len(r.runs), r.collapsed) for r in R.periodic_runs(R.repeat_tails(docs)).collect()}
    assert got == {(None, 7, 1, "a"), (None, 0, 0, ""), (3, 0, 0, "")}


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    repeated = 0
    for d in docs:
        w = (d.text or "").encode().split()
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            repeated += 1
        number = {}
        found = brute([number.setdefault(x, len(number)) for x in w])
        r = got[d.doc_id]
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed([x.decode() for x in w], found).encode()).hexdigest()
    assert repeated > 5
