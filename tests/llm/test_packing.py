import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripwright.llm.packing import LENGTH, choose_cuts, pack, split_rest
from tripwright.llm.queries import op10_packing
from tripwright.llm.tokenizer_files import BYTE_LEVEL

from .helpers import ODD, crc, empty, table

SF = "/root/testdata/sf0.001"


def brute(texts):
    t = Tokenizer.from_file(BYTE_LEVEL)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def check(pieces, ids_of):
    """Every id in one piece, offsets gapless; returns the share of padding."""
    docs, seqs = {}, {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append(p)
        seqs.setdefault(p.sequence_id, []).append(p)
    assert docs.keys() == ids_of.keys()
    for doc_id, own in docs.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids_of[doc_id])) and p.length > 0
            assert p.ids_crc32 == crc(ids_of[doc_id][at : at + p.length])
            at += p.length
        assert at == len(ids_of[doc_id])
    padding = 0
    for own in seqs.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= LENGTH
        padding += LENGTH - at if at & (at - 1) else 0
    return padding / max(1, sum(map(len, ids_of.values())))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
    assert check(op10_packing(spark, SF).collect(), ids) < 0.02


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    got = pack(table(spark, ODD), BYTE_LEVEL, 1, partitions=2).withColumn("ids_crc32", F.crc32("ids")).collect()
    check(got, dict(enumerate(brute(ODD))))
    assert pack(empty(spark), BYTE_LEVEL, 1).count() == 0


def test_repeated_and_missing_ids(spark):
    rows = table(spark, ["b", "a", None]).selectExpr("if(doc_id = 2, null, 7) as doc_id", "text")
    got = pack(rows, BYTE_LEVEL, 1, partitions=1).orderBy("sequence_id", "offset").collect()
    assert list(dict.fromkeys(p.doc_id for p in got)) == [None, 7] and sum(p.length for p in got) == 5


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 3)), min_size=1, max_size=14))
def test_cuts_are_the_cheapest(steps):
    length = 10
    places = np.cumsum([s for s, _ in steps]).tolist()
    pens = [p for _, p in steps]
    best = {0: 0}
    for p, c in zip(places, pens):
        best[p] = min(best[q] + length - (p - q) + c for q in best if p - q <= length)
    cuts, at, cost = choose_cuts(places, pens, length), 0, 0
    for cut in cuts:
        assert cut - at <= length
        cost += length - (cut - at) + pens[places.index(cut)]
        at = cut
    assert at == places[-1] and cost == best[at]


def test_rest():
    assert split_rest(1024, 2048) == [1024] and sum(split_rest(1733, 2048)) == 1733 and split_rest(2040, 2048) == [2040]
