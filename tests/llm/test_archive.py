import numpy as np
import pytest
from tokenizers import Tokenizer

from tripwright.llm import archive
from tripwright.llm.queries import op9_token_archive
from tripwright.llm.tokenizer_files import WORD_LEVEL
from tripwright.session import stage_path

from .helpers import ODD, crc, empty, table

SF = "/root/testdata/sf0.001"


def brute(texts):
    t = Tokenizer.from_file(WORD_LEVEL)
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def expected(rows):
    out, start = {}, 0
    for doc_id, ids in rows:
        out[doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = expected(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op9_token_archive(spark, SF).collect()}
    assert got == want


def test_odd_rows_and_requested_documents(spark):
    path = stage_path(spark, "odd")
    archive.write_token_files(table(spark, ODD), path, WORD_LEVEL, 2, partitions=3)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in archive.token_documents(spark, path).collect()}
    assert got == expected(enumerate(brute(ODD)))
    some = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in archive.read_token_files(spark, path, [3, 5]).collect()}
    assert some == {i: brute(ODD)[i] for i in (3, 5)}


def test_missing_and_repeated_ids(spark):
    rows = table(spark, ["b", "a", "c"]).selectExpr("if(doc_id = 2, null, 7) as doc_id", "text")
    path = stage_path(spark, "ids")
    archive.write_token_files(rows, path, WORD_LEVEL, 2, partitions=2)
    got = [(r.doc_id, r.start, r.n_tokens) for r in archive.token_documents(spark, path).orderBy("start").collect()]
    assert got == [(None, 0, 2), (7, 2, 2), (7, 4, 2)]


def test_empty_table(spark):
    path = stage_path(spark, "none")
    archive.write_token_files(empty(spark), path, WORD_LEVEL, 2)
    assert archive.token_documents(spark, path).count() == 0


def test_many_frames_and_checksums(monkeypatch):
    file = archive._File(5, 1)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 49408, n).astype(np.uint32) for n in (1, 90_000, 70_000, 3, 200_000)]
    for i, ids in enumerate(docs):
        file.add(i if i else None, ids, 10 * i)
    data = file.data() + archive.SEEKABLE_MAGIC.to_bytes(4, "little")
    got = list(archive.read_file(data))
    assert [(b, n, d, before) for b, n, d, before, _ in got] == [(5, 1, i or None, 10 * i) for i in range(5)]
    assert all(np.array_equal(a, x[4]) for a, x in zip(docs, got))
    assert [x[2] for x in archive.read_file(data, {3})] == [3]
    broken = bytearray(data)
    broken[len(data) - 10] ^= 1  # the last frame's checksum
    with pytest.raises(ValueError):
        list(archive.read_file(bytes(broken)))
    assert [x[2] for x in archive.read_file(bytes(broken), {1})] == [1]
