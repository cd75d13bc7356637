import base64
import gzip
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripwright.llm import warc
from tripwright.session import stage_path

PAGES = "page_id long, url string, html string, file string, position string"
ROWS = [
    (5, "http://www.Example.com:80/a?b=1#x", "<p>one</p>", "f", None), (3, "https://example.com/a?b=1", "<p>one</p>", "f", None),
    (9, "http://b.example.com", "", "f", None), (4, None, None, "f", None), (7, "http://x/\r\nWARC-Type: forged", "é" * 70000, "f", None),
    (8, "", "WARC/1.1\r\n\r\n", "f", None), (None, "http://x/null", "only", "f", None), (None, "http://x/null", "<p>one</p>", "f", None),
    (8, "", "WARC/1.1\r\n\r\n", "f", None),
]


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archived(spark, rows, **how):
    path = stage_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), path, **how)
    return path, warc.read_archives(spark, path, with_payload=True).collect()


def test_round_trip_and_revisits(spark):
    _, got = archived(spark, ROWS)
    seen = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    want = [(False, i, len((h or "").encode()), sha(h), t, ref) for i, h, t, ref in (
        (3, "<p>one</p>", "response", None), (4, None, "response", None), (5, "<p>one</p>", "revisit", 3), (7, "é" * 70000, "response", None),
        (8, "WARC/1.1\r\n\r\n", "response", None), (8, "WARC/1.1\r\n\r\n", "response", None), (9, "", "revisit", 4))]
    want += [(True, 0, 4, sha("only"), "response", None), (True, 0, 10, sha("<p>one</p>"), "revisit", 3)]
    assert sorted(seen, key=repr) == sorted(want, key=repr)
    assert {r.payload for r in got if r.page_id == 7} == {("é" * 70000).encode()}
    assert [r.url for r in got if r.page_id == 7] == ["http://x/%0D%0AWARC-Type:%20forged"]


def test_small_payloads_are_all_kept(spark):
    _, got = archived(spark, ROWS, min_bytes=1)
    assert {r.record_type for r in got if r.payload_bytes == 0} == {"response"}


def test_a_record_can_be_read_by_its_offset(spark):
    path, got = archived(spark, ROWS)
    files = {r.path: bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()}
    for r in got:
        plain = gzip.decompress(files[r.file][r.offset : r.offset + r.length])
        assert warc.parse(plain)["page_id"] == r.page_id
    # and a file as a whole is one gzip stream
    assert sum(gzip.decompress(x).count(b"WARC-Record-ID") for x in files.values()) == len(got)


def test_index_is_in_global_order(spark):
    rows = [(i, f"http://h{i % 7}.example.com/p{i % 3}", f"x{i % 11}", "f", None) for i in range(300)]
    path, _ = archived(spark, rows)
    index = warc.capture_index(warc.read_archives(spark, path), partitions=5).orderBy("position").collect()
    assert [r.position for r in index] == list(range(300))
    keys = [(r.url_key, r.captured, r.page_id) for r in index]
    assert keys == sorted(keys) and len({r.page_id for r in index}) == 300


def test_empty_table(spark):
    path, got = archived(spark, [])
    assert got == [] and warc.capture_index(warc.read_archives(spark, path)).count() == 0


def test_url_keys(spark):
    urls = {
        "http://www.Example.com:80/A?b#c": "com,example)/a?b", "https://u:p@m.x.org": "org,x,m)/", "ftp://x/y": "x)/y", None: "",
        "/only/path": ")/only/path", "http://x/\n?": "x)/\n?",
    }
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.url_key(F.col("u")).alias("k")).collect()
    assert {r.u: r.k for r in got} == urls


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree(runs):
    merged = list(warc.LoserTree([iter([((x,), (i, x)) for x in sorted(r)]) for i, r in enumerate(runs)]))
    assert [x[0][0] for x in merged] == sorted(x for r in runs for x in r)
    assert merged == sorted(merged, key=lambda x: (x[0], x[1][0]))
