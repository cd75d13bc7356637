"""Web archives of pages, and an index of all captures in global order.

Archives are WARC files with one gzip member per record, so a record can be read alone by its offset. A task writes
its captures sorted by URL key and time: each file is a locally sorted run. The index merges the runs: captures are
dealt out by ranges of (URL key, time, ...), and each range merges its slices of the runs with a loser tree.

Files are written by Spark's text writer: one row is one file, and the line separator is an empty gzip member, which
readers pass over. They so reach any store that Spark reaches, and a task that is lost leaves none behind.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import block_offsets
from ..session import materialize

#: Packed bytes of a file; one record may go beyond.
FILE_BYTES = 8 << 20
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
#: Time of a capture that has none of its own: the page_id in seconds after 2024-01-01.
EPOCH = 1_704_067_200
END = b"\r\n\r\n"


def digest(payload: Column) -> Column:
    """Base32 of the SHA-1: four groups of ten hexadecimal digits are eight digits of base 32 each."""
    sha = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host labels from the right, joined by commas, then ')' and the rest without scheme, port, user and fragment,
    in lower case; a null URL has the key ''."""
    u = F.lower(F.coalesce(url, F.lit("")))
    shape = r"(?s)^(?:[a-z][a-z0-9+.-]*:)?(?://(?:[^/?#]*@)?(?:www[0-9]*\.)?([^/?#:@]*)(?::[0-9]*)?)?([^#]*)"
    host = F.array_join(F.reverse(F.split(F.regexp_extract(u, shape, 1), r"\.")), ",")
    rest = F.regexp_extract(u, shape, 2)
    return F.when(u == "", u).otherwise(F.concat(host, F.lit(")"), F.when(rest == "", "/").otherwise(rest)))


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with url_key, captured (epoch seconds), payload (bytes), digest and refers_to.

    Of rows with equal payloads of ``min_bytes`` or more, those with the least page_id are responses and the others
    refer to it; a missing page_id counts as larger than any, and rows that repeat the least id are responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", url_key(F.col("url")).alias("url_key"),
        (F.lit(EPOCH) + F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(10**9))).alias("captured"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", digest(F.col("payload")))
    small = rows.select("page_id", "digest", F.length("payload").alias("bytes"))
    first = small.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = small.join(first, "digest").where("refers_to is not null and (page_id is null or page_id > refers_to)")
    later = later.select("page_id", "digest", "refers_to").distinct().alias("l")
    same = F.col("r.page_id").eqNullSafe(F.col("l.page_id")) & (F.col("r.digest") == F.col("l.digest"))
    return rows.alias("r").join(later, same, "left").select("r.*", "l.refers_to")


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join(lines).encode() + END


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id, url, captured: int, payload: bytes, sha: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit whose HTTP head alone is kept."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    kind = "response" if refers_to is None else "revisit"
    safe = None if url is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    head = _header([
        ("WARC-Type", kind), ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", datetime.fromtimestamp(captured, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Target-URI", safe), ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("WARC-Refers-To", None if refers_to is None else _name(refers_to)),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ])
    return head + block + END


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    members, size = [], 0
    row = lambda: pa.RecordBatch.from_pydict({"data": pa.array([b"".join(members)], pa.binary())})
    for batch in batches:
        for fields in zip(*batch.columns):
            member = gzip.compress(record(*(x.as_py() for x in fields)), 6, mtime=0)
            members.append(member)
            size += len(member)
            if size >= FILE_BYTES:
                yield row()
                members, size = [], 0
    if members:
        yield row()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One WARC record per row of ``pages`` (page_id, url, html) in files under ``path``. A null html is an empty
    payload, a record without a URL has no target field, and blanks or controls in a URL are written as %XX."""
    runs = captures(pages, min_bytes).sortWithinPartitions("url_key", "captured", "page_id")
    files = runs.select("page_id", "url", "captured", "payload", "digest", "refers_to").mapInArrow(_files, "data binary")
    (
        files.select(F.col("data").cast("string").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)
    )


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, packed length, plain bytes) of the gzip members that are not empty."""
    at = 0
    while at < len(data):
        unzip = zlib.decompressobj(31)
        plain, window = [], 1 << 16
        pos = at
        while not unzip.eof:
            if pos >= len(data):
                raise ValueError("the last member is cut off")
            plain.append(unzip.decompress(data[pos : pos + window]))
            pos += window
        end = min(pos, len(data)) - len(unzip.unused_data)
        whole = b"".join(plain)
        if whole:
            yield at, end - at, whole
        at = end


def parse(plain: bytes) -> dict:
    """Fields of a record, its payload (None for a revisit) and the payload's full length. Raises ValueError where
    a length or the digest of a payload is wrong."""
    cut = plain.index(END)
    fields = dict(line.split(": ", 1) for line in plain[:cut].decode().split("\r\n")[1:])
    block = plain[cut + 4 : -4]
    if len(block) != int(fields["Content-Length"]) or not plain.endswith(END):
        raise ValueError("wrong length of a record")
    head, _, payload = block.partition(END)
    size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != sha):
        raise ValueError("wrong digest of a payload")
    number = lambda x: None if x is None or x == _name(None) else int(x.removeprefix("<urn:page:")[:-1])
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "captured": int(datetime.strptime(fields["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc).timestamp()),
        "payload_digest": sha, "payload_bytes": size, "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


RECORD = (
    "file string, offset long, length long, page_id long, url string, record_type string, captured long, "
    "payload_digest string, payload_bytes long, refers_to long"
)


def _types(with_payload: bool) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [pa.field(*((a := c.split())[0], kinds[a[1]])) for c in RECORD.split(", ")]
    return pa.schema(fields + [pa.field("payload", pa.binary())] * with_payload)


def _records(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    schema = _types(with_payload)
    for batch in batches:
        for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, held = [], 0
            for offset, length, plain in members(data.as_py()):
                rows.append({"file": file, "offset": offset, "length": length, **parse(plain)})
                held += len(plain)
                if held >= FILE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record of the archives under ``path``: file, offset and packed length in it, page_id, url, record_type,
    captured, payload_digest, payload_bytes (of the full payload, also for a revisit), refers_to, and the payload
    if asked for. Lengths and digests are checked."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(partial(_records, with_payload=with_payload), RECORD + (", payload binary" if with_payload else ""))


class LoserTree:
    """Merges sorted runs: an inner node holds the run that lost there, and after the winner is taken only the
    nodes between its leaf and the root are played again."""

    def __init__(self, runs: list[Iterator]):
        self.runs, n = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, n)  # tree[0] is the winner
        for i in range(n):
            self.play(i)

    def before(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; a run at its end comes last, ties go to the lower run."""
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def play(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node:
            held = self.tree[node]
            if held < 0:  # the first to arrive waits for its opponent
                self.tree[node] = run
                return
            if self.before(held, run):
                self.tree[node], run = run, held
            node //= 2
        self.tree[0] = run

    def __iter__(self):
        while self.runs and (head := self.heads[self.tree[0]]) is not None:
            run = self.tree[0]
            yield head
            self.heads[run] = next(self.runs[run], None)
            self.play(run)


INDEX = "block long, place long, url_key string, captured long, page_id long, file string, offset long, length long, record_type string, payload_digest string, payload_bytes long, refers_to long"
COLUMNS = [c.split()[0] for c in INDEX.split(", ")][2:]


def _sort_key(x: tuple) -> tuple:
    """Order of captures: URL key, time, page_id (none last), file, offset."""
    return x[0], x[1], x[2] is None, x[2] or 0, x[3], x[4]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, runs = TaskContext.get().partitionId(), {}
    for batch in batches:  # rows come run after run, each run in order
        for file, part in _by_file(batch):
            runs.setdefault(file, []).append(part)

    def rows(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for i in range(0, part.num_rows, 256):
                for x in zip(*(c.to_pylist() for c in part.slice(i, 256).columns)):
                    yield _sort_key(x), x

    merged, place = [], 0
    for _, x in LoserTree([rows(parts) for parts in runs.values()]):
        merged.append((block, place, *x))
        place += 1
        if len(merged) == 8192:
            yield _index_batch(merged)
            merged = []
    if merged:
        yield _index_batch(merged)


def _by_file(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    files, at = batch.column(COLUMNS.index("file")).to_pylist(), 0
    while at < len(files):
        end = at + 1
        while end < len(files) and files[end] == files[at]:
            end += 1
        yield files[at], batch.slice(at, end - at)
        at = end


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in INDEX.split(", ")])


def capture_index(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """All captures of ``read_archives`` in one order by URL key, time, page_id, file and offset, with their
    ``position`` in it from 0. Captures of one URL, however many, may span several ranges."""
    n = partitions or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["url_key", "captured", F.col("page_id").asc_nulls_last(), "file", "offset"]
    entries = records.withColumn("url_key", url_key(F.col("url"))).select(*COLUMNS)
    runs = entries.repartitionByRange(n, *order).sortWithinPartitions("file", *order[:3], "offset")
    merged = materialize(runs.mapInArrow(_merge, INDEX), "captures")
    offsets = block_offsets(merged.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "block", "n")
    return merged.join(offsets, "block").select(*COLUMNS, (F.col("before_n") + F.col("place")).alias("position"))
