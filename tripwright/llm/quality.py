"""Document rules, and lines that too many documents of a host share.

Rules on the text alone (words are runs of anything but ASCII blanks): at least ``MIN_WORDS`` words, and at most
half of the words inside repeated windows of three. Then, per host, each normalised line (blanks squeezed, lower
case) is hashed and the distinct documents that hold it are counted. A line in more than ``MAX_DOCS`` documents of a
host is removed, and a document that keeps less than ``MIN_LEFT`` of its words is rejected as depleted.

``spare_copies`` (off by default) leaves copies to a later stage that keeps one of them: exact copies then count as one
document, and the first holder of a line (by doc_id) keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .columns import by_text, named
from .text import windows, word_hashes

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows
MAX_DOCS = 20
MIN_LEFT = 50  # percent of words outside removed lines
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def repeated_words(hashes: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` that are found twice or more."""
    if len(hashes) < width:
        return 0
    _, inverse, counts = np.unique(windows(hashes, width), return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def line_key(line: bytes, parts: list[bytes] | None = None) -> int | None:
    """Signed hash of a normalised line; None for a line without a word."""
    parts = line.split() if parts is None else parts
    key = xxhash.xxh3_64_intdigest(b" ".join(parts).lower()) if parts else None
    return key - (1 << 64) if parts and key >> 63 else key


def measure(text: bytes) -> tuple:
    """(words, word_chars, symbols, repeated lines, words in repeated windows, line hashes, words of those lines)."""
    words, string = text.split(), text.decode("utf-8", "replace")
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    n_dup = 0
    for line in text.split(b"\n"):
        parts = line.split()
        if parts:
            n_dup += line in seen
            seen.add(line)
            key = line_key(line, parts)
            lines[key] = lines.get(key, 0) + len(parts)
    chars = len(string) - sum(string.count(c) for c in BLANKS)
    symbols = sum(string.count(c) for c in SYMBOLS)
    return len(words), chars, symbols, n_dup, repeated_words(word_hashes(words)), list(lines), list(lines.values())


MEASURES = (
    "doc_id long, host long, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<long>, line_words array<int>"
)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            texts = [x.as_py() or b"" for x in part.column("text")]
            cols = list(zip(*map(measure, texts)))
            arrays = [part.column(c) for c in ("doc_id", "host", "text_key")]
            arrays += [pa.array(c, pa.int64()) for c in cols[:5]]
            arrays.append(pa.array(cols[5], pa.list_(pa.int64())))
            arrays.append(pa.array(cols[6], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in MEASURES.split(", ")])


def _host(source: str = "source"):
    return F.xxhash64(F.col(source).cast("string"))


def _measured(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _host().alias("host"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(_measure, MEASURES), "quality")


def _lines(m: DataFrame) -> DataFrame:
    """Lines of each text of a host, with their words, the documents that have the text and the least of them. Copies
    are combined before the lines are shuffled."""
    order = F.coalesce("doc_id", F.lit(2**63 - 1))
    each = m.where(F.size("lines") > 0).groupBy("host", "text_key", "doc_id").agg(F.first("lines").alias("lines"), F.first("line_words").alias("words"))
    texts = each.groupBy("host", "text_key").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(order).alias("first"), F.first("lines").alias("lines"), F.first("words").alias("words"))
    lines = texts.select("host", "text_key", "n_docs", "first", F.explode(F.arrays_zip("lines", "words")).alias("l"))
    return lines.select("host", "text_key", "n_docs", "first", F.col("l.lines").alias("line"), F.col("l.words").alias("words"))


def _lost(m: DataFrame, max_docs: int, spare_copies: bool) -> DataFrame:
    """(host, text_key, n_lost, removed) of the texts that lose lines."""
    lines = _lines(m)
    holders = F.count(F.lit(1)) if spare_copies else F.sum("n_docs")
    counted = lines.groupBy("host", "line").agg(holders.alias("holders"), F.min(F.struct("first", "text_key")).alias("h"))
    common = counted.where(F.col("holders") > max_docs).select("host", "line", F.col("h.text_key").alias("holder"))
    hit = lines.join(common, ["host", "line"])
    if spare_copies:
        hit = hit.where(F.col("text_key") != F.col("holder"))
    return hit.groupBy("host", "text_key").agg(F.sum("words").alias("n_lost"), F.collect_set("line").alias("removed"))


def quality(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: int = MIN_LEFT, spare_copies: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_removed_words (words of lines above the limit), depleted, kept, ``removed``
    (hashes of the lines that the document loses, null for none), ``host`` and ``text_key`` (hashes).

    A null text has no words and fails; documents without a source form one host; rows without a doc_id count as one
    document for each text. Repeated rows are one document and are judged alike. An empty table gives an empty result;
    other columns are not read.
    """
    m = _measured(docs)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        m.drop("lines", "line_words").join(_lost(m, max_docs, spare_copies), ["host", "text_key"], "left")
        .withColumn("n_removed_words", F.coalesce("n_lost", F.lit(0)).cast("long"))
        .withColumn("base_failed", base)
        .withColumn("depleted", 100 * (F.col("n_words") - F.col("n_removed_words")) < min_left * F.col("n_words"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "n_removed_words", "depleted", (~F.col("base_failed") & ~F.col("depleted")).alias("kept"), "removed", "host", "text_key")
    )


def _without_lines(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, removed in zip(batch.column("text").to_pylist(), batch.column(column).to_pylist()):
            if text is not None and removed:
                gone = set(removed)
                text = "\n".join(x for x in text.split("\n") if line_key(x.encode()) not in gone)
            texts.append(text)
        arrays = [pa.array(texts, f.type) if f.name == "text" else batch.column(f.name) for f in batch.schema if f.name != column]
        yield pa.RecordBatch.from_arrays(arrays, [f.name for f in batch.schema if f.name != column])


def clean_documents(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: int = MIN_LEFT, spare_copies: bool = False) -> DataFrame:
    """``docs`` without the rows that ``quality`` rejects; the others lose their lines above the limit. All columns
    stay, whatever their names; rows are met by doc_id, text and host, as ``quality`` judges them."""
    verdicts = quality(docs, max_docs, min_left, spare_copies).where("kept").groupBy("doc_id", "text_key", "host").agg(F.first("removed").alias("removed"))
    kept, (removed,) = by_text(docs, verdicts, "removed", how="inner", extra={"host": _host()})
    return kept.select(*named(docs.columns), removed).mapInArrow(lambda it: _without_lines(it, removed), docs.schema)
