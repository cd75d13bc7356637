"""Benchmark passages in documents, with DataFrame functions only.

Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case. A window is ``WIDTH``
consecutive words of an item; an item of fewer words, but not none, is one window. The windows' hashes are the set
that all documents' windows are probed against; hits are verified on the words themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .columns import by_text, named, once

WIDTH = 10
#: Between words in lower case, and a word in any case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows (a hash, a width and a number each) that may be broadcast: some 50 MB. More are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), GAP), "")


def _window_hashes(w: Column, width: int) -> Column:
    n = F.size(w) - width
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.xxhash64(F.lit(width), F.slice(w, i + 1, width)))
    return F.when(n >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, width, hash, words) of the distinct windows of each item. Items without an id or a word have none."""
    w = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).where("item_id is not null and size(w) > 0")
    size = F.least(F.size("w"), F.lit(width))
    parts = w.select("item_id", size.alias("width"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - size)).alias("i"))
    window = F.slice("w", F.col("i") + 1, F.col("width"))
    return parts.select("item_id", "width", F.xxhash64("width", window).alias("hash"), window.alias("words")).distinct()


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, the hash of the text (rows that repeat an id are told apart by it) and the text."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit (words inside an occurrence of a window of
    ``benchmark`` (item_id, text)), items (sorted as strings; those with an occurring window), text_key (hash of the text) and
    ``spans`` (start and end of the hit runs, counted in words from 0; null for none).

    A null or empty text has no words. Rows that repeat a doc_id are judged each on its own text; a missing doc_id
    is kept. Items without an id are no items; an empty benchmark hits nothing, empty documents give no rows. Other
    columns are not read.
    """
    windows = materialize(item_windows(benchmark, width), "windows")
    widths = [r[0] for r in windows.select("width").distinct().orderBy("width").collect()]  # at most ``width`` numbers
    rows = _identified(docs)
    base = rows.select("doc_id", "text_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = base.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans"))
    if not widths:
        return none

    def before(size: Column, k: int) -> Column:
        """Windows of the widths before the k-th in the array of a document's hashes."""
        return reduce(lambda a, b: a + b, (F.greatest(size - x + 1, F.lit(0)) for x in widths[:k]), F.lit(0))

    # all windows of a document, one width after another, as one array of longs
    scan = once(words(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), F.concat(*(_window_hashes(w, x) for x in widths)).alias("h")))
    probes = rows.select("doc_id", "text_key", scan.alias("s")).select("doc_id", "text_key", F.col("s.n").alias("n"), F.posexplode("s.h").alias("p", "hash"))
    keys = windows.select("hash", "width").distinct()
    if keys.count() <= BROADCAST_WINDOWS:
        keys = F.broadcast(keys)
    start = reduce(lambda rest, k: F.when(F.col("width") == widths[k], F.col("p") - before(F.col("n"), k)).otherwise(rest), range(len(widths)), F.lit(-1))
    hits = materialize(probes.join(keys, "hash").select("doc_id", "text_key", start.alias("start"), "width", "hash"), "hits")

    # verification: the words at the places of the hits, for the documents that have any
    places = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "width", "hash")).alias("places")).alias("p")
    found = rows.alias("d").join(places, F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_key") == F.col("p.text_key")))
    seen = once(words(F.col("text")), lambda w: F.transform("places", lambda x: F.struct(
        x["start"].alias("start"), x["width"].alias("width"), x["hash"].alias("hash"), F.slice(w, x["start"] + 1, x["width"]).alias("words"))))
    found = found.select("d.doc_id", "d.text_key", F.explode(seen).alias("x"))
    found = found.select("doc_id", "text_key", "x.*").distinct()
    found = materialize(found.join(windows, ["hash", "width", "words"]).select("doc_id", "text_key", "start", (F.col("start") + F.col("width")).alias("end"), "item_id"), "verified")

    by = ["doc_id", "text_key"]
    items = found.select(*by, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*by).agg(F.array_sort(F.collect_list("item")).alias("items"))
    order = Window.partitionBy(*by).orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.groupBy(*by, "start").agg(F.max("end").alias("end")).withColumn("_reach", reach)
    runs = runs.withColumn("_run", F.sum(F.when(F.col("start") <= F.col("_reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy(*by).agg(F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))

    both = F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.text_key") == F.col("i.text_key"))
    marks = spans.alias("s").join(items.alias("i"), both).select("s.doc_id", "s.text_key", "n_hit", "spans", "items")
    same = F.col("b.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("b.text_key") == F.col("m.text_key"))
    return base.alias("b").join(marks.alias("m"), same, "left").select(
        "b.doc_id", "b.text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; all columns stay, whatever their names."""
    bad = contamination(docs, benchmark, width).where("n_hit > 0").select("doc_id", "text_key").distinct()
    return by_text(docs, bad, how="left_anti")[0].select(*named(docs.columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the words of benchmark passages, and the text between them, cut out of ``text``."""
    marks = contamination(docs, benchmark, width).where("n_hit > 0").groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))
    marked, (spans,) = by_text(docs, marks, "spans")
    cut = F.col(spans)
    both = F.struct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("w"), F.split("text", WORD).alias("g"))

    def left(v: Column) -> Column:
        """Gap 0, word 0, gap 1, ...: a word goes if a span holds it, a gap if a span holds the words on both sides."""
        def part(i: Column) -> Column:
            inside = F.exists(cut, lambda s: (s["start"] <= i) & (i < s["end"]))
            between = F.exists(cut, lambda s: (s["start"] < i) & (i < s["end"]))
            return F.concat(F.when(between, "").otherwise(F.get(v["g"], i)), F.when(inside, "").otherwise(F.coalesce(F.get(v["w"], i), F.lit(""))))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(v["w"])), part), "")

    text = F.when(cut.isNull(), F.col("text")).otherwise(once(both, left))
    return marked.withColumn("text", text).select(*named(docs.columns))
