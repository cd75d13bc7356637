"""Near-duplicate documents: similarity sketches, banding, exact verification, components.

Sketch. A document is the set of its distinct shingles. The sketch has one coordinate per bin: in round i every
shingle is hashed, with the round's own function, to a bin and a value, and a bin keeps the least (round, value)
that it sees; from round ``bins`` on, round i drops every shingle into bin i - bins, so all bins fill. A document
of n shingles needs about bins * ln(bins) / n rounds, far fewer hashes than one per coordinate and shingle, and
two sets agree in a coordinate with the probability of their similarity, with the concentration of independent
draws.

Candidates. ``ROWS`` coordinates make a band; sets that share a band's key meet in its bucket. Of two sets with
similarity 0.75, all of ``BANDS`` bands differ with probability (1 - 0.75^ROWS)^BANDS, about one in a million.

Verification. Documents with equal sets are one class, shown by its least id. The classes of a bucket are linked on
their whole sets by ``components.linked_members``, which lists no pairs inside a component: a large group of near
copies costs one pair per member, and no pair is left out. Buckets that hold unlike classes, such as those of a passage
that thousands share, are made anew from the rarest shingles, where only similar sets can meet.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .columns import fresh, named
from .components import linked_members, shared_buckets
from .text import as_long, mix, seeds, windows, word_hashes, worker_cache

WORDS = 5  # of a shingle
ROWS, BANDS = 6, 70
BINS = ROWS * BANDS
SIMILARITY = 75  # percent


def shingles(text: bytes | None) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. Words are runs of anything but ASCII blanks, A-Z in lower case."""
    return np.unique(windows(word_hashes((text or b"").lower().split()), WORDS))


def sketch(items: np.ndarray, bins: int = BINS) -> np.ndarray:
    """(round, value) of each bin as round << 32 | value; ``items`` are distinct and not empty."""
    keys = worker_cache(f"seeds_{bins}", lambda: seeds(2 * bins, 7))
    low, shift = np.uint64(0xFFFFFFFF), np.uint64(32)
    best = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    step, done = max(1, -(-6 * bins // len(items))), 0
    while done < bins and best.max() == np.iinfo(np.uint64).max:
        rounds = np.arange(done, min(done + step, bins), dtype=np.uint64)
        x = mix(items[None, :] ^ keys[rounds][:, None])
        at = ((x >> shift) * np.uint64(bins)) >> shift
        np.minimum.at(best, at.ravel().astype(np.intp), ((rounds << shift)[:, None] | (x & low)).ravel())
        done += len(rounds)
    for i in np.flatnonzero(best == np.iinfo(np.uint64).max):
        best[i] = np.uint64((bins + int(i)) << 32) | (mix(items ^ keys[bins + i]) & low).min()
    return best


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    grid = coordinates.reshape(-1, rows)
    out = np.arange(len(grid), dtype=np.uint64)
    for i in range(rows):
        out = mix((out ^ grid[:, i]) * np.uint64(0x9E3779B97F4A7C15))
    return as_long(out)


SKETCHES = "doc_id long, n_shingles long, set_key binary, bands array<long>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
            sizes, keys, bands = [], [], []
            for text in part.column(1):
                items = shingles(text.as_py())
                sizes.append(len(items))
                keys.append(xxhash.xxh3_128_digest(items.tobytes()))
                bands.append(band_keys(sketch(items)) if len(items) else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, bands)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands)))
            arrays = [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set_key", "bands"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> (a, b) of the pairs that are similar on their whole sets."""
    held: OrderedDict[bytes, np.ndarray] = OrderedDict()

    def items(text: bytes) -> np.ndarray:
        got = held.get(text)
        if got is None:
            got = held[text] = shingles(text)
            if len(held) > 16:
                held.popitem(last=False)
        return got

    for batch in batches:
        found = []
        for a, b, x, y in zip(*(batch.column(i) for i in range(4))):
            x, y = items(x.as_py()), shingles(y.as_py())
            if 100 * min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both and 100 * both >= SIMILARITY * (len(x) + len(y) - both):
                found.append((a.as_py(), b.as_py()))
        yield pa.RecordBatch.from_pydict({
            "a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())
        })


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents are similar; ``texts`` has (id, text)."""
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verify, "a long, b long")


def _similar_size(n: str, m: str):
    """Sets whose sizes alone rule out the similarity are no candidates."""
    return (100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            items = [as_long(shingles(x.as_py())) for x in part.column(1)]
            ends = pa.array(np.cumsum([0, *map(len, items)], dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(items)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(len, items)), pa.int32()), lists], ["id", "n", "items"])


def _rare_shingles(ids: DataFrame, texts: DataFrame) -> tuple:
    """Buckets (key, id, n) by the rarest shingles of the documents ``ids``, and how their pairs are confirmed.

    Of two similar sets of n and m shingles, ordered from rare to frequent, the first n - 0.75 n + 1 of the one and
    the first m - 0.75 m + 1 of the other have one in common; and behind the first that they share, at places i and j,
    there is room for the rest of the intersection that they need. Documents that share no more than a passage that
    thousands hold do not meet so, as its shingles come last. Exact: no link is lost.
    """
    sets = materialize(texts.join(ids, "id").mapInArrow(_items, "id long, n int, items array<long>"), "sets")
    each = sets.select("id", "n", F.explode("items").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    lists = each.join(shared, "key").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("f", "key"))).alias("s"))
    # shingles of one document alone stand before all others
    alone = F.col("n") - F.size("s")
    first = F.col("n") - F.ceil(F.lit(SIMILARITY) * F.col("n") / 100) + 1 - alone
    members = lists.where(first > 0).select("id", "n", alone.alias("alone"), F.posexplode(F.slice("s", 1, first.cast("int"))).alias("i", "x"))
    members = members.select(F.col("x.key").alias("key"), "id", F.struct("n", (F.col("alone") + F.col("i")).alias("i")).alias("n"))

    def may_link(x: str, y: str):
        room = F.least(F.col(f"{x}.n") - F.col(f"{x}.i"), F.col(f"{y}.n") - F.col(f"{y}.i"))
        return (100 + SIMILARITY) * room >= SIMILARITY * (F.col(f"{x}.n") + F.col(f"{y}.n"))

    def confirm(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
        two = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
        both = pairs.join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
        return both.where(100 * F.col("both") >= SIMILARITY * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")

    return members, confirm, may_link


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) per document of ``docs`` (doc_id, text).

    Documents with 100 * intersection >= 75 * union of their shingle sets are linked; ``component_id`` is the least
    doc_id that links reach. A null text or one without words has the empty set and no link; with fewer than five
    words the whole sequence is the one shingle. Rows that repeat a doc_id give one row, with the largest n_shingles
    and the least component of their texts. Rows without a doc_id cannot be named and are left out.
    Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).where("doc_id is not null")
    sketches = materialize(rows.mapInArrow(_sketches, SKETCHES), "sketches")
    filled = sketches.where("n_shingles > 0")
    classes = filled.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes, "classes")
    # every class by its least document
    reps = filled.select("doc_id", "n_shingles", "bands", "set_key").join(
        classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"]).dropDuplicates(["doc_id", "set_key"])
    rows_of = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").cast("int").alias("n"))
    members = shared_buckets(rows_of)
    wanted = members.select("id").distinct()
    texts = materialize(rows.join(wanted, rows.doc_id == wanted.id).select("id", "text"), "texts")
    labels = linked_members(members, lambda pairs: _confirmed(pairs, texts), _similar_size, lambda ids: _rare_shingles(ids, texts))
    copies = sketches.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    found = copies.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("id")).join(labels, "id", "left")
    found = found.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min(F.coalesce("component", "id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the least id. Of rows that repeat a
    doc_id the one with the least text stays; rows without a doc_id all stay, and so do documents without words."""
    kept = near_duplicates(docs).where("kept").select("doc_id")
    found = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
    (row,) = fresh(docs, "row")
    found = found.withColumn(row, first).where(F.col(row) == 1).select(*named(docs.columns))
    return found.unionAll(docs.where("doc_id is null").select(*named(docs.columns)))
