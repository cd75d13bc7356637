"""Periodic runs in the words of documents, and texts without their repetition.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring word
extends; those of ``TIMES`` periods and ``WORDS`` words at least are found, by Kruskal's method over the suffixes of a
text in descending order of what they share:

1. Suffixes are sorted by prefix doubling, and what neighbours in that order share (their LCP) is read off the
   classes of the doubling.
2. Neighbouring classes are united in descending order of LCP, by union-find with an ordered set of positions each.
   A pair of positions i < j that a union at level l makes adjacent shares l words exactly. If it lies within that
   level, the words from i to j + l have period j - i, and no position between the two shares as much, so the period
   is the smallest one. The run begins at i if the word before breaks the period.

Unions below ``LEAST`` shared words cannot seed a run and are left out. A text is one unit of work; a task takes texts
together up to ``CHUNK`` words, so that sorting and doubling are array operations over many texts at once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMES, WORDS = 4, 6
LEAST = 5  # a run of period 1 and six words shares five with its shift; all others share more
CHUNK = 200_000


class _Numbers(dict):
    """Number of a word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def sorted_suffixes(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of texts that stand one behind the other, and the classes of every doubling.

    ``ids`` are word numbers, ``ends`` the end of each position's text. A class is a number that suffixes of one text
    share if their first 1, 2, 4, ... words are equal; the doubling goes on with classes of several suffixes only.
    """
    n = len(ids)
    key = ends.astype(np.int64) * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    rank, slots, span, levels = np.empty(n, np.int32), np.arange(n), 1, []
    first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    while True:
        start = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        rank[order[slots]] = start
        levels.append(rank.copy())
        alone = first & np.concatenate([first[1:], [True]])
        slots = slots[~alone]
        if not len(slots):
            return order, levels
        at = order[slots]
        behind = at + span
        inside = behind < ends[at]
        second = np.where(inside, rank[np.where(inside, behind, 0)] + 1, 0)
        pair = rank[at].astype(np.int64) * (n + 1) + second
        by = np.argsort(pair, kind="stable")
        order[slots] = at[by]
        pair = pair[by]
        first = np.concatenate([[True], pair[1:] != pair[:-1]])
        span *= 2


def shared_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, LCP) of the neighbours place and place + 1 of the order that share ``LEAST`` words at least."""
    if len(levels) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    four = levels[2][order]
    places = np.flatnonzero(four[1:] == four[:-1])
    i, j = order[places], order[places + 1]
    shared = np.zeros(len(places), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = i + shared, j + shared
        inside = (x < ends[i]) & (y < ends[j])
        same = inside & (levels[k][np.where(inside, x, 0)] == levels[k][np.where(inside, y, 0)])
        shared += same.astype(np.int64) << k
    keep = shared >= LEAST
    return places[keep], shared[keep]


def _unite(sets: list[list[int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """Union of ordered position sets, and the pairs from different sets that it makes adjacent."""
    sets.sort(key=len)
    big, rest = sets[-1], sets[:-1]
    new = sorted((x, k) for k, s in enumerate(rest) for x in s)
    pairs = []
    if len(new) * 16 > len(big):
        all_of = sorted([*new, *((x, -1) for x in big)])
        pairs = [(p[0], q[0]) for p, q in zip(all_of, all_of[1:]) if p[1] != q[1]]
        return [x for x, _ in all_of], pairs
    last, owner = None, -1
    for at, (x, k) in enumerate(new):
        place = bisect_left(big, x)
        if place and (big[place - 1] != last or owner != k):
            pairs.append((big[place - 1], x))
        follows = new[at + 1][0] if at + 1 < len(new) else None
        if place < len(big) and (follows is None or big[place] < follows):
            pairs.append((x, big[place]))
        big.insert(place, x)
        last, owner = x, k
    return big, pairs


def seeds_of_runs(order: np.ndarray, places: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, LCP) of positions that become adjacent, within a quarter of the stretch that they span, in descending order of LCP."""
    by = np.lexsort((places, -shared))
    places, shared = places[by].tolist(), shared[by].tolist()
    parent: dict[int, int] = {}
    sets: dict[int, list[int]] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def members(x: int) -> list[int]:
        got = sets.pop(x, None)
        return got if got is not None else [int(order[x])]

    at = 0
    while at < len(places):
        level, begin = shared[at], at
        # neighbours of one level that stand side by side are united at once
        while at + 1 < len(places) and shared[at + 1] == level and find(places[at] + 1) == find(places[at + 1]):
            at += 1
        roots = [find(places[begin]), *(find(places[k] + 1) for k in range(begin, at + 1))]
        united, pairs = _unite([members(r) for r in roots])
        for r in roots[1:]:
            parent[r] = roots[0]
        sets[roots[0]] = united
        for i, j in pairs:
            if level >= (TIMES - 1) * (j - i) and level + j - i >= WORDS:
                yield i, j, level
        at += 1


def runs_of(ids: np.ndarray, sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs, in order, of each of the texts of ``sizes`` words that ``ids`` holds."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(ids):
        return found
    borders = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    ends = borders[text]
    order, levels = sorted_suffixes(ids, ends)
    places, shared = shared_prefixes(order, levels, ends)
    for i, j, level in seeds_of_runs(order, places, shared):
        begin = int(borders[text[i]]) - sizes[text[i]]
        if i == begin or ids[i - 1] != ids[j - 1]:
            found[text[i]].append((i - begin, j - i + level, j - i))
    return [sorted(x) for x in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])

    def flush(doc_ids, texts):
        numbers = _Numbers()
        ids = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in texts]
        found = runs_of(np.concatenate(ids), list(map(len, texts)))
        named = [[{"start": s, "length": n, "period": p} for s, n, p in x] for x in found]
        out = [doc_ids, list(map(len, texts)), named, list(map(_collapsed, texts, found))]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    for batch in batches:
        doc_ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            words = (text.as_py() or b"").split()
            if texts and size + len(words) > CHUNK:
                yield flush(doc_ids, texts)
                doc_ids, texts, size = [], [], 0
            doc_ids.append(doc_id.as_py())
            texts.append(words)
            size += len(words)
        if texts:
            yield flush(doc_ids, texts)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start, then period) and collapsed (the words, joined by
    one space, that no run holds after its first period) per row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII blanks. A null or empty text has no words, no runs and an empty ``collapsed``.
    A row's result depends on its own text only, so repeated rows give equal rows and a missing doc_id stays missing; a
    text of any length is taken whole. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_find, FOUND).withColumn("collapsed", F.col("collapsed").cast("string"))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by the CRC of its id) repeats a part of its words to its end.

    With h the CRC-32 of the decimal doc_id, g = h div 10 and n words, a tenth part (h mod 10 = 0) has word i >= a replaced by
    word a + (i - a) mod p, for a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Their words are joined by one space. A
    text without words, or of a missing doc_id, is left as it is.
    """
    blank = r"[\x20\x09-\x0D]+"
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", blank), lambda x: x != "")
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    g = F.floor(F.col("h") / 10)
    n = F.size("w")
    sized = chosen.select("doc_id", "text", "w", n.alias("n"), g.alias("g"), F.when(n > 0, g % n).cast("int").alias("a"))
    p = (F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)) + 1).cast("int")
    sized = sized.withColumn("p", p)
    period = F.slice("w", F.col("a") + 1, F.least("p", F.col("n") - F.col("a")))
    tail = F.flatten(F.array_repeat(period, F.floor((F.col("n") - F.col("a")) / F.col("p")).cast("int") + 1))
    repeated = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a"))), " ")
    return sized.select("doc_id", F.when(F.coalesce(F.col("n"), F.lit(0)) > 0, repeated).otherwise(F.col("text")).alias("text"))
