"""Ranked lexical search: the highest-scoring documents for every item, by dual-tree search.

Documents and items are vectors over terms: a document holds an impact per term (its share of the score, from the
term's count and the document's length), an item holds the term's weight times its count. A score is their inner
product. Documents are dealt into blocks, items into blocks of their own, and each pair of blocks is searched by one
task:

* Both sides are put into hierarchies whose nodes hold the largest value of every coordinate below them, so the
  inner product of an item node and a document node bounds every score between the two.
* A pair of nodes whose bound is under the weakest k-th score among the node's items is left out with all that is
  below it. Other pairs are split on both sides, down to single items and leaves of documents, whose scores are
  worked out. All of it is integer arithmetic, so nothing is lost by rounding, and equal scores are never cut off.

A sixteenth of the blocks is searched first; the k-th scores found there are where the other blocks start from.

Counts over the corpus (documents, terms, documents per term) cover all documents. What documents send on is cut to the
items' terms by a bit table of fixed size, which is all that is broadcast; a term that passes it by chance is dropped when
it meets the items' terms. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import MEMO, worker_cache

K = 10
DOCUMENTS = 4096  # in a block
TERMS = 16384     # of the items in a block, about
FIRST = 16        # one block in so many is searched first
BITS = 1 << 21    # of the table of item terms
LEAF, FAN = 32, 8

# ASCII letters and digits and everything beyond ASCII are part of terms
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case."""
    return (text or b"").translate(_FOLD).split()


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[term] = xxhash.xxh3_64_intdigest(term)
        return value


def _vectors(table: np.ndarray | None):
    """Task: (id, text) to (id, n, terms, counts); with ``table``, of the terms whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_cache("term_hashes", _Hashes)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                sizes, flat, counts, ends = [], [], [], [0]
                for text in part.column(1):
                    words = terms(text.as_py())
                    tally = Counter(words)
                    keys = np.fromiter(map(hashes.__getitem__, tally), np.uint64, len(tally))
                    tf = np.fromiter(tally.values(), np.int64, len(tally))
                    if table is not None:
                        bit = keys & np.uint64(BITS - 1)
                        known = (table[(bit >> np.uint64(6)).astype(np.intp)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                        keys, tf = keys[known], tf[known]
                    sizes.append(len(words))
                    flat.append(keys.view(np.int64))
                    counts.append(tf)
                    ends.append(ends[-1] + len(keys))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x))) for x in (flat, counts)]
                columns = [part.column(0), pa.array(sizes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    return run


VECTORS = "id long, n long, terms array<long>, counts array<long>"


def _bit_table(item_terms: DataFrame) -> np.ndarray:
    """One bit per place that a term's hash falls on; the table's size does not depend on the number of terms."""
    bit = F.col("term").bitwiseAND(F.lit(BITS - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words = item_terms.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("word"))
    table = np.zeros(BITS // 64, np.int64)
    for row in words.collect():
        table[row["at"]] = row["word"]
    return table.view(np.uint64)


class _Rows:
    """Sparse rows: row i holds ``cols`` and ``vals`` from ends[i] to ends[i + 1], by column."""

    def __init__(self, ends: np.ndarray, cols: np.ndarray, vals: np.ndarray):
        self.ends, self.cols, self.vals = ends, cols, vals

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int) -> "_Rows":
        return cls(np.searchsorted(rows, np.arange(n + 1)), cols, vals)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.ends))

    def take(self, order: np.ndarray) -> "_Rows":
        sizes = np.diff(self.ends)[order]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.ends[order] - ends[:-1], sizes) + np.arange(ends[-1])
        return _Rows(ends, self.cols[at], self.vals[at])

    def maxima(self, group: int) -> "_Rows":
        """The largest value of every column over each ``group`` rows in turn."""
        rows = self.row_numbers() // group
        order = np.lexsort((self.cols, rows))
        rows, cols, vals = rows[order], self.cols[order], self.vals[order]
        start = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (cols[1:] != cols[:-1])])) if len(rows) else np.zeros(0, np.intp)
        top = np.maximum.reduceat(vals, start) if len(start) else vals
        return _Rows.of(rows[start], cols[start], top, -(-len(self) // group))

    def products(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with a dense vector."""
        sums = np.concatenate([[0], np.cumsum(dense[self.cols] * self.vals)])
        return sums[self.ends[1:]] - sums[self.ends[:-1]]


def _by_leading(rows: _Rows, weight: np.ndarray) -> np.ndarray:
    """Order that brings rows with the same heaviest columns together."""
    heavy = rows.vals * weight[rows.cols]
    number = rows.row_numbers()
    by = np.lexsort((rows.cols, -heavy, number))
    lead = rows.cols[by]
    first = rows.ends[:-1]
    second = np.minimum(first + 1, rows.ends[1:] - 1)
    return np.lexsort((lead[second], lead[first]))


def _levels(rows: _Rows, leaf: int) -> list[_Rows]:
    """Nodes of a hierarchy from the root down; ``leaf`` rows make a node of the last level."""
    levels = [rows.maxima(leaf)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].maxima(FAN))
    return levels[::-1]


def _children(nodes: np.ndarray, fan: int, n: int) -> np.ndarray:
    below = (nodes[:, None] * fan + np.arange(fan)[None, :]).ravel()
    return below[below < n]


class _Search:
    """Dual-tree search of a block of items over a block of documents."""

    def __init__(self, docs: _Rows, doc_ids: np.ndarray, items: _Rows, floors: np.ndarray, width: int, k: int):
        weight = np.zeros(width, np.int64)
        np.maximum.at(weight, items.cols, items.vals)
        order = _by_leading(docs, weight)
        self.docs, self.doc_ids = docs.take(order), doc_ids[order]
        self.item_order = _by_leading(items, np.ones(width, np.int64))
        self.items = items.take(self.item_order)
        self.doc_levels, self.item_levels = _levels(self.docs, LEAF), _levels(self.items, 1)
        self.floors = np.maximum(floors[self.item_order], 1)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(items))]
        self.dense, self.k = np.zeros(width, np.int64), k

    def run(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        self.visit(0, 0, 0, np.zeros(1, np.int64))
        for i, (scores, ids) in enumerate(self.best):
            yield int(self.item_order[i]), scores, ids

    def weakest(self, level: int, node: int) -> int:
        span = FAN ** (len(self.item_levels) - 1 - level)
        return int(self.floors[node * span : (node + 1) * span].min())

    def bounds(self, rows: _Rows, item_level: int, node: int) -> np.ndarray:
        items = self.item_levels[item_level]
        own = slice(items.ends[node], items.ends[node + 1])
        self.dense[items.cols[own]] = items.vals[own]
        out = rows.products(self.dense)
        self.dense[items.cols[own]] = 0
        return out

    def visit(self, item_level: int, node: int, doc_level: int, nodes: np.ndarray) -> None:
        docs = self.doc_levels[doc_level]
        bounds = self.bounds(docs.take(nodes), item_level, node)
        near = bounds >= self.weakest(item_level, node)
        nodes, bounds = nodes[near], bounds[near]
        if not len(nodes):
            return
        last_docs = doc_level == len(self.doc_levels) - 1
        if last_docs and item_level == len(self.item_levels) - 1:
            return self.leaves(node, nodes[np.argsort(-bounds, kind="stable")], np.sort(bounds)[::-1])
        below = nodes if last_docs else _children(nodes, FAN, len(self.doc_levels[doc_level + 1]))
        down = doc_level + (not last_docs)
        if item_level == len(self.item_levels) - 1:
            return self.visit(item_level, node, down, below)
        for child in _children(np.array([node]), FAN, len(self.item_levels[item_level + 1])):
            self.visit(item_level + 1, int(child), down, below)

    def leaves(self, item: int, nodes: np.ndarray, bounds: np.ndarray) -> None:
        """Scores of one item with the documents of leaves, the best bounds first."""
        at, step = 0, 4
        while at < len(nodes) and bounds[at] >= self.floors[item]:
            rows = _children(nodes[at : at + step], LEAF, len(self.docs))
            at, step = at + step, step * 4
            scores = self.bounds(self.docs.take(rows), len(self.item_levels) - 1, item)
            high = scores >= self.floors[item]
            scores, ids = (np.concatenate([x, y]) for x, y in zip(self.best[item], (scores[high], self.doc_ids[rows[high]])))
            best = np.lexsort((ids, -scores))[: self.k]
            self.best[item] = scores[best], ids[best]
            if len(best) == self.k:
                self.floors[item] = max(self.floors[item], int(scores[best[-1]]))


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and the joined values of an array column."""
    whole = lists.combine_chunks()
    return whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), whole.flatten().to_numpy(zero_copy_only=False)


FOUND = "item_id long, doc_id long, score long"


def _searched(n_docs: int, n_terms: int, k: int):
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(docs: pa.Table, items: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if docs.num_rows and items.num_rows:
            sizes, item_terms = _flat(items.column("terms"))
            _, dfs = _flat(items.column("dfs"))
            _, qfs = _flat(items.column("counts"))
            vocabulary, cols = np.unique(item_terms, return_inverse=True)
            weights = np.fromiter((math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs.tolist()), np.int64, len(dfs))
            number = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((cols, number))
            queries = _Rows(np.concatenate([[0], np.cumsum(sizes)]), cols[order], (weights * qfs)[order])

            counts, doc_terms = _flat(docs.column("terms"))
            _, tfs = _flat(docs.column("counts"))
            lengths = np.array([100 - 75 + 75 * n * n_docs // n_terms for n in docs.column("n").to_pylist()], np.int64)
            at = np.minimum(np.searchsorted(vocabulary, doc_terms), len(vocabulary) - 1)
            rows = np.repeat(np.arange(len(counts)), counts)
            known = vocabulary[at] == doc_terms
            rows, cols, tfs = rows[known], at[known], tfs[known]
            order = np.lexsort((cols, rows))
            rows, cols, tfs = rows[order], cols[order], tfs[order]
            impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * lengths[rows])
            some, rows = np.unique(rows, return_inverse=True)
            if len(some):
                vectors = _Rows.of(rows, cols, impact, len(some))
                doc_ids = docs.column("doc_id").to_numpy()[some]
                floors = items.column("floor").to_numpy().astype(np.int64)
                item_ids = items.column("item_id").to_numpy()
                for i, scores, ids in _Search(vectors, doc_ids, queries, floors, len(vocabulary), k).run():
                    for column, values in zip(out, (np.full(len(ids), item_ids[i]), ids, scores)):
                        column.append(values)
        return pa.table([np.concatenate([np.zeros(0, np.int64), *x]) for x in out], schema=schema)

    return run


def _spread(rows: DataFrame, name: str, n: int) -> DataFrame:
    """Every row once for each ``name`` from 0 to n - 1, by two steps so that no row holds all of the numbers."""
    step = math.isqrt(max(n - 1, 0)) + 1
    outer = rows.withColumn("_outer", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // step))))
    last = F.least(F.col("_outer") * step + (step - 1), F.lit(n - 1))
    return outer.withColumn(name, F.explode(F.sequence(F.col("_outer") * step, last))).drop("_outer")


def _top(found: DataFrame, k: int) -> DataFrame:
    over = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` documents of ``docs`` (doc_id, text) that score highest for each
    of ``items`` (item_id, text).

    With N documents that hold a term, L terms in all of them, n terms in a document, df documents that hold a term and
    tf its count in the document, the term's weight is floor(1000 ln((2N + 2) / (2df + 1))), the document's m is
    25 + 75 n N div L, and a score sums weight * (10^9 tf div (1000 tf + 8 m)) over the item's terms, repeats included. Only
    scores above 0 count; equal scores rank by ascending doc_id.

    A null or empty text, or one without a term, is never found and finds nothing. A row of ``docs`` without a doc_id
    counts in N, L and df but cannot be named and is not ranked; rows that repeat a doc_id are documents of their
    own. Repeated rows of ``items`` count once, of rows with one item_id and different texts the least text stands for the
    item, and items without an id are left out. Other columns are not read; an empty table gives an empty result.
    """
    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    named = named.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
    queries = materialize(named.mapInArrow(_vectors(None), VECTORS), "items")
    item_terms = queries.select("id", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("id", F.col("x.terms").alias("term"), "x.counts")
    table = _bit_table(item_terms)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    vectors = rows.mapInArrow(_vectors(table), VECTORS).where("n > 0")
    vectors = materialize(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n_docs, n_terms, n_found = vectors.agg(F.count(F.lit(1)), F.sum("n"), F.count_if(F.size("terms") > 0)).first()

    frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = item_terms.join(frequency, "term").groupBy("id").agg(F.collect_list(F.struct("term", "df", "counts")).alias("x"))
    weighted = weighted.select(F.col("id").alias("item_id"), F.col("x.term").alias("terms"), F.col("x.df").alias("dfs"), F.col("x.counts").alias("counts"))
    weighted = materialize(weighted, "weighted")
    n_item_terms = weighted.agg(F.sum(F.size("terms"))).first()[0] or 0

    blocks, item_blocks = -(-n_found // DOCUMENTS) or 1, -(-n_item_terms // TERMS) or 1
    found = vectors.withColumnRenamed("id", "doc_id").where("doc_id is not null and size(terms) > 0")
    found = found.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    weighted = weighted.withColumn("item_block", F.pmod(F.xxhash64("item_id"), F.lit(item_blocks)).cast("int"))
    search = _searched(n_docs, n_terms or 1, k)

    def searched(first: bool, wanted: DataFrame) -> DataFrame:
        here = (F.col("block") % FIRST == 0) if first else (F.col("block") % FIRST != 0)
        left = _spread(found.where(here), "item_block", item_blocks).select("block", "item_block", "doc_id", "n", "terms", "counts")
        right = _spread(wanted, "block", blocks).where(here)
        return left.groupBy("block", "item_block").cogroup(right.groupBy("block", "item_block")).applyInArrow(search, FOUND)

    # the k-th scores of the first blocks bound the work in the others
    best = materialize(_top(searched(True, weighted.withColumn("floor", F.lit(0).cast("long"))), k), "first")
    kth = best.where(F.col("rank") == k).select("item_id", F.col("score").alias("floor"))
    bounded = weighted.join(kth, "item_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("long")))
    both = best.drop("rank").unionByName(searched(False, bounded))
    return _top(both, k).select("item_id", "rank", "doc_id", "score")
