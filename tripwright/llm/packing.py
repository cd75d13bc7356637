"""Packing documents, in order, into sequences of a fixed length.

The token stream of consecutive documents may be cut at any sentence or document end. A sequence of n tokens is
padded to ``LENGTH`` unless n is a power of two. Cuts are chosen by dynamic programming over the possible places
p[0] < p[1] < ...: best[i] = penalty[i] + min over j with p[i] - p[j] <= LENGTH of best[j] + padding(p[i] - p[j]).
The padding is LENGTH + p[j] - p[i], so the j to take is the one with the least best[j] + p[j] in a sliding
window, which a monotone queue gives in constant time per place. Tokens left at the end of a stream go into
sequences whose sizes are powers of two.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import SpaceEncoder, encoder

LENGTH = 2048
#: What a cut costs, in tokens of padding: behind a sentence, and inside one.
SENTENCE_CUT, WORD_CUT = 2, 8
#: Inside a sentence, a cut may fall after so many tokens of it, or a multiple.
STEP = 16
#: Tokens whose cuts are chosen together; the sequence that is open then is carried on.
BLOCK_TOKENS = 1 << 20
SEQUENCES = 1 << 33  # ids of sequences that one partition may give


def choose_cuts(places: list[int], penalties: list[int], length: int, rest=None) -> list[int]:
    """Places of the cheapest cuts, the last place included. ``places`` ascend from above 0, with no gap over
    ``length``. ``rest(n)`` is what n tokens before the last place cost (their padding if not given)."""
    at, keys, back = [0, *places], [0], [0]  # keys: least cost up to a place, and the place
    # the queue: keys, ascending, and their places and numbers; what lies before the head is too far back
    sums, spots, numbers, head = [0], [0], [0], 0
    first, spot = 0, 0  # key and place of the head
    for i, (p, penalty) in enumerate(zip(places, penalties), 1):
        low = p - length
        if spot < low:
            while spots[head] < low:
                head += 1
            first, spot = sums[head], spots[head]
        key = first + length + penalty  # more than that of the head, which so stays
        back.append(numbers[head])
        keys.append(key)
        while sums[-1] >= key:
            sums.pop()
            spots.pop()
            numbers.pop()
        sums.append(key)
        spots.append(p)
        numbers.append(i)
    i = len(at) - 1
    if rest:
        back[i] = min(range(bisect_left(at, at[i] - length), i), key=lambda j: keys[j] - at[j] + rest(at[i] - at[j]))
    cuts = []
    while i:
        cuts.append(at[i])
        i = back[i]
    return cuts[::-1]


def split_rest(rest: int, length: int) -> list[int]:
    """Sizes for the tokens after the last full sequence: powers of two need no padding, so they are taken off
    while one more cut costs less than the padding that it saves."""
    sizes = []
    while rest:
        power = 1 << (rest.bit_length() - 1)
        if power == rest or length - rest <= WORD_CUT:
            sizes.append(rest)
            break
        sizes.append(power)
        rest -= power
    return sizes


def rest_cost(rest: int, length: int) -> int:
    sizes = split_rest(rest, length)
    return (len(sizes) - 1) * WORD_CUT + (length - sizes[-1] if sizes[-1] & (sizes[-1] - 1) else 0)


SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


class _Stream:
    """Documents of one partition on their way into sequences."""

    def __init__(self, block: int, length: int):
        self.length, self.next_id = length, block * SEQUENCES
        self.docs: list[tuple] = []  # (doc_id, ids, tokens of it already in a sequence, sentence ends)
        self.tokens = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, ends))
        self.tokens += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        at, places, penalties = 0, [], []
        for _, ids, done, ends in self.docs:
            inner = ends[(ends > done) & (ends < len(ids) - 1)] - done + at
            stop = at + len(ids) - done
            places += [*inner.tolist(), stop]
            penalties += [SENTENCE_CUT] * len(inner) + [0]
            at = stop
        cuts = self.choose(places, penalties, last)
        if last:
            full = cuts[-2] if len(cuts) > 1 else 0
            for size in split_rest(at - full, self.length)[:-1]:
                cuts.insert(-1, full := full + size)
        else:
            cuts = cuts[:-1]  # the last sequence stays open
        return self.cut(cuts)

    def choose(self, places: list[int], penalties: list[int], last: bool) -> list[int]:
        """Adds cuts inside sentences longer than ``STEP``, then chooses among all places."""
        stop, price = np.array(places), np.array(penalties)
        start = np.concatenate([[0], stop[:-1]])
        extra = (stop - start - 1) // STEP  # cuts that a sentence gets inside
        part = np.repeat(np.arange(len(stop)), extra + 1)
        place = np.arange(len(part)) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
        inside = place < extra[part]
        full = np.where(inside, start[part] + (place + 1) * STEP, stop[part]).tolist()
        cost = np.where(inside, WORD_CUT, price[part]).tolist()
        rest = (lambda n: rest_cost(n, self.length)) if last else (lambda n: 0)
        return choose_cuts(full, cost, self.length, rest)

    def cut(self, cuts: list[int]) -> list[tuple]:
        rows, d, begin = [], 0, 0
        for cut in cuts:
            offset = 0
            while offset < cut - begin:
                doc_id, ids, done, ends = self.docs[d]
                n = min(len(ids) - done, cut - begin - offset)
                rows.append((doc_id, done, n, len(ids), self.next_id, offset, ids[done : done + n].tobytes()))
                offset += n
                self.docs[d] = (doc_id, ids, done + n, ends)
                d += done + n == len(ids)
            self.next_id += 1
            begin = cut
        self.docs = self.docs[d:]
        self.tokens = sum(len(x[1]) - x[2] for x in self.docs)
        return rows


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 4096):
        cols = list(zip(*rows[i : i + 4096]))
        arrays = [*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, NAMES)


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    encode, stream = encoder(SpaceEncoder, path), _Stream(TaskContext.get().partitionId(), length)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.frombuffer(encode(text.as_py() or b"") + end, "<u4")
            stream.add(doc_id, ids, encode.sentence_ends(ids[:-1]))
            if stream.tokens >= BLOCK_TOKENS:
                yield from _batches(stream.flush(last=False))
    if stream.docs:
        yield from _batches(stream.flush(last=True))


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, length: int = LENGTH, partitions: int | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: doc_id, start and length of the piece in its
    document, doc_tokens (with the end id), sequence_id, offset in the sequence, ids (little-endian unsigned
    32-bit).

    Documents are taken in ascending doc_id (none first; rows that repeat an id by the hash of their texts) within
    ranges of both, each range a stream of its own. A null or empty text is its end id alone; no row gives no piece.
    ``sequence_id`` numbers the sequences of a range in order, ranges ``SEQUENCES`` apart. Other columns are not read.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_key"))
    ordered = ordered.repartitionByRange(n, "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key", "text").select("doc_id", "text")
    return ordered.mapInArrow(lambda it: _pack(it, tokenizer_file, end_id, length), SCHEMA)
