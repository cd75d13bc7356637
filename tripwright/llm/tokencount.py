"""Tokens per document under a unigram model over a public vocabulary, by dynamic programming on a trie.

A pre-token is a word (a run of anything but ASCII blanks) with the vocabulary's word mark before it. Its
segmentation into pieces of least total cost is found by forward scores: the best cost of every prefix. Distinct
pre-tokens are put into a trie, whose nodes are the prefixes, so a prefix that many words share is scored once; the
node at which a word ends keeps its number of tokens.

The file gives an order of pieces, not probabilities. The cost of the piece at place r (from 1) is that of a Zipf
law, ln(r), in whole millionths so that sums are exact; of equal costs the fewer pieces win. A character that no
piece covers is spelt in UTF-8 bytes, each a token at the cost of a place beyond the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import worker_cache

MARK = "▁"
#: Nodes of the trie and words with a known count that a worker keeps; each store is emptied when full.
NODES, WORDS = 300_000, 400_000
#: Characters of a word that become nodes; what is behind them is scored without.
DEPTH = 256
#: Costs are held as cost * MANY + tokens, which orders by cost and then by tokens.
MANY = 1 << 24


def piece_costs(vocabulary_file: str) -> tuple[dict[str, int], int]:
    """(cost of each piece, cost of a byte)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    price = lambda place: round(1e6 * math.log(place)) * MANY + 1
    return {model.id_to_piece(i): price(r) for r, i in enumerate(plain, 2)}, price(size + 2)


class Trie:
    """Prefixes of pre-tokens with their forward scores."""

    def __init__(self, costs: dict[str, int], byte: int):
        self.costs, self.byte = costs, byte
        #: Every ending of a piece: once the text behind a place is none of them, no longer piece can match.
        self.endings = {p[i:] for p in costs for i in range(len(p))}
        self.longest = max(map(len, costs), default=1)
        self.reset()

    def reset(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.score = [0]
        self.count: dict[int, int] = {}  # node where a word ends -> its tokens

    def insert(self, word: str) -> int:
        """Tokens of ``word``."""
        if len(self.score) > NODES:
            self.reset()
        children, score, costs, endings = self.children, self.score, self.costs, self.endings
        node, path = 0, [0]
        for end, char in enumerate(word[:DEPTH], 1):
            child = children.get((node, char))
            if child is None:
                best = score[node] + self.byte * len(char.encode("utf-8", "replace"))
                for begin in range(end - 1, -1, -1):
                    piece = word[begin:end]
                    if piece not in endings:
                        break
                    cost = costs.get(piece)
                    if cost is not None and score[path[begin]] + cost < best:
                        best = score[path[begin]] + cost
                child = children[node, char] = len(score)
                score.append(best)
            node = child
            path.append(node)
        if len(word) > DEPTH:
            return self._behind(word, [score[x] for x in path[-self.longest :]])
        tokens = self.count.get(node)
        if tokens is None:
            tokens = self.count[node] = score[node] % MANY
        return tokens


    def _behind(self, word: str, recent: list[int]) -> int:
        """Tokens of a word longer than the trie is deep, from the scores of its last prefixes in the trie on. Only as many
        scores are held as a piece is long."""
        for end in range(DEPTH + 1, len(word) + 1):
            best = recent[-1] + self.byte * len(word[end - 1].encode("utf-8", "replace"))
            for size in range(1, min(self.longest, len(recent)) + 1):
                piece = word[end - size : end]
                if piece not in self.endings:
                    break
                cost = self.costs.get(piece)
                if cost is not None and recent[-size] + cost < best:
                    best = recent[-size] + cost
            recent.append(best)
            if len(recent) > 4 * self.longest:
                del recent[: -self.longest]
        return recent[-1] % MANY


class Counts(dict):
    """word (bytes) -> tokens; words that are no deeper than the trie are kept."""

    def __init__(self, vocabulary_file: str):
        self.trie = Trie(*piece_costs(vocabulary_file))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        n = self.trie.insert(MARK + word.decode("utf-8", "replace"))
        if len(word) <= DEPTH:
            self[word] = n
        return n


SCHEMA = "doc_id long, n_words long, n_distinct_words long, n_tokens long"


def _count(batches: Iterator[pa.RecordBatch], vocabulary_file: str) -> Iterator[pa.RecordBatch]:
    counts = worker_cache(f"token_counts_{vocabulary_file}", lambda: Counts(vocabulary_file))
    for batch in batches:
        words, distinct, tokens = [], [], []
        for text in batch.column(1):
            parts = (text.as_py() or b"").split()
            words.append(len(parts))
            distinct.append(len(set(parts)))
            tokens.append(sum(map(counts.__getitem__, parts)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, distinct, tokens))], ["doc_id", "n_words", "n_distinct_words", "n_tokens"]
        )


def token_counts(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    """doc_id, n_words, n_distinct_words and n_tokens per row of ``docs`` (doc_id, text), in one pass without a shuffle.

    A null or empty text, or one of blanks, has no words and no tokens. Repeated rows and rows without a doc_id are
    counted like any other. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(lambda it: _count(it, vocabulary_file), SCHEMA)
