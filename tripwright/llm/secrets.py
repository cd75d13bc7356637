"""Credentials in documents, with the false positives of the patterns removed by a random forest.

Patterns propose findings: assignments to a name like password or token, access key ids, and long runs of letters
and digits. Each finding is described by its length, its kinds of characters, how likely the transitions between its
characters are in the texts at large (a matrix counted over all documents), how much of it a dictionary covers, the
path or address that it stands in, and the words around it. A forest trained on labelled findings tells secrets from
identifiers, addresses and long words.

What a finding is assigned to and the prefix of its issuer are no features: they label findings where no reviewed ones
are at hand (``label_by_source``), and the forest judges the others, and those as well, by everything else.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import worker_cache

#: Labelled findings of either kind that a forest is trained on, at most.
LABELLED = 5_000
TREES, DEPTH, SEED = 20, 6, 11
#: Runs that may be a secret wherever they stand.
RUN = re.compile(r"[A-Za-z0-9+/_\-@.]{12,}={0,2}")
BEFORE = re.compile(r"([A-Za-z_]+)[\"']?\s*([=:]?)\s*[\"']?$")
# Names that a secret is assigned to, and prefixes of issued keys.
NAMES = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "api_key", "credential", "auth")
#: Values assigned to one of the names, of any length and any characters.
ASSIGNED = re.compile(
    "(?i)(?:" + "|".join(NAMES) + r""")[A-Za-z_]{0,40}["']?\s*[=:]+\s*(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"'][^\s]*))""")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "xoxb", "xoxp", "sk_l", "AIza", "glpa", "eyJh")

#: Buckets of the words before a finding and behind it.
BUCKETS = 8
FEATURES = (
    "length", "digits", "uppers", "lowers", "others", "hexadecimal", "distinct", "entropy", "transitions", "likelihood", "digit_runs",
    "dictionary", "segments", "address", *(f"before{i}" for i in range(BUCKETS)), *(f"behind{i}" for i in range(BUCKETS)),
)
SCHEMA = "doc_id long, start int, finding string, name string, assigned boolean, issued boolean, " + ", ".join(f"{f} double" for f in FEATURES)

# Characters as 54 classes: small and capital letters by themselves, digits, all else.
CLASSES = 54
_CLASS = np.full(256, 53, np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(26)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(26, 52)
_CLASS[ord("0") : ord("9") + 1] = 52


def _pairs(text: bytes) -> np.ndarray:
    c = _CLASS[np.frombuffer(text, np.uint8)]
    return c[:-1] * CLASSES + c[1:]


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in batches:
        for text in batch.column(0):
            total += np.bincount(_pairs(text.as_py() or b""), minlength=CLASSES * CLASSES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])


def transitions(docs: DataFrame) -> np.ndarray:
    """Logarithm of the share of each next class after each class, counted over the whole texts of ``docs``."""
    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_count_pairs, "pair long, n long")
    n = np.ones((CLASSES, CLASSES))
    for row in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # CLASSES squared at most
        n[divmod(row["pair"], CLASSES)] += row["n"]
    return np.log(n / n.sum(axis=1, keepdims=True)).ravel()


def kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o"


def coverage(text: str, dictionary: frozenset[str]) -> float:
    """Share of the characters inside dictionary words of three letters or more, taken greedily from the left."""
    low, at, covered = text.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in dictionary), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def dictionary_of(vocabulary_file: str) -> frozenset[str]:
    """Words and word parts of three letters or more of a public vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file)
    pieces = (model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size()))
    return frozenset(p for p in pieces if len(p) >= 3 and p.isalpha())


def _words_around(text: str, start: int, end: int, name: str) -> tuple[list[str], list[str]]:
    """Two words before the finding, without what it is assigned to, and two behind it."""
    before = text[max(0, start - 80) : start - len(name)].lower().split()
    behind = text[end : end + 80].lower().split()
    if text[end : end + 1].strip():
        behind = behind[1:]  # what sticks to the finding
    return before[-2:], behind[:2]


def describe(text: str, start: int, end: int, dictionary: frozenset[str], likely: np.ndarray) -> tuple[str, bool, bool, list[float]]:
    """(word that the finding may be assigned to, whether it is, whether it has an issuer's prefix, features in the order
    of ``FEATURES``)."""
    s, n = text[start:end], end - start
    kinds = [kind(c) for c in s]
    share = Counter(kinds)
    letters = Counter(s)
    runs = re.findall(r"\d+", s)
    m = BEFORE.search(text[max(0, start - 40) : start])
    name, sign, put = (m[1].lower(), m[2], m[0]) if m else ("", "", "")
    left = len(text[:start]) - len(text[max(0, start - 200) : start].rsplit(None, 1)[-1]) if text[start - 1 : start].strip() else start
    token = text[left:end] + (text[end : end + 200].split(None, 1) or [""])[0] * bool(text[end : end + 1].strip())
    pairs = _pairs(s.encode())
    before, behind = _words_around(text, start, end, put if sign else "")
    marks = [0.0] * (2 * BUCKETS)
    for k, words in enumerate((before, behind)):
        for w in words:
            marks[k * BUCKETS + crc32(w.encode()) % BUCKETS] += 1
    return name, bool(sign) and any(x in name for x in NAMES), s[:4] in PREFIXES, [
        n, share["d"] / n, share["u"] / n, share["l"] / n, share["o"] / n,
        sum(c in "0123456789abcdefABCDEF" for c in s) / n, len(letters) / n,
        -sum(k / n * math.log2(k / n) for k in letters.values()),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, float(likely[pairs].mean()) if len(pairs) else 0.0,
        max(map(len, runs), default=0) / n, coverage(s, dictionary),
        float(token.count("/")), float("@" in token or bool(re.search(r"\d\.\d", token))), *marks,
    ]


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans, by their start, of what may be a secret: assigned values and long runs, which may overlap."""
    spans = set()
    for m in ASSIGNED.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:  # without quotes: signs of the sentence around it are not part of the value
            end = start + len(m[3].rstrip(".,;-\"'"))
        if end > start:
            spans.add((start, end))
    for m in RUN.finditer(text):
        start, end = m.span()
        end -= len(m[0]) - len(m[0].rstrip(".-"))
        if end - start >= 12 and not (m[0].isalpha() and (m[0].islower() or m[0].istitle())) or end - start >= 18:
            spans.add((start, end))
    yield from sorted(spans)


def _findings(batches: Iterator[pa.RecordBatch], vocabulary_file: str, likely: np.ndarray) -> Iterator[pa.RecordBatch]:
    dictionary = worker_cache("dictionary_" + vocabulary_file, lambda: dictionary_of(vocabulary_file))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), *[pa.float64()] * len(FEATURES)]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            for start, end in candidates(text):
                name, assigned, issued, features = describe(text, start, end, dictionary, likely)
                rows.append((doc_id, start, text[start:end], name, assigned, issued, *features))
                if len(rows) >= 8192:
                    yield made(rows)
                    rows = []
        if rows:
            yield made(rows)


def findings(docs: DataFrame, vocabulary_file: str, likely: np.ndarray | None = None) -> DataFrame:
    """What the patterns find in ``docs`` (doc_id, text): doc_id, start (characters from 0), finding, name (the word it
    may be assigned to), assigned (whether that is a secret's name), issued (whether it has an issuer's prefix) and
    ``FEATURES``. ``likely`` are ``transitions``, by default those of ``docs``. A null or empty text has none; repeated rows
    have theirs each; a missing doc_id is kept. Other columns are not read."""
    likely = transitions(docs) if likely is None else likely
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda it: _findings(it, vocabulary_file, likely), SCHEMA)


def label_by_source(found: DataFrame) -> DataFrame:
    """Labelled findings where no reviewed ones are at hand, by what is no feature: a secret (1) is what is assigned to a
    secret's name or has an issuer's prefix, not a secret (0) is a run that is assigned to nothing and has none."""
    secret = F.col("assigned") | F.col("issued")
    return found.withColumn("label", F.when(secret, 1.0).when(F.col("name") == "", 0.0)).where("label is not null")


def train(labelled: DataFrame, limit: int = LABELLED) -> RandomForestClassificationModel | None:
    """A forest for labelled findings (``FEATURES`` and ``label``), of which ``limit`` of either label are taken, in the
    order of a hash; None if one of the labels is missing."""
    order = F.xxhash64("doc_id", "start", "finding")
    columns = ["doc_id", "start", "label", *FEATURES]
    parts = [labelled.where(F.col("label") == x).orderBy(order, "doc_id", "start").limit(limit).select(*columns) for x in (0.0, 1.0)]
    sample = materialize(parts[0].unionAll(parts[1]).coalesce(1).sortWithinPartitions("doc_id", "start"), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("features", "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8)
    return forest.fit(data)


def secrets(docs: DataFrame, vocabulary_file: str, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Findings in ``docs`` with the forest's verdict: doc_id, start, length, name, probability (in millionths) and
    is_secret. ``labelled`` are findings with a label, by default those of ``label_by_source``; without labels of both
    kinds, every finding counts as a secret. Every finding is a row: equal ones of repeated rows as well, and a value found by
    two patterns twice. A null or empty text has none, a missing doc_id is kept, an empty table gives an empty result."""
    found = materialize(findings(docs, vocabulary_file), "findings")
    model = train(label_by_source(found) if labelled is None else labelled)
    if model is None:
        scored = found.withColumn("p", F.lit(1.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found))
        scored = scored.withColumn("p", vector_to_array("probability")[1])
    return scored.select("doc_id", "start", F.col("length").cast("int").alias("length"), "name",
                         F.round(F.col("p") * 1_000_000).cast("long").alias("probability"), (F.col("p") >= threshold).alias("is_secret"))
