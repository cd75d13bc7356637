"""Small tables with the odd cases that every operator must take."""

import zlib

import numpy as np

#: Names that operators use for columns of their own or for results.
CLASHING = (
    "n_words", "component_id", "removed", "removed_", "_text", "text_key", "text_key_mark", "doc_of", "text_of", "doc_id_mark", "host", "host_mark", "_host",
    "_key", "key", "row", "_row", "spans", "_spans", "id", "n", "terms", "counts", "line", "pos", "items", "start", "end", "other_id", "runs", "collapsed", "block",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def table(spark, texts, source="s"):
    """Documents 0.. with columns whose names clash with those of results and of helpers, each of a value of its own."""
    rows = [(i, t, "en", source, len(t) if t else None, *(f"{c} {i}" for c in CLASHING)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def untouched(got, asked):
    """Whether rows of ``got`` hold what those of ``asked`` with the same doc_id do in all columns but the text."""
    want = {r.doc_id: r.asDict() | {"text": None} for r in asked.collect()}
    return got.columns == asked.columns and all(r.asDict() | {"text": None} == want[r.doc_id] for r in got.collect())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


ODD = [None, "", " \n\t ", "one", "x" * 30000, "a b c " * 4000, "été Über naïve", "a\nb\n\nc", "one"]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
