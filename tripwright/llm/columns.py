"""Column helpers."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(value: Column, body) -> Column:
    """``body`` of a value that is worked out once. Written plainly, a value that a lambda uses is worked out again
    for every element, since projections are merged."""
    return F.get(F.transform(F.array(value), body), 0)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name like each of ``names`` that ``df`` does not have (Spark compares names without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(columns: list[str]) -> list[Column]:
    """Columns by name, whatever the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def by_text(docs: DataFrame, marks: DataFrame, *names: str, how: str = "left", extra: dict[str, Column] | None = None) -> tuple:
    """``docs`` joined with the rows of ``marks`` (doc_id, text_key, ...) for the same doc_id, a missing one included, and
    the same text, by its hash; ``extra`` names further columns of ``marks`` with what they must equal. Returns the
    join and the names in it of the columns ``names`` of ``marks``; no name clashes with one of ``docs``."""
    extra = extra or {}
    own = fresh(docs, "doc_of", "text_of", *extra)
    left = docs.withColumns(dict(zip(own, [F.col("doc_id"), F.xxhash64("text"), *extra.values()])))
    keys = ["doc_id", "text_key", *extra]
    theirs = fresh(left, *(f"{k}_mark" for k in keys), *names)
    right = marks.select(*(F.col(k).alias(x) for k, x in zip([*keys, *names], theirs)))
    same = reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(own, theirs)))
    return left.join(right, same, how), theirs[len(keys) :]
