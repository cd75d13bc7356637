"""Near-equal lines, with DataFrame functions only.

Lines (blanks at both ends cut off) that are not empty are compared; two are linked when at most ``EDITS``
single-character edits lead from one to the other, whatever their length. A line is split into EDITS + 1 segments, so at least
one of them stands unchanged in any linked line. Segments are indexed by (length of the line, number, text); a line
probes, for each length from its own down to EDITS less, the substrings that a segment can have moved to. For two edits,
longer lines meet by the ends and the middle of a class of lengths instead, with a third of the keys. What meets is
verified with a bit-parallel edit distance inside the band of EDITS diagonals.

Of the lines that links connect, the first by document stays and the others are removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .columns import by_text, named, once
from .components import linked_members, shared_buckets

EDITS = 2
#: Parts of a line, of which two edits leave all but two as they were, where its segments alone say too little.
PARTS = 8
#: Lines in a bucket up to which all pairs are compared as they are.
FEW = 16
LAST = 2**63 - 1  # order of a missing doc_id


def _segments(n: int | Column, edits: int) -> list[tuple[Column, Column]]:
    """(start from 1, size) of the edits + 1 segments of a line of n characters; the last ones are the longer."""
    parts = edits + 1
    size, longer = F.floor(n / parts).cast("int"), (n % parts).cast("int")
    out = []
    for i in range(parts):
        before = F.greatest(F.lit(i) - (F.lit(parts) - longer), F.lit(0))
        out.append((size * i + before + 1, size + F.when(F.lit(i) >= F.lit(parts) - longer, 1).otherwise(0)))
    return out


def _index_keys(line: Column, n: Column, edits: int) -> list[Column]:
    return [F.xxhash64(n, F.lit(i), F.substring(line, p, m)) for i, (p, m) in enumerate(_segments(n, edits))]


def _probe_keys(line: Column, n: Column, edits: int, own: bool = True) -> list[Column]:
    """Keys of the substrings of a line of n characters that may be a segment of a line of n - d characters; without
    ``own`` not its own segments, which are those of the index.

    With d deletions known, segment i (from 0) can have moved by at most i places judged from the left, and from
    the right by at most edits - i around d: the starts that both views allow are enough.
    """
    keys = []
    for d in range(edits + 1):
        shorter = n - d
        for i, (p, m) in enumerate(_segments(shorter, edits)):
            low, high = max(-i, d - (edits - i)), min(i, d + (edits - i))
            for move in range(low, high + 1):
                if d == move == 0 and not own:
                    continue
                at = p + move
                inside = (at >= 1) & (at + m - 1 <= n)
                keys.append(F.when(inside, F.xxhash64(shorter, F.lit(i), F.substring(line, at, m))))
    return keys


#: Lines from this length on meet by the ends and the middle of a class of lengths.
LONG = 32


def _class(n: Column) -> Column:
    """Least length of the class of a line of n characters."""
    return n - n % F.when(n < 3 * LONG, LONG // 4).when(n < 8 * LONG, LONG // 2).otherwise(LONG)


def _classes(n: Column) -> Column:
    """Classes of a line: that of its length and that of two less, so lines that differ by two have one in common."""
    return F.array_distinct(F.array(_class(n), F.when(n - 2 >= LONG, _class(n - 2)).otherwise(_class(n))))


def _class_keys(line: Column, n: Column, low: Column) -> list[Column]:
    """Keys of a line in a class of lengths from ``low`` on; any line of the class two edits away has one of them as well.

    The least length is cut in a beginning, a middle and an end, the middle with a character to spare. Of two edits, one
    must be in the beginning and one in the end to change both; the middle then stands unchanged, moved by one place at
    most, so of its two substrings at neighbouring places one is the other line's at one of them."""
    middle = F.floor(low / 3).cast("int")
    front = F.floor((low - middle - 1) / 2).cast("int")
    end = low - middle - 1 - front
    parts = ((0, F.lit(1), front), (1, front + 1, middle), (1, front + 2, middle), (2, n - end + 1, end))
    return [F.xxhash64(low, F.lit(i), F.substring(line, at, size)) for i, at, size in parts]


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """(id, key) for keys of which two lines (id, line, n) at most ``edits`` apart share one."""
    line, n = F.col("line"), F.col("n")
    keys = _index_keys(line, n, edits) + _probe_keys(line, n, edits, own=False)
    if edits != 2:
        return _exploded(lines, keys)
    long = lines.where(n >= LONG).select("id", "line", "n", F.explode(_classes(n)).alias("low"))
    return _exploded(lines.where(n < LONG + edits), keys).unionAll(_exploded(long, _class_keys(line, n, F.col("low"))))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two strings is at most ``edits``, by bit-parallel dynamic programming.

    What the strings share at both ends is cut off. Then the longer one runs down, the shorter one across. Column j
    of the table is held as differences between neighbouring cells, one bit each, for the rows j - edits - 1 to
    j + edits only; bit operations and one addition make a column from the one before. The distance is followed
    along the band's lower diagonal and, once that has left the table, along its last row.
    """
    width = 2 * edits + 2
    mask = F.lit((1 << width) - 1).cast("long")
    zero, one, top = F.lit(0).cast("long"), F.lit(1).cast("long"), F.lit(1 << (width - 1)).cast("long")
    first_a = F.length(a) >= F.length(b)
    down = F.split(F.when(first_a, a).otherwise(b), "")
    across = F.split(F.when(first_a, b).otherwise(a), "")

    def unequal(x: Column, y: Column) -> Column:
        """Place from 0 of the first difference of two arrays, or the size of the shorter one."""
        at = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), True)
        return F.when(at > 0, at - 1).otherwise(F.size(y)).cast("int")

    def cut_front(v: Column) -> Column:
        same = unequal(v["x"], v["y"])
        rest = lambda z: F.slice(z, same + 1, F.size(z))
        return F.struct(F.reverse(rest(v["x"])).alias("x"), F.reverse(rest(v["y"])).alias("y"))

    def sized(v: Column) -> Column:
        return F.struct(v["x"].alias("x"), v["y"].alias("y"), F.size(v["x"]).alias("n"), F.size(v["y"]).alias("m"))

    def match(v: Column, j: Column) -> Column:
        """Bits of the band's rows whose character is that of column j."""
        def at(c: Column) -> Column:
            bits = zero
            for bit in range(width):
                row = j + (edits + 1 - width + bit)
                bits = bits.bitwiseOR(F.when((row >= 0) & (F.get(v["x"], row) == c), F.lit(1 << bit).cast("long")).otherwise(zero))
            return bits
        return once(F.get(v["y"], j), at)

    def next_column(s: Column, v: Column, j: Column) -> Column:
        def level(m: Column) -> Column:
            carry = (m.bitwiseAND(s["up"]) + s["up"]).bitwiseXOR(s["up"])
            return carry.bitwiseOR(m).bitwiseOR(s["down"]).bitwiseAND(mask)

        def steps(d: Column) -> Column:
            plus = s["down"].bitwiseOR(F.bitwise_not(d.bitwiseOR(s["up"])).bitwiseAND(mask))
            return F.struct(d.alias("d"), F.shiftright(d, 1).alias("shifted"), plus.alias("plus"), d.bitwiseAND(s["up"]).alias("minus"))

        def close(t: Column) -> Column:
            # the band's lower diagonal, or the place of the table's last row in the band
            bit = F.call_function("shiftleft", one, (F.lit(width - 2) - (j - (v["n"] - edits))).cast("int"))
            last = F.when(t["plus"].bitwiseAND(bit) != 0, 1).otherwise(0) - F.when(t["minus"].bitwiseAND(bit) != 0, 1).otherwise(0)
            change = F.when(j < v["n"] - edits, F.when(t["d"].bitwiseAND(top) == 0, 1).otherwise(0)).otherwise(last)
            up = t["minus"].bitwiseOR(F.bitwise_not(t["shifted"].bitwiseOR(t["plus"])).bitwiseAND(mask))
            return F.struct(up.alias("up"), t["shifted"].bitwiseAND(t["plus"]).alias("down"), (s["dist"] + change).cast("int").alias("dist"))

        return once(once(match(v, j), level), lambda d: once(steps(d), close))

    up = ((1 << width) - 1) & ~((1 << (width - edits - 1)) - 1)
    start = F.struct(F.lit(up).cast("long").alias("up"), zero.alias("down"), F.lit(edits).cast("int").alias("dist"))

    def distance(v: Column) -> Column:
        advance = lambda s, j: F.when(s["dist"] > 2 * edits + 1, s).otherwise(next_column(s, v, j))
        walked = F.aggregate(F.sequence(F.lit(0), F.greatest(v["m"] - 1, F.lit(0))), start, advance, lambda s: s["dist"])
        # a rest no longer than the band's reach is put right by as many edits as the longer one has characters
        return (v["n"] - v["m"] <= edits) & ((v["n"] <= edits) | F.when(v["m"] > edits, walked <= edits).otherwise(F.levenshtein(
            F.array_join(v["x"], ""), F.array_join(v["y"], "")) <= edits))

    cut = F.struct(down.alias("x"), across.alias("y"))
    return once(once(once(cut, cut_front), cut_front), lambda v: once(sized(v), distance))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, line) of the lines that are compared."""
    split = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return split.withColumn("line", F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c"))).where(F.col("line") != "")


def _exploded(lines: DataFrame, keys: list[Column]) -> DataFrame:
    """(id, key): a row per key of a line. The keys are columns before they are rows, so that each is compiled and
    worked out once; written as an array to explode, a filter on the array's size would make them all over again."""
    names = [f"k{i}" for i in range(len(keys))]
    wide = lines.select("id", *(k.alias(name) for k, name in zip(keys, names)))
    return wide.select("id", F.explode_outer(F.array(*names)).alias("key")).where("key is not null")


def _key(line: str) -> list[Column]:
    """128 bits of a line."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def _around_keys(line: Column, n: Column, parts: int) -> list[Column]:
    """For one edit: keys of a line without one of ``parts`` segments, of its own length and of one character less.

    A line and another that one edit makes of it agree in front of the segment that holds the edit, and behind it
    counted from the end."""
    keys = []
    for d in (0, 1):
        for i, (p, m) in enumerate(_segments(n - d, parts - 1)):
            keys.append(F.xxhash64(n - d, F.lit(i), F.substring(line, F.lit(1), p - 1), F.right(line, n - d - (p + m - 1))))
    return keys


def _kinds(parts: int) -> list[tuple[int, int, int, int]]:
    """(d, i, j, move) of the keys for two edits: d characters less, without the parts i to i and j to j, with the middle
    moved."""
    return [(d, i, j, move) for d in (0, 1, 2) for i in range(parts) for j in range(i, parts)
            for move in ((0,) if i == j else range(max(-1, d - 1), 2))]


def _kind_array(parts: int) -> Column:
    return F.array(*(F.struct(*(F.lit(x).alias(name) for x, name in zip(k, ("d", "i", "j", "move")))) for k in _kinds(parts)))


def _part_start(z: Column, n: Column, parts: int):
    """Where the parts of a line of n characters begin, when it is cut like one of z.d characters less."""
    size, longer = F.floor((n - z["d"]) / parts).cast("int"), (n - z["d"]) % parts
    return lambda k: size * k + F.greatest(k - (F.lit(parts) - longer), F.lit(0)) + 1


def _around_two_keys(line: Column, n: Column, parts: int) -> Column:
    """For two edits: keys of a line without two of ``parts`` segments, or one, of its own length and of one and two
    characters less.

    A line and another that two edits make of it agree in front of the segment with the first edit, behind that with the
    second counted from the end, and between them, where the longer line has moved by what the first edit added."""
    def key(z: Column) -> Column:
        at = _part_start(z, n, parts)
        behind = at(z["i"] + 1)
        middle = F.substring(line, behind + z["move"], at(z["j"]) - behind)
        tail = F.right(line, n - z["d"] - at(z["j"] + 1) + 1)
        return F.xxhash64(n - z["d"], z["i"] * parts + z["j"], F.substring(line, F.lit(1), at(z["i"]) - 1), middle, tail)

    return F.transform(_kind_array(parts), key)


def _left_out(line: Column, n: Column, kind: Column, parts: int) -> Column:
    """Of a key's two parts that it leaves out: the hash of the first one, counted from the left, if the middle has not
    moved from there, and of the second, counted from the right, if it has not moved from there; else null. Two lines that
    agree in one of them meet by a key that leaves the other one out alone."""
    def hashes(z: Column) -> Column:
        at = _part_start(z, n, parts)
        two, size = z["i"] < z["j"], n - z["d"]
        first = F.when(two & (z["move"] == 0), F.xxhash64(F.substring(line, at(z["i"]), at(z["i"] + 1) - at(z["i"]))))
        second = F.when(two & (z["move"] == z["d"]), F.xxhash64(F.substring(line, n - size + at(z["j"]), at(z["j"] + 1) - at(z["j"]))))
        return F.struct(first.alias("first"), second.alias("second"))

    return once(F.element_at(_kind_array(parts), kind + 1), hashes)


#: Characters that are counted together, as two longs of eight counts of a byte each.
COUNTED = ("ak", "bl", "cm", "dn", "eo", "fp", "gq", "hr", "is", "jt", "uz", "vy", "wx", " .", "02468,", "13579-")


def _counts(line: Column) -> Column:
    """How often ``line`` has the characters of each of ``COUNTED``, modulo 256."""
    low = F.lower(line)
    numbers = [(F.length(low) - F.length(F.translate(low, x, ""))).cast("long").bitwiseAND(F.lit(255)) for x in COUNTED]
    packed = [reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(n, 8 * i) for i, n in enumerate(numbers[k : k + 8]))) for k in (0, 8)]
    return F.struct(packed[0].alias("p"), packed[1].alias("q"))


def _counts_allow(x: str, y: str, edits: int) -> Column:
    """Whether lines of these counts can be ``edits`` apart: an edit changes two counts by one at most."""
    total = F.lit(0)
    for part in ("p", "q"):
        for i in range(8):
            at = lambda c: F.shiftrightunsigned(F.col(f"{c}.{part}"), 8 * i).bitwiseAND(F.lit(255))  # noqa: E731, B023
            apart = F.abs(at(x) - at(y))
            total = total + F.least(apart, F.lit(256) - apart)
    return total <= 2 * edits


def duplicate_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, text_key (hash of the text) and ``removed`` (numbers from 0 of the lines to remove) for the documents of
    ``docs`` (doc_id, text) that lose any.

    Of linked lines, the first in the document with the least id stays. Null and empty texts have no lines; a missing
    doc_id comes after all others; rows that repeat an id are told apart by their texts, and exact repetitions of a
    row are treated alike. Other columns are not read; an empty table gives an empty result.
    """
    lines = _lines(docs)
    order = F.coalesce("doc_id", F.lit(LAST))
    distinct = lines.groupBy("line").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n_lines"))
    distinct = distinct.select("line", "first", "n_lines", F.length("line").alias("n"), *_key("line"))
    distinct = materialize(distinct.withColumn("id", F.monotonically_increasing_id()), "lines")

    # both uses of the keys read one exchange
    found = shared_buckets(_keyed(distinct, edits).repartition("key"))
    wanted = materialize(distinct.join(found.select("id").distinct(), "id").select("id", "line", "n"), "wanted")
    found = materialize(found.join(wanted.select("id", "n"), "id").select("key", "id", "n"), "found")

    def confirm(pairs: DataFrame) -> DataFrame:
        both = pairs.join(wanted.select(F.col("id").alias("a"), F.col("line").alias("x")), "a")
        both = both.join(wanted.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
        return both.where(within_edits(F.col("x"), F.col("y"), edits)).select("a", "b")

    def refine(ids: DataFrame) -> tuple:
        """Lines that share a third of their text with others meet by all but one part in ``PARTS`` per edit instead."""
        mixed = materialize(wanted.join(ids, "id"), "mixed-lines")
        if edits == 1:
            members = _exploded(mixed, _around_keys(F.col("line"), F.col("n"), PARTS))
        else:
            keyed = mixed.select("id", _around_two_keys(F.col("line"), F.col("n"), PARTS).alias("keys"))
            members = keyed.select("id", F.posexplode_outer("keys").alias("n", "key"))
            return members.groupBy("id", "key").agg(F.min("n").alias("n")), confirm, any_size
        return members.distinct().withColumn("n", F.lit(0)), confirm, any_size

    def described(rest: DataFrame) -> DataFrame:
        left = materialize(wanted.join(rest.select("id").distinct(), "id"), "left")  # once a line that is left, not a key
        lines_of = left.select("id", "line", F.col("n").alias("size"), _counts(F.col("line")).alias("counts"))
        out = _left_out(F.col("line"), F.col("size"), F.col("n"), PARTS) if edits == 2 else F.struct(
            F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("second"))
        return rest.join(lines_of, "id").select("key", "id", F.struct("counts", out.alias("out")).alias("n"), "c")

    def closer(x: str, y: str) -> Column:
        elsewhere = reduce(lambda a, b: a | b, (F.coalesce(F.col(f"{x}.out.{k}") == F.col(f"{y}.out.{k}"), F.lit(False)) for k in ("first", "second")))
        return _counts_allow(f"{x}.counts", f"{y}.counts", edits) & ~elsewhere

    any_size = lambda n, m: F.lit(True)
    near_size = lambda n, m: F.abs(F.col(n) - F.col(m)) <= edits
    labels = linked_members(found, confirm, near_size, refine if edits <= 2 else None, (described, closer), FEW)
    known = distinct.select("id", "k1", "k2", "first", "n_lines").join(labels, "id", "left").withColumn("c", F.coalesce("component", "id"))
    groups = known.groupBy("c").agg(F.min("first").alias("first"), F.sum("n_lines").alias("n_lines")).where("n_lines > 1")
    repeated = materialize(known.select("k1", "k2", "c").join(groups.select("c", "first"), "c"), "repeated")
    places = lines.select("doc_id", "text_key", "pos", *_key("line")).join(repeated, ["k1", "k2"])
    own = places.groupBy("doc_id", "text_key", "c", "first").agg(F.collect_set("pos").alias("all"))
    stays = F.coalesce("doc_id", F.lit(LAST)) == F.col("first")
    gone = F.when(stays, F.array_except("all", F.array(F.array_min("all")))).otherwise(F.col("all"))
    return own.groupBy("doc_id", "text_key").agg(F.array_sort(F.flatten(F.collect_list(gone))).alias("removed")).where("size(removed) > 0")


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_lines (with anything but blanks), n_removed and removed (line numbers).

    Every row gives one, a null or empty text with no lines; equal lines of a document count each, all but the first of
    its group's first document are removed. Missing and repeated ids as in ``duplicate_lines``; other columns are not read.
    """
    gone = duplicate_lines(docs, edits).alias("g")
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")) != ""))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"), n.cast("long").alias("n_lines")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_key") == F.col("g.text_key"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return base.join(gone, same, "left").select("d.doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def remove_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``docs`` without the repeated lines; a document that has no word left by that goes. All columns stay, whatever
    their names. Null and empty texts stay as they are; missing and repeated ids as in ``duplicate_lines``."""
    both, (removed,) = by_text(docs, duplicate_lines(docs, edits), "removed")
    gone = F.col(removed)
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")
    both = both.withColumn("text", F.when(gone.isNull(), F.col("text")).otherwise(left))
    return both.where(gone.isNull() | F.col("text").rlike(r"[^ \t\n\r\x0b\x0c]")).select(*named(docs.columns))
