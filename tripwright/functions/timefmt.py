"""Timestamp shape checks, parsing and formatting for fixed-width datetime patterns.

Parsing goes through ``try_make_timestamp_ntz`` on the fields cut out of the text, so the result is a
``TIMESTAMP_NTZ`` that does not depend on the session time zone, and impossible dates (31 February,
hour 25) become NULL instead of raising under ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELDS = {"yyyy": 4, "MM": 2, "dd": 2, "HH": 2, "mm": 2, "ss": 2}
_TOKEN = re.compile(r"yyyy|MM|dd|HH|mm|ss")


def _layout(fmt: str) -> tuple[str, dict[str, int]]:
    """Regex for the pattern's shape and the 1-based start of each field."""
    regex, starts, pos, i = "^", {}, 1, 0
    while i < len(fmt):
        m = _TOKEN.match(fmt, i)
        if m:
            tok = m.group(0)
            starts[tok] = pos
            regex += r"\d{%d}" % _FIELDS[tok]
            pos += _FIELDS[tok]
            i = m.end()
        else:
            regex += re.escape(fmt[i])
            pos += 1
            i += 1
    missing = set(_FIELDS) - set(starts)
    if missing:
        raise ValueError(f"pattern {fmt!r} lacks fields {sorted(missing)}")
    starts["_len"] = pos - 1
    return regex + "$", starts


def shape_regex(fmt: str) -> str:
    """``dd/MM/yyyy HH:mm:ss`` -> ``^\\d{2}/\\d{2}/\\d{4} \\d{2}:\\d{2}:\\d{2}$``."""
    return _layout(fmt)[0]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: str | Column, fmt: str) -> Column:
    """Text in the fixed-width pattern ``fmt`` -> TIMESTAMP_NTZ; wrong shape or impossible value -> NULL."""
    regex, starts = _layout(fmt)
    s = _col(c)

    def part(tok: str) -> Column:
        return F.substring(s, starts[tok], _FIELDS[tok]).cast("int")

    sec = part("ss")
    ts = F.try_make_timestamp_ntz(part("yyyy"), part("MM"), part("dd"), part("HH"), part("mm"), sec.cast("decimal(8,6)"))
    # the length check keeps a trailing line break (which ``$`` tolerates) from parsing
    return F.when(s.rlike(regex) & (F.length(s) == starts["_len"]) & (sec < 60), ts)


def format_ts(c: str | Column, fmt: str) -> Column:
    """TIMESTAMP_NTZ -> text in ``fmt``."""
    return F.date_format(_col(c), fmt)


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session time zone."""
    return F.unix_timestamp(_col(c))


def duration_s(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end."""
    return epoch_seconds(end) - epoch_seconds(start)
