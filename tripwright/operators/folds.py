"""Array kernels of the two per-vehicle folds, over rows sorted by vehicle and trip order.

Overlap removal (D01): the trip kept after trip i is the first later one that starts at or after the end of i, so the kept
trips are the orbit of the first trip under one pointer per row. Connection (D02): a group ends at the first trip with
which its distance reaches the limit, so within trips that follow each other closely the group starts are an orbit, too.
Orbits of all vehicles are marked at once by doubling the pointers; there is no loop over rows.

Where a vehicle's rows are cut into chunks, a chunk's effect on the fold is a map from the state at its entry to the state
at its exit: for D01 from the end of the last kept trip to another such end, for D02 from the open group's distance to
another. ``overlap_map`` and ``connect_map`` give these maps, ``OverlapState`` and ``ConnectState`` follow them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Stand for a missing time; differences of the two still fit a long.
LOW, HIGH = -(2**61), 2**61


def _orbit(starts: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    """Rows that ``starts`` (a mask) reach by ``pointer``, whose value len(pointer) leads nowhere."""
    n = len(pointer)
    jumps = [np.append(pointer, n).astype(np.int32 if n < 2**31 else np.int64)]
    while (jumps[-1][:-1] < n).any():
        jumps.append(jumps[-1][jumps[-1]])
    reached = np.append(starts, False)
    for jump in reversed(jumps):
        reached[jump[np.flatnonzero(reached[:-1])]] = True
    return reached[:-1]


def _last(pointer: np.ndarray) -> np.ndarray:
    """The last row that each row reaches."""
    n = len(pointer)
    at = np.where(pointer < n, pointer, np.arange(n))
    while True:
        further = at[at]
        if (further == at).all():
            return at
        at = further


def segments(*keys: np.ndarray) -> np.ndarray:
    """Number of each row's segment: the rows, one behind the other, with equal keys."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _ends(segment: np.ndarray) -> np.ndarray:
    """Where each row's segment ends."""
    last = np.flatnonzero(np.append(segment[1:] != segment[:-1], True)) + 1
    return last[segment]


# ---------------------------------------------------------------- overlap removal

def next_kept(segment: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each row the one kept next if it is kept: the first later row of its segment that does not start before its
    end; len(start) where there is none. A row without a start (LOW, first in its segment) is always kept."""
    n = len(start)
    values, place = np.unique(np.concatenate([start, end]), return_inverse=True)
    width = len(values) + 1
    at = np.searchsorted(segment * width + place[:n], segment * width + place[n:], "left")
    follows = np.arange(1, n + 1)
    forced = np.append((start[1:] == LOW) & (segment[1:] == segment[:-1]), False)
    at = np.where(forced, follows, np.maximum(at, follows))
    return np.where(at < _ends(segment), at, n)


def keep(segment: np.ndarray, start: np.ndarray, end: np.ndarray, entry: np.ndarray | None = None) -> np.ndarray:
    """Mask of the rows that stay. ``entry`` holds, per segment, the end of the trip last kept before it (LOW: none)."""
    first = np.append(True, segment[1:] != segment[:-1])[: len(start)]
    pointer = next_kept(segment, start, end)
    if entry is not None and len(start):
        heads = np.flatnonzero(first)
        late = first.copy()
        late[heads] = False
        for head, stop, limit in zip(heads, _ends(segment)[heads], entry):
            at = head if start[head] == LOW else head + int(np.searchsorted(start[head:stop], limit, "left"))
            if at < stop:
                late[at] = True
        first = late
    return _orbit(first, pointer)


def overlap_map(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(limits, exits) of one chunk: an entry up to limits[i], above limits[i - 1], leaves with exits[i], one above all
    limits leaves as it came. Neighbouring pieces of one exit are one."""
    exits = end[_last(next_kept(np.zeros(len(start), np.int64), start, end))]
    limits = start
    if len(start) and start[0] == LOW:
        return np.array([HIGH], np.int64), exits[:1]
    new = np.append(True, start[1:] != start[:-1])  # of equal starts the first is met
    limits, exits = limits[new], exits[new]
    last = np.append(exits[1:] != exits[:-1], True)
    return limits[last], exits[last]


@dataclass
class OverlapState:
    """End of the trip last kept."""

    end: int = LOW

    def follow(self, limits: np.ndarray, exits: np.ndarray) -> None:
        at = int(np.searchsorted(limits, self.end, "left"))
        if at < len(limits):
            self.end = int(exits[at])


# ---------------------------------------------------------------- connection

@dataclass
class Items:
    """Trips in order, with the row that each stands for; ``trips`` of them are taken as one."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    km: np.ndarray
    duration: np.ndarray
    trips: np.ndarray


@dataclass
class Groups:
    """Groups by their first and last row; ``times`` equal ones each. ``km`` of the first one counts on from an entry."""

    first: np.ndarray
    last: np.ndarray
    km: np.ndarray
    duration: np.ndarray
    trips: np.ndarray
    times: np.ndarray


def _copies_a_group(km: float, limit: float, most: int) -> int:
    """How many trips of ``km`` each, up to ``most``, fill a group."""
    total, n = 0.0, 0
    while n < most:
        size = min(most - n, 1 << 16)
        sums = np.add.accumulate(np.append(total, np.full(size, km)))[1:]
        full = int(np.searchsorted(sums, limit, "left"))
        if full < size:
            return n + full + 1
        total, n = float(sums[-1]), n + size
    return most


def expand(start, end, km, duration, copies, gap: int, limit: float) -> tuple[Items, Groups | None]:
    """Items of rows that stand for several equal trips each, and the groups that such rows make by themselves.

    Copies that add no distance stay together. Copies that do not connect with each other are groups of one, but for the
    first and the last. Of copies that do, whole groups from the middle are taken out, which leaves the state behind them as it is: a
    group that began with such a copy ends after a fixed number of them.
    """
    rows = np.arange(len(start))
    many = np.flatnonzero(copies > 1)
    if not len(many):
        return Items(rows, start, end, km, duration, np.ones(len(rows), np.int64)), None
    repeat, taken, scale = np.ones(len(rows), np.int64), np.ones(len(rows), np.int64), np.ones(len(rows), np.int64)
    out = []
    for i in many.tolist():
        n, d = int(copies[i]), float(km[i])
        known = start[i] not in (LOW, HIGH) and end[i] not in (LOW, HIGH)
        if not known or start[i] - end[i] > gap:
            repeat[i] = min(n, 2)
            if n > 2:
                out.append((i, d, int(duration[i]), 1, n - 2))
        elif d == 0:
            scale[i], taken[i] = n, n
        else:
            size = _copies_a_group(d, limit, n)
            whole = max((n - 2 * size) // size, 0)
            repeat[i] = n - whole * size
            if whole:
                out.append((i, float(np.add.accumulate(np.full(size, d))[-1]), size * int(duration[i]), size, whole))
    at = np.repeat(rows, repeat)
    items = Items(at, start[at], end[at], km[at], (duration * scale)[at], taken[at])
    if not out:
        return items, None
    row, d, u, t, times = (np.array(x) for x in zip(*out))
    return items, Groups(row, row, d.astype(np.float64), u, t, times)


def _follows(segment: np.ndarray, start: np.ndarray, end: np.ndarray, gap: int) -> np.ndarray:
    """Whether a row starts within ``gap`` of the end of the row before it, in its segment."""
    near = (segment[1:] == segment[:-1]) & (start[1:] > LOW) & (end[:-1] > LOW) & (start[1:] - end[:-1] <= gap)
    return np.append(False, near)[: len(start)]


def _next_start(stretch: np.ndarray, km: np.ndarray, limit: float) -> np.ndarray:
    """For each item the start of the next group in its stretch if a group starts with it; len(km) where there is none.

    Prefix sums find the place; where they come too near the limit to trust their rounding, the distances are added in
    order, as a fold would.
    """
    n, ends = len(km), _ends(stretch)
    total = np.append(0.0, np.cumsum(km))
    wanted = total[:-1] + limit
    at = np.searchsorted(total, wanted, "left")
    at = np.maximum(at, np.arange(1, n + 1))
    tolerance = 1e-9 * (1 + limit + float(total[-1]))
    near = (np.abs(total[np.minimum(at, n)] - wanted) < tolerance) | (np.abs(total[at - 1] - wanted) < tolerance)
    if (km < 0).any():
        near[:] = True
    for i in np.flatnonzero(near & (ends > np.arange(n) + 1)).tolist():
        at[i] = i + _reach(km[i : int(ends[i])], 0.0, limit)
    return np.where(at < ends, at, n)


def _reach(km: np.ndarray, total: float, limit: float) -> int:
    """How many distances, added to ``total`` in order, reach the limit; all and one more if they do not."""
    size = 64
    while True:
        sums = np.add.accumulate(np.append(total, km[:size]))[1:]
        full = np.flatnonzero(sums >= limit)
        if len(full):
            return int(full[0]) + 1
        if size >= len(km):
            return len(km) + 1
        size *= 8


def connect(segment: np.ndarray, items: Items, gap: int, limit: float, entry: float | None = None) -> Groups:
    """Groups of items; with ``entry`` the first item (of a single segment) joins a group of that distance, and the first
    of the groups returned is the rest of that one."""
    n = len(items.row)
    if not n:
        return Groups(*[np.zeros(0, np.int64)] * 2, np.zeros(0), *[np.zeros(0, np.int64)] * 3)
    starts = ~_follows(segment, items.start, items.end, gap)
    stretch = np.cumsum(starts) - 1
    pointer = _next_start(stretch, items.km, limit)
    km, carried = items.km, np.zeros(0, np.int64)
    if entry is not None:
        size = int(np.searchsorted(stretch, 1, "left"))
        taken = min(_reach(km[:size], entry, limit), size)
        starts[0] = False
        if taken < n:
            starts[taken] = True
        km, carried = np.append(entry, km), np.zeros(1, np.int64)
    begins = _orbit(starts, pointer)
    begins[0] = True
    at, group = np.flatnonzero(begins), np.cumsum(begins) - 1
    last = np.append(at[1:], n) - 1
    sums = np.bincount(np.append(carried, group), km, len(at))  # adds in order
    add = lambda x: np.add.reduceat(x, at)
    return Groups(items.row[at], items.row[last], sums, add(items.duration), add(items.trips), np.ones(len(at), np.int64))


def connect_map(items: Items, gap: int, limit: float) -> dict:
    """The effect of one chunk on the open group.

    ``steps`` are the distances above 0 that a group coming in may take, in order; ``exits[j]`` is the distance of the group
    that is open at the end if the first one to begin here begins behind j of the steps (0: with the first item), -1 if none
    begins. ``through`` is whether a group that takes all steps is still open at the end, ``rest`` else the open one's distance.
    """
    n = len(items.row)
    follows = _follows(np.zeros(n, np.int64), items.start, items.end, gap)
    stretch = np.cumsum(~follows) - 1
    pointer = _next_start(stretch, items.km, limit)
    size = int(np.searchsorted(stretch, 1, "left"))
    taken = min(_reach(items.km[:size], 0.0, limit), size)
    steps = np.flatnonzero(items.km[:taken] != 0)
    begins = np.append(0, steps + 1)
    open_from = _last(pointer)

    def exit_from(i: int) -> float:
        if i >= n:
            return -1.0
        at = int(open_from[i]) if stretch[i] == stretch[-1] else int(open_from[np.searchsorted(stretch, stretch[-1], "left")])
        if at not in sums:
            sums[at] = float(np.add.accumulate(items.km[at:])[-1])
        return sums[at]

    sums: dict[int, float] = {}
    exits = [exit_from(int(i)) for i in begins]
    return {
        "start": int(items.start[0]), "end": int(items.end[-1]), "steps": items.km[steps].tolist(), "exits": exits,
        "through": size == n, "rest": -1.0 if size == n else exit_from(size),
    }


@dataclass
class ConnectState:
    """End of the last trip, distance of the open group and the chunk in which it began."""

    gap: int
    limit: float
    end: int | None = None
    km: float = 0.0
    origin: int = -1

    def joins(self, start: int) -> bool:
        return self.end is not None and self.end > LOW and start > LOW and start - self.end <= self.gap and self.km < self.limit

    def follow(self, chunk: int, m: dict) -> None:
        if not self.joins(m["start"]):
            self.km, self.origin = m["exits"][0], chunk
        else:
            sums = np.add.accumulate(np.append(self.km, m["steps"]))
            full = np.flatnonzero(sums[1:] >= self.limit)
            out = m["exits"][int(full[0]) + 1] if len(full) else -1.0 if m["through"] else m["rest"]
            if out < 0:
                self.km = float(sums[int(full[0]) + 1] if len(full) else sums[-1])
            else:
                self.km, self.origin = out, chunk
        self.end = m["end"]
