"""Order-dependent per-vehicle operators: overlap removal (D01) and trip connection (D02), plus the distance /
duration enrichment between them. The pairwise connection (D03) is in ``pairs``.

D01 and D02 are greedy folds (the state after a dropped trip differs from the state after a kept one), so they cannot be
written as ``lag`` or a running max. Here is how they run, whatever the vehicles' sizes:

1. Exact copies of a trip are counted (combined before their shuffle), and the rows are sorted by (vehicle, trip
   order) with a range exchange: partitions of like size, in which a vehicle may go on from one to the next.
2. Each partition folds the vehicles that lie wholly within it, with array kernels over all of them (``folds``), and
   writes the result. Rows of the vehicles at its two ends are written as they are, as a chunk each, together with the
   chunk's map from the state at its entry to the state at its exit.
3. The maps of a vehicle are followed in order, which gives every chunk its entry state; one value of state goes from
   chunk to chunk, and a map has a piece for each different exit.
4. Chunks are folded from their entry states, each in a task of its own choosing: one exchange, of these rows only. A
   group of D02 that goes over several chunks comes out in pieces, at most two a chunk, which are put together.

So a vehicle with a third of all trips, or one day of it, is spread over as many tasks as its share of the rows.
"""

from __future__ import annotations

import json
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.geo import haversine_km
from ..functions.timefmt import duration_s
from ..schema import CLEAN_COLUMNS, CONNECT_GAP_S, CONNECT_MAX_KM, ENRICHED_COLUMNS, TRIP_ORDER
from ..session import materialize
from .copies import repeat_rows
from .pairs import connect_pairs  # noqa: F401 - the third of the per-vehicle operators

def add_distance_duration(df: DataFrame) -> DataFrame:
    """``distance`` (haversine km, F02) and ``duration_s`` (F03) as JVM column math."""
    return df.withColumn(
        "distance", haversine_km("LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_END", "LONGITUDE_END")
    ).withColumn("duration_s", duration_s("START_TIME", "END_TIME"))


# ---------------------------------------------------------------- folds

# kinds of rows that the tasks write
_DONE, _ROW, _MAP, _ENTRY, _PIECE = range(5)
_EXTRA = StructType([
    StructField("_kind", IntegerType()), StructField("_n", LongType()), StructField("_trips", LongType()), StructField("_c", LongType()),
    StructField("_map", BinaryType()), StructField("_end", LongType()), StructField("_km", DoubleType()),
    StructField("_origin", LongType()), StructField("_joins", BooleanType()),
])
_LAST_COLUMNS = ["END_TIME", "LATITUDE_END", "LONGITUDE_END"]


class _Fold:
    """What a task does with sorted rows. ``overlap`` and ``connect`` say which of the folds apply."""

    def __init__(self, schema: StructType, overlap: bool, connect: bool, gap_s: float, max_km: float):
        self.schema, self.overlap, self.connect = schema, overlap, connect
        self.gap, self.limit = int(round(gap_s * 1_000_000)), float(max_km)

    # ---- rows as arrays

    def arrays(self, table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        from . import folds

        def longs(name, missing):
            return pc.fill_null(pc.cast(table.column(name), pa.int64()), missing).to_numpy()

        vehicle = pc.fill_null(table.column("VEHICLE_ID").combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        start, end = longs("START_TIME", folds.LOW), longs("END_TIME", folds.LOW)
        copies = longs("_n", 1)
        if not self.connect:
            return vehicle, start, end, copies, None, None
        km = np.nan_to_num(pc.fill_null(table.column("distance"), 0.0).to_numpy().astype(np.float64))
        return vehicle, start, end, copies, km, longs("duration_s", 0)

    def output(self, table, **columns):
        """``table`` under the schema, with ``columns`` (arrays or single values) put in; extra ones else missing."""
        import pyarrow as pa

        extra = {"_kind": pa.int32(), "_map": pa.binary(), "_km": pa.float64(), "_joins": pa.bool_()}
        names, out = self.schema.fieldNames(), []
        for name in names:
            kind = extra.get(name, pa.int64()) if name.startswith("_") else table.schema.field(name).type
            value = columns.get(name, None if name.startswith("_") else table.column(name))
            if value is None or isinstance(value, (bool, int, bytes)):
                value = [value] * table.num_rows
            out.append(value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value, kind))
        return pa.table(out, names=names).to_batches(max_chunksize=65536)

    def groups(self, table, groups, kind, **columns):
        """A row per group: the first trip with the last one's end."""
        import pyarrow as pa

        first, last = table.take(pa.array(groups.first)), table.take(pa.array(groups.last))
        ends = {c: last.column(c).combine_chunks() for c in _LAST_COLUMNS}
        return self.output(first, _kind=kind, _n=groups.times, _trips=groups.trips, distance=groups.km, duration_s=groups.duration, **ends, **columns)

    def kept(self, table, arrays, entry=None):
        """Rows and arrays that overlap removal leaves. Copies of a trip that lasts overlap each other, so one stays."""
        import numpy as np
        import pyarrow as pa

        from . import folds

        vehicle, start, end, copies, km, duration = arrays
        stay = np.flatnonzero(folds.keep(folds.segments(vehicle), start, end, entry))
        lasting = (end > start) & (start > folds.LOW)
        copies = np.where(lasting, 1, copies)
        pick = lambda x: None if x is None else x[stay]
        return table.take(pa.array(stay)), tuple(pick(x) for x in (vehicle, start, end, copies, km, duration))

    def whole(self, table):
        """Vehicles of which all rows are here."""
        from . import folds

        if not table.num_rows:
            return
        arrays = self.arrays(table)
        if self.overlap:
            table, arrays = self.kept(table, arrays)
        if not self.connect:
            yield from self.output(table, _kind=_DONE, _n=arrays[3])
            return
        vehicle, start, end, copies, km, duration = arrays
        items, more = folds.expand(start, end, km, duration, copies, self.gap, self.limit)
        found = folds.connect(folds.segments(vehicle[items.row]), items, self.gap, self.limit)
        yield from self.groups(table, found, _DONE)
        if more is not None:
            yield from self.groups(table, more, _DONE)

    # ---- the tasks

    def chunk(self, table, number):
        """Rows of a vehicle that may go on elsewhere, and their map of the first fold."""
        import pyarrow as pa

        from . import folds

        if not table.num_rows:
            return
        vehicle, start, end, copies, km, duration = self.arrays(table)
        yield from self.output(table, _kind=_ROW, _n=copies, _c=number)
        if self.overlap:
            limits, exits = folds.overlap_map(start, end)
            found = {"limits": limits.tolist(), "exits": exits.tolist()}
        else:
            items, _ = folds.expand(start, end, km, duration, copies, self.gap, self.limit)
            found = folds.connect_map(items, self.gap, self.limit)
        yield from self.output(table.slice(0, 1), _kind=_MAP, _c=number, _map=json.dumps(found).encode())

    def partition(self, batches):
        """Task of a sorted partition: vehicles within it are folded, those at its ends become chunks."""
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from . import folds

        number = 2 * TaskContext.get().partitionId()
        held, at_first = [], True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held and held[-1].column("VEHICLE_ID")[-1].as_py() == table.column("VEHICLE_ID")[-1].as_py():
                held.append(table)
                continue
            table = pa.concat_tables([*held, table])
            code = folds.segments(self.arrays(table)[0])
            cut = int(np.searchsorted(code, code[-1], "left"))
            held, table = [table.slice(cut)], table.slice(0, cut)
            if at_first and cut:
                first = int(np.searchsorted(code[:cut], 1, "left"))
                yield from self.chunk(table.slice(0, first), number)
                table, at_first = table.slice(first), False
            yield from self.whole(table)
        if held:
            yield from self.chunk(pa.concat_tables(held), number + (not at_first))

    def entries(self, batches):
        """Task that follows each vehicle's maps in order and gives every chunk the state at its entry."""
        import pyarrow as pa

        from . import folds

        names, state = ["_c", "_end", "_km", "_origin", "_joins"], None
        new = (lambda: folds.OverlapState()) if self.overlap else (lambda: folds.ConnectState(self.gap, self.limit))
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
        vehicle = object()
        for batch in batches:
            rows = []
            for v, c, m in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if v != vehicle:
                    vehicle, state = v, new()
                m = json.loads(m)
                if self.overlap:
                    rows.append((c, state.end, None, None, None))
                    state.follow(m["limits"], m["exits"])
                else:
                    rows.append((c, None, state.km, state.origin, state.joins(m["start"])))
                    state.follow(c, m)
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names)

    def resolved(self, batches):
        """Task of whole chunks, each behind its entry state."""
        import pyarrow as pa

        held, number = [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            chunks = table.column("_c").to_numpy()
            at = 0
            while at < len(chunks):
                stop = at + int((chunks[at:] == chunks[at]).argmin() or len(chunks) - at)
                if chunks[at] != number and held:
                    yield from self.resolve(pa.concat_tables(held))
                    held = []
                held.append(table.slice(at, stop - at))
                number, at = chunks[at], stop
        if held:
            yield from self.resolve(pa.concat_tables(held))

    def resolve(self, table):
        import numpy as np
        import pyarrow as pa

        from . import folds

        entry, table = table.slice(0, 1).to_pylist()[0], table.slice(1)
        arrays = self.arrays(table)
        number = entry["_c"]
        if self.overlap:
            table, arrays = self.kept(table, arrays, [entry["_end"]])
            if self.connect and table.num_rows:  # connection has maps of its own
                yield from replace_overlap(self).chunk(table.set_column(table.schema.get_field_index("_n"), "_n", pa.array(arrays[3])), number)
            elif not self.connect:
                yield from self.output(table, _kind=_DONE, _n=arrays[3])
            return
        _, start, end, copies, km, duration = arrays
        items, more = folds.expand(start, end, km, duration, copies, self.gap, self.limit)
        joins = entry["_joins"]
        found = folds.connect(np.zeros(len(items.row), np.int64), items, self.gap, self.limit, entry["_km"] if joins else None)
        n = len(found.first)
        part = lambda a, b: folds.Groups(*(getattr(found, x)[a:b] for x in ("first", "last", "km", "duration", "trips", "times")))
        # the first group may have begun before, the last may go on
        first, last = int(bool(joins)), max(n - 1, int(bool(joins)))
        if joins:
            yield from self.groups(table, part(0, 1), _PIECE, _c=number, _origin=entry["_origin"])
        yield from self.groups(table, part(first, last), _DONE)
        yield from self.groups(table, part(last, n), _PIECE, _c=number, _origin=number)
        if more is not None:
            yield from self.groups(table, more, _DONE)


def replace_overlap(fold: _Fold) -> _Fold:
    """The connection alone."""
    return _Fold(fold.schema, False, True, fold.gap / 1_000_000, fold.limit)


def _resolved(fold: _Fold, chunks: DataFrame) -> DataFrame:
    """Chunk rows folded from the entry states that their maps give."""
    order = ["_c", F.col("_kind").desc(), *TRIP_ORDER]  # the entry comes first
    maps = chunks.where(F.col("_kind") == _MAP).select("VEHICLE_ID", "_c", "_map")
    maps = maps.repartition("VEHICLE_ID").sortWithinPartitions("VEHICLE_ID", "_c")
    entries = maps.mapInArrow(fold.entries, "_c long, _end long, _km double, _origin long, _joins boolean")
    rows = chunks.where(F.col("_kind") == _ROW)
    rows = rows.drop("_end", "_km", "_origin", "_joins").unionByName(entries.withColumn("_kind", F.lit(_ENTRY)), allowMissingColumns=True)
    return rows.repartition("_c").sortWithinPartitions(*order).mapInArrow(fold.resolved, fold.schema)


def _joined_pieces(pieces: DataFrame, columns: list[str]) -> DataFrame:
    """Groups from their pieces: the first trip of the first, the end and the distance so far of the last."""
    heads = [c for c in columns if c not in (*_LAST_COLUMNS, "distance", "duration_s")]
    one = pieces.groupBy("_origin").agg(
        F.min_by(F.struct(*heads), "_c").alias("a"), F.max_by(F.struct(*_LAST_COLUMNS, "distance"), "_c").alias("z"),
        F.sum("duration_s").alias("duration_s"), F.sum("_trips").alias("_trips"))
    place = {**{c: f"a.{c}" for c in heads}, **{c: f"z.{c}" for c in (*_LAST_COLUMNS, "distance")}, "duration_s": "duration_s"}
    return one.select(*(F.col(place[c]).alias(c) for c in columns), "_trips")


def _run_fold(df: DataFrame, out_cols: list[str], overlap: bool, connect: bool, gap_s: float = CONNECT_GAP_S,
              max_km: float = CONNECT_MAX_KM, count_col: str | None = None, partitions: int | None = None) -> DataFrame:
    rows = df.select(*out_cols).groupBy(*out_cols).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(c).asc_nulls_first() for c in ["VEHICLE_ID", *TRIP_ORDER]]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    fold = _Fold(StructType([df.schema[c] for c in out_cols] + _EXTRA.fields), overlap, connect, gap_s, max_km)
    written = materialize(ranged.sortWithinPartitions(*order).mapInArrow(fold.partition, fold.schema), "fold")
    done = [written.where(F.col("_kind") == _DONE)]
    chunks = written.where(F.col("_kind") > _DONE)
    if overlap and connect:
        chunks, fold = materialize(_resolved(fold, chunks), "chunks"), replace_overlap(fold)
    last = _resolved(fold, chunks)
    counts = [F.col("_trips").alias(count_col)] if count_col else []
    if connect:
        last = materialize(last, "groups") if count_col else last
        pieces = last.where(F.col("_kind") == _PIECE)
        done.append(_joined_pieces(pieces, out_cols).withColumn("_n", F.lit(1).cast("long")))
        last = last.where(F.col("_kind") == _DONE)
    done.append(last)
    out = None
    for part in done:
        part = part.select(*out_cols, "_n", "_trips")
        out = part if out is None else out.unionByName(part)
    return repeat_rows(out, "_n").select(*out_cols, *counts)


def remove_overlaps(df: DataFrame, bucket_s: int | None = None, partitions: int | None = None) -> DataFrame:
    """D01. Per vehicle in (start, end, request id, ...) order keep the first trip; drop a trip iff the
    last kept trip ends after it starts. Touching trips are kept. Rows without a vehicle form one sequence; a trip without
    a start comes first and stays, and a trip without an end overlaps nothing.

    ``partitions`` sets the number of range partitions (by default the session's). Rows are divided by their number, so
    ``bucket_s``, the length of a time bucket in earlier versions, has no effect.
    """
    cols = [c for c in df.columns if c in set(CLEAN_COLUMNS) | {"distance", "duration_s"}]
    return _run_fold(df, cols, True, False, partitions=partitions)


def connect_trips(df: DataFrame, gap_s: float = CONNECT_GAP_S, max_km: float = CONNECT_MAX_KM,
                  bucket_s: int | None = None, partitions: int | None = None) -> DataFrame:
    """D02 on enriched trips (needs ``distance`` and ``duration_s``; a missing one counts as 0)."""
    return _run_fold(df, ENRICHED_COLUMNS, False, True, gap_s, max_km, partitions=partitions)


def remove_overlaps_and_connect(df: DataFrame, gap_s: float = CONNECT_GAP_S, max_km: float = CONNECT_MAX_KM,
                                bucket_s: int | None = None, count_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """D01 then D02 over one sort of the trips. ``count_col`` adds the number of trips in each group, whose sum is what
    D01 kept. Distance and duration are computed before the fold, as JVM column math."""
    return _run_fold(df, ENRICHED_COLUMNS, True, True, gap_s, max_km, count_col, partitions)
