"""Exact top-k search by inner product, with an M-tree searched best first.

Metric. Components are floored to integers of 1/256. A vector x of squared length s becomes (x, sqrt(M - s)), M the
largest squared length of all, and a query q becomes (q, 0). Then d(q, x)^2 = M + |q|^2 - 2 <q, x>: the nearest are those
of the highest inner product, and the triangle inequality holds.

Tree. Vectors are dealt to trees by the nearest of ``SEEDS`` vectors (at most; taken by hash), and trees that would be too
large are cut by hash. A task builds one tree: halves by two far members, until a half fits a page, pages of routing
objects above. An entry of a page holds an object, the covering radius of what is below it (0 in a leaf), its distance
to the routing object of its own page, and the page below. Pages are rows of a table in the shared folder.

Search. A queue holds pages by the highest score that their ball allows; the search ends when that is below the k-th
score found. An entry whose stored parent distance already rules it out by the triangle inequality is left out before
its distance is worked out. Every query first searches the tree that holds its own vector, and then, with the k-th
score found there, those trees whose root cannot be ruled out by it. Bounds have a margin for rounding, scores are exact
integers, so the result is exact. Queries and trees meet in blocks of bounded size.

Equal vectors are one object. Its ``k + 1`` least ids are all that can be in any result, and equal queries are searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

K = 5
EVERY = 50     # ids divisible by it are queries
SCALE = 256
SEEDS = 256    # vectors that trees are dealt by, at most
TREE = 8192    # vectors of a tree, about
PAGE = 64      # entries of a page
QUERIES = 2048  # of a block
ROOTS = 4096   # trees of a block
EXACT = float(2**53)  # integers up to here are exact in doubles


class _Space:
    """Objects (rows of integers) under the metric, with the extra component that makes their lengths equal."""

    def __init__(self, vectors: np.ndarray, largest: int):
        self.vectors, self.largest = vectors, float(largest)
        squares = np.einsum("ij,ij->i", vectors, vectors) if len(vectors) else np.zeros(0, np.int64)
        self.extra = np.sqrt(np.maximum(largest - squares, 0).astype(np.float64))

    def distances(self, i: int, rows: np.ndarray) -> np.ndarray:
        gap = (self.vectors[rows] - self.vectors[i]).astype(np.float64)
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (self.extra[rows] - self.extra[i]) ** 2)


def build(vectors: np.ndarray, page: int = PAGE) -> tuple[int, float, int, list[tuple]]:
    """(centre, radius, largest squared length, pages) of the tree over the rows of ``vectors``.

    A page is (number, leaf, objects, radii, parent distances, below); page 0 is the root. Objects are row numbers,
    ``below`` are page numbers, in a leaf the objects themselves. The parent distance of an entry is to the routing object
    of its page, which at the root is the centre.
    """
    largest = int(np.einsum("ij,ij->i", vectors, vectors).max())
    space, pages = _Space(vectors, largest), []

    def halves(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = rows[np.argmax(space.distances(rows[0], rows))]
        other = rows[np.argmax(space.distances(far, rows))]
        order = np.argsort(space.distances(far, rows) - space.distances(other, rows), kind="stable")
        return rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]

    def parts_of(rows: np.ndarray, size: int) -> list[np.ndarray]:
        """Parts of at most ``size`` rows, as few as halving gives, at most a page of them."""
        parts = [rows]
        while len(parts) < page and max(map(len, parts)) > size:
            most = max(range(len(parts)), key=lambda i: len(parts[i]))
            parts[most : most + 1] = halves(parts[most])
        return parts

    def centre(rows: np.ndarray) -> tuple[int, float]:
        """Of the members nearest to the mean, that with the least covering radius."""
        gaps = vectors[rows] - vectors[rows].mean(axis=0)
        near = rows[np.argsort(np.einsum("ij,ij->i", gaps, gaps), kind="stable")[:4]]
        return min(((int(i), float(space.distances(i, rows).max())) for i in near), key=lambda x: x[1])

    def add(rows: np.ndarray, parent: int) -> int:
        number = len(pages)
        pages.append(None)
        if len(rows) <= page:
            pages[number] = (number, True, rows, np.zeros(len(rows)), space.distances(parent, rows), rows)
            return number
        size = page
        while size * page < len(rows):
            size *= page
        parts = parts_of(rows, size)
        routing = [centre(x) for x in parts]
        at = np.array([i for i, _ in routing])
        below = np.array([add(x, i) for x, (i, _) in zip(parts, routing)])
        pages[number] = (number, False, at, np.array([r for _, r in routing]), space.distances(parent, at), below)
        return number

    rows = np.arange(len(vectors))
    root, radius = centre(rows)
    add(rows, root)
    return root, radius, largest, pages


PAGES = (
    "tree string, page long, leaf boolean, objects binary, radii binary, parents binary, below binary, firsts binary, "
    "centre array<long>, radius double, largest long"
)
_PAGE_TYPES = [pa.string(), pa.int64(), pa.bool_(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.float64(), pa.int64()]


def _grid(column: pa.ChunkedArray) -> np.ndarray:
    """Arrays of one size as the rows of a matrix."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1 if len(whole.flatten()) else 0)


def _build_tree(page: int):
    """Task: the objects (id, first, v) of one tree to its pages, in which a leaf names objects by id and first."""
    names = [x.split()[0] for x in PAGES.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        vectors, tree = _grid(table.column("v")), table.column("tree")[0].as_py()
        ids, firsts = table.column("id").to_numpy(), table.column("first").to_numpy()
        root, radius, largest, pages = build(vectors, page)
        rows = []
        for number, leaf, at, radii, parents, below in pages:
            named = (ids[below].tobytes(), firsts[below].tobytes()) if leaf else (below.astype(np.int64).tobytes(), b"")
            top = (vectors[root].tolist(), radius) if number == 0 else (None, None)
            rows.append((tree, number, leaf, vectors[at].tobytes(), radii.tobytes(), parents.tobytes(), *named, *top, largest))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), _PAGE_TYPES)], names=names)

    return run


def _margin(reach: float) -> float:
    """More than rounding can take from a bound: distances err by some 1e-8 of the square root of ``reach`` each."""
    return 4e-7 * reach + 1


class Tree:
    """A tree's pages as read back."""

    def __init__(self, pages: list[dict]):
        root = next(p for p in pages if p["page"] == 0)
        self.centre, self.radius, self.largest = np.array(root["centre"], np.int64), root["radius"], root["largest"]
        dims = len(self.centre)
        self.in_doubles = self.largest < EXACT
        self.pages, self.computed = {}, 0
        for p in pages:
            radii = np.frombuffer(p["radii"])
            objects = np.frombuffer(p["objects"], np.int64).reshape(len(radii), dims)
            self.pages[p["page"]] = (
                p["leaf"], objects.astype(np.float64) if self.in_doubles else objects, radii, np.frombuffer(p["parents"]),
                np.frombuffer(p["below"], np.int64), np.frombuffer(p["firsts"], np.int64),
            )

    def search(self, q: np.ndarray, k: int, floor: int) -> list[tuple[int, int, int]]:
        """(score, first, id) of the ``k`` objects of the highest scores, equal ones by first, among those of ``floor`` at least."""
        squares = int(q @ q)
        reach = float(self.largest) + float(squares)
        margin = _margin(reach)
        query = q.astype(np.float64) if self.in_doubles and squares < EXACT else q
        least, best = floor, []  # a heap of (score, -first, -id), the last on top
        start = max(reach - 2.0 * int(self.centre @ q), 0.0) ** 0.5
        queue = [(-(reach - max(start - self.radius, 0.0) ** 2) / 2 - margin, 0, start)]
        while queue:
            bound, number, distance = heapq.heappop(queue)
            if -bound < least:
                break
            leaf, objects, radii, parents, below, firsts = self.pages[number]
            # the stored distances alone rule out what no computed one has to
            nearest = np.maximum(np.abs(distance - parents) - radii, 0.0)
            may = np.flatnonzero((reach - nearest * nearest) / 2 + margin >= least)
            self.computed += len(may)
            held = objects[may]
            scores = (held @ query).astype(np.int64) if held.dtype == query.dtype else held.astype(np.int64) @ q
            if leaf:
                high = scores >= least
                for found in zip(scores[high].tolist(), (-firsts[may[high]]).tolist(), (-below[may[high]]).tolist()):
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
                if len(best) == k:
                    least = max(least, best[0][0])
                continue
            distances = np.sqrt(np.maximum(reach - 2.0 * scores, 0.0))
            bounds = (reach - np.maximum(distances - radii[may], 0.0) ** 2) / 2 + margin
            for at in np.flatnonzero(bounds >= least):
                heapq.heappush(queue, (-float(bounds[at]), int(below[may[at]]), float(distances[at])))
        return [(s, -f, -i) for s, f, i in best]


LOWEST = -(2**63)
FOUND = "query long, score long, first long, id long"


def _search_tree(k: int):
    """Task: queries (id, v, floor) and the pages of a tree to what they find in it."""
    schema = pa.schema([(x, pa.int64()) for x in ("query", "score", "first", "id")])

    def run(queries: pa.Table, pages: pa.Table) -> pa.Table:
        rows = []
        if queries.num_rows and pages.num_rows:
            tree = Tree(pages.to_pylist())
            vectors = _grid(queries.column("v"))
            for number, q, floor in zip(queries.column("id").to_pylist(), vectors, queries.column("floor").to_pylist()):
                rows += [(number, *x) for x in tree.search(q, k, floor)]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table([pa.array(x, pa.int64()) for x in columns], schema=schema)

    return run


def _trees_to_visit(queries: pa.Table, roots: pa.Table) -> pa.Table:
    """(id, tree) of the trees, other than a query's own, that its floor does not rule out."""
    ids, names = [], []
    if queries.num_rows and roots.num_rows:
        home, floors = np.array(queries.column("home").to_pylist()), queries.column("floor").to_numpy()
        numbers = queries.column("id").to_numpy()
        vectors = _grid(queries.column("v"))
        squares = np.einsum("ij,ij->i", vectors, vectors).astype(np.float64)
        for root in roots.to_pylist():
            reach = squares + float(root["largest"])
            distance = np.sqrt(np.maximum(reach - 2.0 * (vectors @ np.array(root["centre"], np.int64)), 0.0))
            bound = (reach - np.maximum(distance - root["radius"], 0.0) ** 2) / 2 + _margin(reach)
            at = np.flatnonzero((bound >= floors) & (home != root["tree"]))
            ids.append(numbers[at])
            names += [root["tree"]] * len(at)
    return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *ids])), pa.array(names, pa.string())], names=["id", "tree"])


def _nearest_seed(seeds: np.ndarray):
    """Task: (id, first, v) with the number of the nearest of ``seeds``, which only says where a vector is kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = seeds.astype(np.float64)
        lengths = np.einsum("ij,ij->i", points, points)
        for batch in batches:
            near = np.zeros(batch.num_rows, np.int64)
            sizes = batch.column(2).value_lengths().to_numpy()
            fit = np.flatnonzero(sizes == points.shape[1])
            if len(fit):
                vectors = batch.column(2).take(pa.array(fit)).flatten().to_numpy().reshape(len(fit), -1).astype(np.float64)
                near[fit] = np.argmin(lengths[None, :] - 2 * vectors @ points.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], ["id", "first", "v", "seed"])

    return run


def _quantised(table: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, each once."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~odd)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.where(squares < float(2**62)).distinct()


def _spread(rows: DataFrame, name: str, n: int) -> DataFrame:
    """Every row once for each ``name`` from 0 to n - 1."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def nearest(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` highest integer inner products for every row of ``table``
    (vec_id, embedding) whose vec_id is divisible by ``every``, among all rows but its own; equal scores by vec_id.

    A component x counts as floor(256 x). Rows whose vector is null or holds a null or non-finite component take no
    part, and neither do rows without a vec_id or vectors so long (2^31 in length after scaling) that scores might not fit
    a long. Equal rows count once; where rows with different vectors share a vec_id each is searched for and can be found,
    and none of them is a candidate for the others. Vectors of different sizes do not meet; those of size 0 score 0. With fewer
    candidates than ``k`` all are given. Other columns are not read; an empty table gives an empty result.
    """
    rows = materialize(_quantised(table), "vectors")
    # of equal vectors the least ids are all that a result can hold, and they are cut to these before they are shuffled
    least = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    objects = rows.withColumn("_n", least).where(F.col("_n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    objects = objects.select(F.monotonically_increasing_id().alias("id"), F.element_at("ids", 1).alias("first"), "v", "ids")
    objects = materialize(objects, "objects")

    n_trees = -(-objects.count() // TREE) or 1
    seeds = [r[0] for r in objects.orderBy(F.xxhash64("v"), "v").limit(min(n_trees, SEEDS)).select("v").collect()]
    size = max(map(len, seeds), default=0)
    seeds = [s for s in seeds if len(s) == size]
    points = np.array(seeds, np.int64).reshape(len(seeds), size)
    keyed = objects.select("id", "first", "v")
    if len(points) > 1:
        keyed = keyed.mapInArrow(_nearest_seed(points), "id long, first long, v array<long>, seed long")
    else:
        keyed = keyed.withColumn("seed", F.lit(0).cast("long"))
    keyed = materialize(keyed.withColumn("dims", F.size("v")), "seeded")
    cuts = keyed.groupBy("dims", "seed").agg(F.ceil(F.count(F.lit(1)) / TREE).alias("cuts"))
    tree = F.concat_ws("-", "dims", "seed", F.pmod(F.xxhash64("id"), F.col("cuts")))
    placed = materialize(keyed.join(cuts, ["dims", "seed"]).select("id", "first", "v", tree.alias("tree")), "placed")
    pages = materialize(placed.groupBy("tree").applyInArrow(_build_tree(PAGE), PAGES), "pages")

    asked = rows.where(F.col("vec_id") % every == 0).join(objects.select("id", "v"), "v").select(F.col("vec_id").alias("query_id"), "id")
    asked = materialize(asked, "asked")
    queries = materialize(placed.join(asked.select("id").distinct(), "id", "left_semi").select("id", "v", F.col("tree").alias("home")), "queries")

    at_home = queries.select("id", "v", F.col("home").alias("tree"), F.lit(LOWEST).alias("floor"))
    found = at_home.groupBy("tree").cogroup(pages.groupBy("tree")).applyInArrow(_search_tree(k + 1), FOUND)
    found = materialize(found, "home")

    kth = found.groupBy("query").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") > k)
    bounded = queries.join(kth.select(F.col("query").alias("id"), "floor"), "id", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
    roots = pages.where("page = 0").select("tree", "centre", "radius", "largest", F.size("centre").alias("dims"))
    query_blocks, root_blocks = -(-queries.count() // QUERIES) or 1, -(-roots.count() // ROOTS) or 1
    bounded = bounded.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks))).withColumn("dims", F.size("v"))
    bounded = materialize(bounded, "bounded")
    roots = roots.withColumn("root_block", F.pmod(F.xxhash64("tree"), F.lit(root_blocks)))
    block = ["dims", "query_block", "root_block"]
    left = _spread(bounded, "root_block", root_blocks).withColumn("root_block", F.col("root_block").cast("long"))
    right = _spread(roots, "query_block", query_blocks).withColumn("query_block", F.col("query_block").cast("long"))
    visits = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_trees_to_visit, "id long, tree string")
    visits = materialize(visits.join(bounded.select("id", "v", "floor", "query_block"), "id"), "visits")
    met = pages.join(visits.select("tree", F.col("query_block").alias("block")).distinct(), "tree")
    more = visits.groupBy("tree", "query_block").cogroup(met.groupBy("tree", "block")).applyInArrow(_search_tree(k + 1), FOUND)

    better = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "first", "id"))
    best = found.unionByName(more).withColumn("_n", better).where(F.col("_n") <= k + 1)
    listed = best.join(objects.select("id", "ids"), "id").select("query", F.explode("ids").alias("vec_id"), (-F.col("score")).alias("low"))
    listed = listed.groupBy("query").agg(F.array_sort(F.collect_set(F.struct("low", "vec_id"))).alias("near"))
    own = asked.join(listed, asked["id"] == listed["query"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.low")).alias("score"))
