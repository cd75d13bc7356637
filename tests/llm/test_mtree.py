import math
import random

import numpy as np
import pytest

from tripwright.llm import mtree as M
from tripwright.llm import queries

SF = "/root/testdata/sf0.001"


def scaled(embedding):
    if embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
        return None
    return [math.floor(256 * x) for x in embedding]


def brute(rows, k=5, every=50):
    """(query, rank, vec, score) over all pairs of rows (id, embedding)."""
    held = sorted({(i, tuple(v)) for i, e in rows if i is not None and (v := scaled(e)) is not None})
    out = []
    for q, v in held:
        if q % every == 0:
            scores = sorted({(-sum(a * b for a, b in zip(v, w)), c) for c, w in held if c != q and len(w) == len(v)})
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def vectors(seed, n, dims, kinds=40):
    """Clusters, copies of vectors and ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(kinds, dims))
    out = [(centres[rng.integers(kinds)] + rng.normal(scale=rng.choice([0, 0.05, 0.5]), size=dims)).round(2) for _ in range(n)]
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(out)]


SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, tree string, score long"


def table(spark, rows):
    """With columns whose names clash with those in use."""
    return spark.createDataFrame([(i, e, 1, 2, "x", "y", 3) for i, e in rows], SCHEMA)


@pytest.mark.parametrize("tree, page, queries_of_block, roots", [(8192, 64, 2048, 4096), (50, 4, 7, 3)])
def test_trees_of_any_size_against_brute_force(spark, monkeypatch, tree, page, queries_of_block, roots):
    for name, value in (("TREE", tree), ("PAGE", page), ("QUERIES", queries_of_block), ("ROOTS", roots)):
        monkeypatch.setattr(M, name, value)
    rows = vectors(1, 700, 6)
    rows += [(i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(1000, 1300)]  # a group of copies that holds queries
    rows += [(2000 + i, [0.0] * 6) for i in range(60)]
    as_float = [(i, [float(np.float32(x)) for x in e]) for i, e in rows]
    assert got(M.nearest(table(spark, rows))) == brute(as_float)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [1.0, None]), (200, [inf, 1.0]), (None, [1.0, 1.0]),
        (1, [0.5, -0.25]), (2, [0.5, -0.25]), (250, []), (3, []), (300, [1.0, 0.0, 2.0]), (4, [-1.0, -1.0]), (350, [3.0, 0.0]), (350, [0.0, 3.0]),
        (400, [1e30, 0.0]), (5, [0.001, -0.001]),
    ]
    want = [r for r in brute([r for r in rows if r[0] != 400])]
    assert got(M.nearest(table(spark, rows))) == want
    assert any(q == 250 and c == 3 for q, _, c, _ in want) and not any(q == 300 for q, *_ in want)
    empty = table(spark, rows).limit(0)
    assert M.nearest(empty).count() == 0
    assert got(M.nearest(table(spark, [(0, [1.0])]))) == []


def test_large_integers(spark):
    """Lengths beyond what doubles hold exactly."""
    rng = random.Random(4)
    rows = [(i * 10, [float(rng.randrange(-2**18, 2**18)) for _ in range(3)]) for i in range(200)]
    assert got(M.nearest(table(spark, rows))) == brute([(i, [float(np.float32(x)) for x in e]) for i, e in rows])


def test_tree_bounds():
    """Covering radii and parent distances hold, and stored distances spare most computations in clustered data."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 8)) * 400
    data = (centres[rng.integers(60, size=6000)] + rng.normal(size=(6000, 8)) * 6).astype(np.int64)
    data = np.unique(data, axis=0)
    root, radius, largest, pages = M.build(data)
    space, by = M._Space(data, largest), {p[0]: p for p in pages}

    def members(number):
        _, leaf, _, _, _, below = by[number]
        return below if leaf else np.concatenate([members(int(x)) for x in below])

    assert sorted(members(0)) == list(range(len(data)))
    for _, leaf, objects, radii, parents, below in pages:
        assert len(objects) <= M.PAGE
        if not leaf:
            for x, r, page in zip(objects, radii, below):
                assert space.distances(x, members(int(page))).max() <= r + 1e-6
                assert np.allclose(by[int(page)][4], space.distances(x, by[int(page)][2]))
    stored = [dict(page=n, leaf=leaf, objects=data[at].tobytes(), radii=radii.tobytes(), parents=parents.tobytes(), below=below.astype(np.int64).tobytes(),
                   firsts=below.astype(np.int64).tobytes() if leaf else b"", centre=data[root].tolist(), radius=radius, largest=largest)
              for n, leaf, at, radii, parents, below in pages]
    tree = M.Tree(stored)
    for i in range(0, len(data), 97):
        scores = data @ data[i]
        best = np.lexsort((np.arange(len(data)), -scores))[:6]
        assert sorted(tree.search(data[i], 6, M.LOWEST), key=lambda x: (-x[0], x[1])) == [(int(scores[b]), int(b), int(b)) for b in best]
    assert tree.computed < 0.5 * len(data) * len(range(0, len(data), 97))


def test_small_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(queries.op13_nearest_vectors(spark, SF)) == brute(rows)
