from pyspark.sql import Window
from pyspark.sql import functions as F

from tripwright.operators.compare import missing_rows
from tripwright.operators.ids import dense_ids, every_nth, split_halves


def test_dense_ids_equal_row_number(spark):
    df = spark.createDataFrame([(None,)] + [(float((i * 7919) % 1000),) for i in range(1000)], "k double").distinct()
    got = dense_ids(df, ["k"], "id", partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_first())))
    j = got.join(ref, got.k.eqNullSafe(ref.k))
    assert j.filter(F.col("id") != F.col("rn")).count() == 0 and got.count() == ref.count()
    assert got.filter(F.col("k").isNull()).first().id == 1


def test_every_nth_and_halves(spark):
    df = spark.createDataFrame([(f"v{i:02d}",) for i in range(10)] * 2, "v string")
    assert sorted(r.v for r in every_nth(df, "v", 2).collect()) == [f"v{i:02d}" for i in range(1, 10, 2)]
    halves = split_halves(spark.createDataFrame([(i,) for i in range(7)], "k int"), ["k"])
    assert sorted((r.k, r.half) for r in halves.collect()) == [(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 2)]


def test_missing_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "x int, y string")
    right = spark.createDataFrame([(2, None), (3, "c"), (3, "c")], "x int, y string")
    assert sorted(tuple(r) for r in missing_rows(left, right).collect()) == [(1, "a"), (1, "a")]


def test_dense_ids_with_many_ties(spark):
    df = spark.createDataFrame([("hot",)] * 3000 + [(f"k{i:04d}",) for i in range(500)], "k string")
    got = dense_ids(df, ["k"], "id", partitions=8).collect()
    ids = sorted(r.id for r in got)
    assert ids == list(range(1, 3501))
    by_id = sorted(got, key=lambda r: r.id)
    assert [r.k for r in by_id] == sorted(r.k for r in got)


def test_offsets_of_many_partitions(spark):
    """More blocks than one task should sum, some of them missing."""
    from tripwright.operators.prefix import block_offsets

    blocks = spark.range(150_000).where("id % 5 <> 3").selectExpr("id as b", "id % 7 as n", "1 as m")
    got = block_offsets(blocks, "b", "n", "m").toPandas().sort_values("b")
    want = blocks.toPandas().sort_values("b")
    assert (got.before_n.values == (want.n.cumsum() - want.n).values).all()
    assert (got.before_m.values == (want.m.cumsum() - want.m).values).all()


def test_ids_do_not_depend_on_the_order_of_the_input(spark):
    rows = [(i % 7, f"r{i % 40}", None if i % 11 == 0 else i % 3) for i in range(400)]
    runs = []
    for step in (1, 7, 13):
        df = spark.createDataFrame([rows[(i * step) % 400] for i in range(400)], "k int, r string, x int").repartition(step)
        got = dense_ids(df, ["k"], "id", partitions=5).collect()
        assert sorted(r.id for r in got) == list(range(1, 401))
        runs.append(sorted((r.id, r.k, r.r, r.x) for r in [g for g in got if g.x is not None]))
    assert runs[0] == runs[1] == runs[2]
