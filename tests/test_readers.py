"""Numbered lines, quoted fields, inferred types and month files."""

import pytest

from tripwright.operators import validate
from tripwright.operators import ids
from tripwright.schema import OBT_SCHEMA
from tripwright.sinks import write_csv
from tripwright.sources import csv_fields, infer_schema, read_inferred_csv, read_numbered_lines, read_tolerant_csv


@pytest.fixture
def splits(spark):
    """Sets how many bytes a read covers; the old value comes back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], "0")

    yield set_to
    for n, v in old.items():
        spark.conf.set(n, v)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, splits):
    want, number = [], 0
    for f, n in (("a.txt", 3000), ("b.txt", 0), ("c.txt", 1), ("d.txt", 700)):
        lines = [f"{f} line {i} " + "x" * (i % 50) for i in range(n)]
        (tmp_path / f).write_text("".join(x + "\n" for x in lines))
        want += [(x, i + 1, number + i + 1) for i, x in enumerate(lines)]
        number += n
    for size in ("128m", "3k"):
        splits(size)
        rows = read_numbered_lines(spark, str(tmp_path))
        got = sorted(((r.value, r.line_in_file, r.line_no) for r in rows.collect()), key=lambda r: r[2])
        assert got == want
        bad = spark.createDataFrame([(1,), (3000,), (3702,), (9999,)], "no int")
        left = validate.exclude_line_numbers(rows, bad)
        assert left.columns == rows.columns and {r.line_no for r in left.collect()} == set(range(1, number + 1)) - {1, 3000, 3702}
        assert [(r.line_no, r.n_fields) for r in validate.bad_width_rows(rows, 1, number_col="line_no").collect()] == []


def test_fields_in_quotes(spark):
    cases = {
        "a,b": ["a", "b"], "": [""], ",": ["", ""], "a,,": ["a", "", ""], '"a,b",c': ["a,b", "c"], '"a ""b"", c",d': ['a "b", c', "d"],
        '"a"tail,b': ["atail", "b"], 'a "b,c" d': ['a "b', 'c" d'], 'x,"never, closed': ["x", "never, closed"], '"",""': ["", ""], '"",x': ["", "x"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    assert {r.line: list(r.f) for r in df.select("line", csv_fields("line").alias("f")).collect()} == cases


def test_tolerant_read_honours_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"2,3"\n1,2,3\n"4, 5"\n\n"x""y",\n')
    got = sorted((r.a, r.b) for r in read_tolerant_csv(spark, str(tmp_path), ["a", "b"]).collect() if r.b) + [
        (r.a, r.b) for r in read_tolerant_csv(spark, str(tmp_path), ["a", "b"]).collect() if not r.b]
    assert got[0] == ("1", "2,3") and set(got[1:]) == {("4, 5", None), ('x"y', None)}


def test_inferred_types(spark):
    rows = [
        ("veh1", "12", "1.50", "103.25", "2.5", "2022-02-01 08:00:00", "", "7", "1e3", "2022-02-30 00:00:00", "99999999999999999999"),
        ("veh2", "-7", "1.25", "3.00", "1", "2022-02-01T09:00:00.125", None, "x", "2.25", "2022-02-01 00:00:00", "1"),
    ]
    names = ["text", "whole", "fixed", "wider", "number", "time", "nothing", "mixed", "power", "not_a_day", "long_number"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {f.name: f.dataType.simpleString() for f in infer_schema(df.repartition(2))}
    assert got == {
        "text": "string", "whole": "bigint", "fixed": "decimal(5,2)", "wider": "decimal(5,2)", "number": "double", "time": "timestamp_ntz",
        "nothing": "string", "mixed": "string", "power": "double", "not_a_day": "string", "long_number": "double",
    }
    assert {f.dataType.simpleString() for f in infer_schema(df.limit(0))} == {"string"}


def test_inferred_schema_of_the_wide_table(spark, tmp_path):
    from tripwright.plans import catalog

    path = str(tmp_path / "obt")
    write_csv(catalog._obt(spark, "/root/testdata/sf0.001"), path)
    read = read_inferred_csv(spark, path)
    assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in OBT_SCHEMA]


def test_one_split_a_line(spark):
    from tripwright.plans.cleaning import typed_trips
    from tripwright.sources import fixtures

    lines = fixtures.raw_lines(spark, "/root/testdata/sf0.001")
    plan = typed_trips(lines, fixtures.boundary(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_files_of_a_month(spark, tmp_path):
    """A month has about its rows / rows_per_file files, however many tasks and months there are."""
    df = spark.range(0, 20000, 1, 24).selectExpr("id", "case when id % 4 = 0 then '2022-01' else concat('2022-', lpad(cast(2 + id % 9 as string), 2, '0')) end as year_month")
    write_csv(df, str(tmp_path / "m"), partition_by=["year_month"], rows_per_file=1000)
    counts = {r.year_month: r["count"] for r in df.groupBy("year_month").count().collect()}
    for month, n in counts.items():
        files = [f for f in (tmp_path / "m" / f"year_month={month}").iterdir() if f.suffix == ".csv"]
        assert -(-n // 1000) <= len(files) <= 2 * -(-n // 1000), (month, n, len(files))
        assert all(sum(1 for _ in f.open()) <= 1001 for f in files)
    assert spark.read.option("header", True).csv(str(tmp_path / "m")).count() == 20000


def test_equal_rows_are_numbered_in_chunks(spark, monkeypatch):
    from tripwright.operators import copies

    monkeypatch.setattr(copies, "CHUNK", 100)
    df = spark.range(5000).selectExpr("case when id % 5 = 0 then cast(id as string) else 'same' end as k", "1 as x")
    got = ids.dense_ids(df, ["k"], "id").collect()
    assert sorted(r.id for r in got) == list(range(1, 5001))
    assert [r.k for r in sorted(got, key=lambda r: r.id)] == sorted(r.k for r in df.collect())


def test_millions_of_equal_rows(spark):
    """50 million equal rows are numbered without an array of them."""
    df = spark.range(0, 50_000_000, 1, 8).selectExpr("7 as k")
    out = ids.dense_ids(df, ["k"], "id").selectExpr("count(*) as n", "min(id) as low", "max(id) as high", "sum(id) as total").first()
    assert tuple(out) == (50_000_000, 1, 50_000_000, 50_000_000 * 50_000_001 // 2)
