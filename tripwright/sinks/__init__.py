"""Sinks: CSV and Parquet writers and SQL view registration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_year_month(df: DataFrame, ts_col: str = "START_TIME") -> DataFrame:
    """Adds ``year_month`` = ``yyyy-MM`` of ``ts_col``, the partition column of S10."""
    return df.withColumn("year_month", F.date_format(ts_col, "yyyy-MM"))


#: Rows of a file under a directory partition.
ROWS_PER_FILE = 5_000_000


def _clustered(df: DataFrame, by: list[str], rows_per_file: int) -> DataFrame:
    """``df`` dealt so that the rows of a value of ``by`` are in as many tasks as their number asks for: the rows of each
    value are counted first, and take a salt below the number of files that they fill."""
    files = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    total = files.agg(F.coalesce(F.sum("_files"), F.lit(1)), F.coalesce(F.max("_files"), F.lit(1))).first()
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_row", F.monotonically_increasing_id())
    same = [F.col(f"_by_{c}").eqNullSafe(F.col(c)) for c in by]
    files = files.select("_files", *(F.col(c).alias(f"_by_{c}") for c in by))
    salted = salted.join(files, same).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_files")))
    return salted.repartition(max(min(int(total[0]), most), int(total[1])), *by, "_salt").select(*df.columns)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite", sep: str = ",",
              rows_per_file: int = ROWS_PER_FILE) -> None:
    """CSV with header, one file per partition, written in parallel (S09). ``partition_by`` adds directory
    partitions (S10), whose rows are brought together first: a directory has about its rows / ``rows_per_file`` files of
    that many rows at most, not one of each task."""
    if not partition_by:
        return df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    dealt = _clustered(df, partition_by, rows_per_file)
    dealt.write.mode(mode).option("header", True).option("sep", sep).option("maxRecordsPerFile", rows_per_file).partitionBy(*partition_by).csv(path)


def write_star(tables: dict[str, DataFrame], directory: str, mode: str = "overwrite") -> None:
    """Each table to ``<directory>/<name>.parquet``."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{directory}/{name}.parquet")


def register(tables: dict[str, DataFrame]) -> None:
    """Create or replace one temp view per table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
