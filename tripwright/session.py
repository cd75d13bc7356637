"""Session helpers: configuration for local runs and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tripwright") -> SparkSession:
    """Session for tests and the bench. Cluster jobs get their session from the caller."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must come from the session: executors write there and the driver reads it back, so
    a folder of one machine would lose rows and an unset one raises. Only a local master (one process, as in
    tests and the bench) gets a private folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tripwright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder; what is written there goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripwright-{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the checkpoint folder and return a DataFrame reading it back.

    Cuts the lineage where a plan would otherwise run an expensive upstream more than once (the side
    tables of a scan), and survives executor loss: the files are in the shared folder, not on executors.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
