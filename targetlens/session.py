"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cpus: str | int = "*", app: str = "targetlens") -> SparkSession:
    """Session for one machine; on a cluster the submitter's session is used as it is."""
    cores = os.cpu_count() if str(cpus) == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; on one machine a new one when it is unset."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return context.getCheckpointDir().rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder under the shared one, for streams and intermediate tables."""
    return f"{_shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, with another ``schema`` of the same storage if given.

    The table outlives lost executors, and its file sizes tell Spark which joins may broadcast.
    """
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)
