"""Written intermediate tables.

An intermediate result that is read more than once is written as parquet to the folder the cluster
shares, never kept on one executor: a lost executor then costs a re-read, not a wrong partition id
or a recomputed branch. Columns stay columnar, so later reads prune them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; on a local master without one, a fresh temp folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowmill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """Write df to the shared folder, at most file_rows rows a file if given, and return a plan that reads it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rowmill/{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables this process wrote; call it when no result that reads them is in use."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
