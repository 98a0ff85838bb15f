"""Cutting lineage through the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where none is set and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='emberline-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Rows of a short table (keys, links) that one task may take.
ROWS = 100_000


def parts(rows: int) -> int:
    """Into how many partitions so many short rows go."""
    return max(4, -(-rows // ROWS))


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once and read from there by all that follows."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a Parquet table in the shared folder: smaller, for many rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Deletes a table of ``written`` that nothing will read again; results made from it must be written by then."""
    files = table.inputFiles()
    if files:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
