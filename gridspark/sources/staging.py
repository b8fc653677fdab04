"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are worth a task of their own.
ROWS_PER_TASK = 10_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where that is unset, and the master is local, one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if own is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="gridspark-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: later steps do not work it out again, and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame) -> tuple[int, int]:
    """Rows of a frame, and in how many tasks they come."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()


def spread(df: DataFrame, rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """The rows over as many tasks as run at once, where they come in fewer: a small file may hold long work.

    ``rows`` and ``tasks`` are those of :func:`counted`, where they are known.
    """
    if rows is None or tasks is None:
        rows, tasks = counted(df)
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return df.repartition(wanted) if tasks < wanted else df
