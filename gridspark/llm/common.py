"""What the operators of this package share: tables in the shared folder, joins that spread hot keys, id filters."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space and word of the word-based operators.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A table of at most so many rows may be broadcast; the row count is measured first.
BROADCAST_ROWS = 200_000
#: Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where that is unset, and the master is local, a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if own is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="gridspark-"))
    return sc.getCheckpointDir()


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: the lineage ends there, losses of executors do not reach it.

    Shuffle files of the write are released when it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def in_arrow(rows: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` in batches of about BATCH_BYTES.

    By default a task's texts (up to 64 MB) stand at once in the executor's buffers and in its worker, and neither gives all of that
    back. The bound is a session setting, read when the result is written, so it stays; a lower one is left.
    """
    spark = rows.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")
    return rows.mapInArrow(run, schema)


def attach(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, salt_by: list[str], how: str = "inner", small: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``rows`` with ``table`` (one row per key, keys not null); ``weight`` of the table is how many rows have the key.

    A table measured to have at most ``small`` rows is broadcast. Otherwise keys with over 1/256 of all rows (at most 256) are salted on
    both sides, so that no task gets more than that share by one key.
    """
    n, total = table.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if n <= small:
        return rows.join(F.broadcast(table.drop(weight)), keys, how)
    limit = max((total or 0) // 256, 32)
    table = table.withColumn("_salts", F.ceil(F.col(weight) / limit).cast("int")).drop(weight)
    hot = table.filter(F.col("_salts") > 1).select(*keys, "_salts")
    rows = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return rows.join(table, [*keys, "_salt"], how).drop("_salt")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no column that is called so in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def only_ids(docs: DataFrame, ids: DataFrame, id_col: str, keep_them: bool) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids`` (one column of that name), or is not. Null ids are never among them.

    Up to BROADCAST_ROWS * 10 measured ids (16 MB) are broadcast so that texts stay where they are; more are joined by a shuffle.
    """
    kind = "left_semi" if keep_them else "left_anti"
    if ids.count() <= BROADCAST_ROWS * 10:
        ids = F.broadcast(ids)
    return docs.join(ids, id_col, kind)


def fold(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids fall in part -1."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts, F.lit(-1))


def discard(kept: DataFrame) -> None:
    """Delete a table that ``keep`` wrote and nothing needs any more."""
    spark = kept.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(kept.kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
