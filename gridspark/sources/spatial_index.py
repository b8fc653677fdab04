"""Tables laid out by place: box and cell columns, rows sorted by cell, so that a scan leaves out what is elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.cells import BOX, INDEX_COLUMNS, cell_columns
from gridspark.functions.geo import geometry_box, resolve_geometry
from gridspark.sources.staging import counted, spread, staged

#: Rows of a file and bytes of a row group (compressed rows of a group share one entry of least and greatest values).
ROWS_PER_FILE = 2_000_000
ROW_GROUP_BYTES = 8 << 20


def with_cells(df: DataFrame) -> DataFrame:
    """Add the index columns; rows without a usable geometry have nulls there. Geometry text is read once per row."""
    if "lon" in df.columns and "lat" in df.columns:
        at = {"_west": F.col("lon"), "_east": F.col("lon"), "_south": F.col("lat"), "_north": F.col("lat")}
        boxed = df.withColumns({n: c.cast("double") for n, c in at.items()})
    else:
        boxed = df.withColumn("_box", geometry_box(resolve_geometry(df)))
        boxed = boxed.withColumns({n: F.col("_box")[i] for i, n in enumerate(BOX)}).drop("_box")
    return boxed.withColumns(cell_columns(*[F.col(n) for n in BOX]))


def write_indexed(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, row_group_bytes: int = ROW_GROUP_BYTES, mode: str = "errorifexists") -> None:
    """Write a table sorted by level and cell. Rows of one crowded cell are dealt over files by a hash of the row.

    Geometry text is read by all tasks that run at once, and once only: the ranges of several files are found from boxes written before.
    """
    taken = [c for c in INDEX_COLUMNS if c in df.columns]
    if taken:
        raise ValueError(f"columns are named like index columns: {taken}")
    count, tasks = counted(df)
    files = max(1, -(-count // rows_per_file))
    rows = with_cells(spread(df, count, tasks))
    if files > 1:
        rows = staged(rows, "cells")
    dealt = F.xxhash64(*[F.col(n) for n in BOX], F.monotonically_increasing_id())
    rows = rows.withColumn("_spread", dealt).repartitionByRange(files, "_level", "_z", "_spread").sortWithinPartitions("_level", "_z").drop("_spread")
    # A page is read or left out as a whole as well: small ones, by their own least and greatest values.
    rows.write.mode(mode).option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", 5000).parquet(path)
