"""Small files with long work: rows are dealt over tasks, and geometry is worked out once when an index is written."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import geo
from gridspark.operators.query import query
from gridspark.sources.spatial_index import write_indexed
from gridspark.sources.staging import ROWS_PER_TASK, counted, spread


def test_rows_in_one_task_are_dealt_out(spark):
    rows = spark.range(5 * ROWS_PER_TASK, numPartitions=1)
    assert counted(rows) == (5 * ROWS_PER_TASK, 1)
    dealt = spread(rows)
    assert counted(dealt) == (5 * ROWS_PER_TASK, 4)
    assert dealt.agg(F.sum("id"), F.count_distinct("id")).first() == rows.agg(F.sum("id"), F.count_distinct("id")).first()
    # Few rows, rows in enough tasks and no rows stay where they are.
    for same in (spark.range(10, numPartitions=1), spark.range(5 * ROWS_PER_TASK, numPartitions=6), spark.range(0)):
        assert spread(same) is same


def test_an_index_reads_its_geometry_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def shape(i):
        read.add(1)
        return None if i % 10 == 0 else '{"type":"Point","coordinates":[%r,%r]}' % (i % 300 / 100 - 1.5, i // 300 / 100 + 50)

    df = spark.range(3000, numPartitions=1).select("id", shape("id").alias("geo_shape"))
    path = f"{tmp_path}/points"
    write_indexed(df, path, rows_per_file=500)
    assert read.value == 3000
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.where("_z is null").count() == 300
    bounds = dict(north=50.0505, south=50.0, east=0.2005, west=-0.5005)
    want = {i for i in range(3000) if i % 10 and -0.5005 <= i % 300 / 100 - 1.5 <= 0.2005 and i // 300 / 100 <= 0.0505}
    assert {r.id for r in query(back, select="id", polygon=geo.bounds_ring(**bounds)).collect()} == want
