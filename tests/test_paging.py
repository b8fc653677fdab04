"""Pages at any depth against a plain sort."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gridspark.operators import query as qy
from gridspark.operators.paging import PageIndex, page_after


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = [(i, rng.choice([None, "a", "b", "bb", "c" * 300]), rng.choice([None, 1.5, 2.5, float("nan"), -0.0]), {"k": i % 3}) for i in range(900)]
    out += [(5000, "crowd", 7.0, {"k": 1})] * 700  # equal rows
    rng.shuffle(out)
    return spark.createDataFrame(out, "id long, name string, v double, m map<string,int>").repartition(7)


def plain(df):
    return [(r["id"], r["name"], repr(r["v"]), tuple(r["m"].items())) for r in df.collect()]


@pytest.mark.parametrize("order_by", ["name", "-name", "name desc, v", "-v, id", "id"])
def test_pages_of_an_order(rows, order_by):
    names = [p.strip().split()[0].lstrip("-") for p in order_by.split(",")]
    order = [F.col(n).desc() if f"-{n}" in order_by or f"{n} desc" in order_by else F.col(n) for n in names]
    want = plain(rows.orderBy(*order, *[F.col(c) for c in ("id", "name", "v") if c not in names]))
    index = PageIndex(rows, order_by, [c for c in ("id", "name", "v") if c not in names], small=50, ranges=6)
    assert index.total == 1600
    for offset, limit in [(0, 10), (0, None), (3, 5), (799, 20), (800, None), (1599, 5), (1600, 5), (2000, None), (650, 900)]:
        got = plain(index.page(offset, limit))
        end = 1600 if limit is None else offset + limit
        assert [g[:3] for g in got] == [w[:3] for w in want[offset:end]], (offset, limit)


def test_pages_without_an_order_neither_overlap_nor_miss_rows(rows):
    index = PageIndex(rows, small=40, ranges=5)
    found = [r for p in index.pages(333) for r in plain(p)]
    assert sorted(map(str, found)) == sorted(map(str, plain(rows)))
    assert [len(plain(p)) for p in index.pages(333)] == [333, 333, 333, 333, 268]


def test_offset_without_a_limit_is_spread_over_tasks(spark):
    df = spark.range(400_000).withColumn("v", F.col("id") % 1000)
    out = qy.page(df, "-v", offset=200_000, tiebreak=["id"])
    plan = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "CollectLimit" not in plan and "SinglePartition" not in plan.split("TakeOrderedAndProject")[0]
    got = [r["id"] for r in out.collect()]
    want = sorted(range(400_000), key=lambda i: (-(i % 1000), i))[200_000:]
    assert got == want
    deep = qy.page(df, "v", limit=10, offset=300_000, tiebreak=["id"])
    assert [r["id"] for r in deep.collect()] == sorted(range(400_000), key=lambda i: (i % 1000, i))[300_000:300_010]
    assert qy.page(df, offset=150_000).count() == 250_000


def test_range_borders_reach_the_scan(spark, tmp_path):
    spark.range(0, 1000, 1, 4).write.parquet(f"{tmp_path}/t")
    index = PageIndex(spark.read.parquet(f"{tmp_path}/t"), "id", small=20, ranges=8)
    plan = index.page(500, 100)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan


def test_page_after_a_row(rows):
    want = rows.dropDuplicates(["id", "name"]).orderBy(F.col("name").desc(), "id").select("name", "id").collect()
    got, after = [], ("zz", 0)
    while True:
        page = page_after(rows.dropDuplicates(["id", "name"]).select("name", "id"), "-name", after, 97, ["id"]).collect()
        if not page:
            break
        got += page
        after = tuple(page[-1])
    assert got == want
    with pytest.raises(ValueError):
        page_after(rows, "name", ("a",), 5, ["id"])


def test_empty_table(rows):
    index = PageIndex(rows.where("false"), "name")
    assert index.total == 0 and index.page(0, 5).collect() == [] and index.page(7).collect() == []
