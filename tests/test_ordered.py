"""Ordered work in two passes equals plain windows, however the rows are dealt."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hertzmill.plans import ordered as O


@pytest.fixture
def spread(spark):
    """Small tables over several partitions: adaptive execution would merge them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def made(spark, n):
    rnd = random.Random(n)
    rows = [(None if i % 40 == 39 else "big" if i % 10 else f"d{i % 70}", i, rnd.choice([None, 1, 2, 7]), rnd.choice([None, None, None, "x", "y"])) for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "doc string, at long, v long, s string")


@pytest.mark.parametrize("n", [0, 1, 400])
def test_scan(spread, n):
    df = made(spread, n)
    w = Window.partitionBy("doc").orderBy("at")
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("total"), F.last("s", True).over(upto).alias("last"), F.last("s", True).over(earlier).alias("before"), F.first("s", True).over(earlier).alias("first"), F.lag("s").over(w).alias("previous"))
    got = O.scan(df, ["doc"], ["at"], sums={"total": F.col("v")}, lasts={"last": F.col("s")}, before={"before": F.col("s")}, firsts={"first": F.col("s")}, previous={"previous": F.col("s")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    if n > 100:
        assert got.select("doc", F.spark_partition_id().alias("p")).where("doc = 'big'").distinct().count() > 1


@pytest.mark.parametrize("n", [0, 1, 300])
def test_numbers_and_next_values(spread, n):
    values = sorted(random.Random(1).sample(range(10**6, 10**6 + 2000), n))
    df = spread.createDataFrame([(v,) for v in random.Random(2).sample(values, n)], "v long")
    assert sorted((r["i"], r["v"]) for r in O.numbered(df, "i", "v").collect()) == list(enumerate(values))
    got = sorted((r["i"], r["v"], r["x"]) for r in O.following(df, "v", "x", "i").collect())
    assert got == [(i, v, values[i + 1] if i + 1 < n else None) for i, v in enumerate(values)]
