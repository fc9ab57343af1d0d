"""Distributed ranks, running totals and quantiles against the built-in single-task versions."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from staywise.operators.ranking import exact_quantiles, global_ntile, global_rank, running_totals


def values(spark, n, distinct=None, nulls=0.2, seed=1):
    rng = random.Random(seed)
    rows = [
        (f"k{i:05d}", None if rng.random() < nulls else float(rng.randrange(distinct or 10 * n)), float(i % 3))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id string, v double, w double").repartition(7)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 1001])
@pytest.mark.parametrize("distinct", [None, 3])
def test_ntile(spark, n, distinct):
    df = values(spark, n, distinct)
    ours = global_ntile(df, "id", {"a": F.col("v"), "b": F.col("w")}, 5)
    plain = df.select(
        "id",
        F.ntile(5).over(Window.orderBy("v", "id")).alias("a"),
        F.ntile(5).over(Window.orderBy("w", "id")).alias("b"),
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_bucket_sizes_differ_by_at_most_one(spark):
    sizes = [r["count"] for r in global_ntile(values(spark, 503), "id", {"a": F.col("v")}, 5).groupBy("a").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_rank_per_group(spark):
    df = values(spark, 400).withColumn("g", F.col("w").cast("int"))
    ours = global_rank(df, ["g"], ["v", "id"]).select("id", "position", "group_rows")
    plain = df.select(
        "id",
        F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("bigint"),
        F.count("*").over(Window.partitionBy("g")),
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_running_totals(spark):
    df = values(spark, 500, nulls=0).groupBy("w", "v").agg(F.count("*").alias("n"), F.sum(F.lit(2)).alias("m"))
    ours = running_totals(df, ["w"], ["v"], ["n", "m"]).select("w", "v", "n_upto", "m_upto", "n_all")
    by = Window.partitionBy("w")
    plain = df.select(
        "w", "v", F.sum("n").over(by.orderBy("v")), F.sum("m").over(by.orderBy("v")), F.sum("n").over(by)
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_quantiles_equal_numpy(spark):
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for distinct in (None, 5):
        df = values(spark, 333, distinct)
        data = {}
        for r in df.collect():
            if r.v is not None:
                data.setdefault(r.w, []).append(r.v)
        got = exact_quantiles(df, ["w"], "v", shares).collect()
        assert len(got) == 3 * len(shares)
        for r in got:
            assert r["quantile"] == pytest.approx(np.percentile(data[r["w"]], r["share"] * 100))
