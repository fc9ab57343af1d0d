"""Sketches: within the stated error of the exact counts, whatever the parts they are united from."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from staywise.operators import sketches
from staywise.operators.engagement import engagement_columns, engagement_windows

END = date(2024, 1, 31)


def test_estimates_are_within_the_stated_error(spark):
    # The hot key has 40,000 members, spread over 100 days with repeats; the small ones a few.
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.date_sub(F.lit(END), (F.col("id") % 100).cast("int")).alias("d"),
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") % 40).alias("m"),
    )
    daily = sketches.daily_sketches(rows, "k", "d", {"members": "m"}).cache()
    got = {r.k: r for r in sketches.united(daily, "k", END, (7, 30, 99), ["members"]).collect()}
    for days in (7, 30, 99):
        recent = rows.filter(F.col("d") >= END - timedelta(days=days))
        exact = {r.k: r.n for r in recent.groupBy("k").agg(F.countDistinct("m").alias("n")).collect()}
        assert abs(got["hot"][f"members_{days}d"] / exact["hot"] - 1) < 3 * 1.04 / 2 ** (sketches.PRECISION / 2)
        assert all(got[k][f"members_{days}d"] == exact.get(k, 0) for k in got if k != "hot")
    parts = daily.filter("day > '2024-01-10'").unionByName(daily.filter("day <= '2024-01-10'")).repartition(5)
    again = {r.k: r for r in sketches.united(parts, "k", END, (7, 30, 99), ["members"]).collect()}
    assert again == got
    assert sketches.united(daily.limit(0), "k", END, (7,), ["members"]).count() == 0


def test_windows_without_members_need_one_shuffle_less(spark):
    rows = [("a", END, "login", None, None, None), ("a", END - timedelta(9), "content_view", None, 5.0, 3), ("b", END, "feature_usage", "f", None, None)]
    events = spark.createDataFrame(rows, "customer_id string, event_date date, event_type string, feature_name string, duration_minutes double, content_id int")
    full, slim = engagement_windows(events, END, (7, 30)), engagement_windows(events, END, (7, 30), members=False)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (full, slim)]  # not run yet
    assert plans[1].count("Exchange hashpartitioning") < plans[0].count("Exchange hashpartitioning")
    assert "Generate" in plans[0] and "Generate" not in plans[1]
    kept = [c for c in full.columns if not c.startswith(("active_days", "features_used", "unique_content"))]
    assert slim.columns == kept and len(full.columns) == 1 + 2 * len(engagement_columns(7))
    assert sorted(map(tuple, slim.collect())) == sorted(map(tuple, full.select(kept).collect()))
