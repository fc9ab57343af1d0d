"""Lifetime value, risk, trend and rule labels at every boundary."""

import itertools

import pytest
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules, scores


def expected_clv(revenue, order_value, frequency, tenure):
    if not revenue or not tenure:
        return 0.0
    order_value = order_value or 0
    tier = 1.5 if order_value > 500 else 1.2 if order_value > 200 else 1.0 if order_value > 50 else 0.8
    return revenue / max(tenure, 1) * min(tenure * 1.2, 60) * min((frequency or 0) * 2, 3) * tier


def expected_risk(recency, frequency, monetary, engagement, tickets):
    total = 0.3 if (recency or 0) > 90 else 0.2 if (recency or 0) > 60 else 0.1 if (recency or 0) > 30 else 0.0
    if frequency:
        total += 0.25 if frequency < 0.1 else 0.15 if frequency < 0.2 else 0.0
    if monetary and monetary < 100:
        total += 0.2
    if engagement and engagement < 0.3:
        total += 0.15
    if tickets and tickets > 10:
        total += 0.1
    return min(total, 1.0)


def expected_trend(current, previous, threshold=0.1):
    if not current or not previous:
        return "unknown"
    change = (current - previous) / previous
    return "improving" if change > threshold else "declining" if change < -threshold else "stable"


CLV_GRID = list(
    itertools.product(
        [None, 0.0, -10.0, 1200.0], [None, 0.0, 50.0, 50.01, 200.0, 200.5, 500.0, 501.0], [None, 0.0, 0.1, 1.5, 9.0],
        [None, 0, 1, 50, 51],
    )
)
RISK_GRID = list(
    itertools.product(
        [None, 0.0, 30.0, 30.5, 60.0, 61.0, 90.0, 91.0], [None, 0.0, 0.05, 0.1, 0.15, 0.2], [None, 0.0, -5.0, 99.9, 100.0],
        [None, 0.0, 0.29, 0.3], [None, 0.0, 10.0, 11.0],
    )
)
TREND_GRID = list(itertools.product([None, 0.0, 0.5, 0.89, 0.9, 1.0, 1.1, 1.2, -1.0], [None, 0.0, 1.0, -2.0]))


def test_clv(spark):
    df = spark.createDataFrame(CLV_GRID, "r double, a double, f double, t int")
    scores.register_sql_functions(spark)
    rows = df.select(
        "*",
        scores.clv_score(F.col("r"), F.col("a"), F.col("f"), F.col("t")).alias("column"),
        F.expr("calculate_clv_score(r, a, f, t)").alias("sql"),
    ).collect()
    for row in rows:
        assert row["column"] == pytest.approx(expected_clv(row.r, row.a, row.f, row.t), rel=1e-12)
        assert row["sql"] == row["column"]


def test_clv_simple_variant(spark):
    df = spark.createDataFrame(
        [(1200.0, 50.0, 0.5, 10), (1200.0, 49.9, 0.5, 10), (1200.0, 600.0, 5.0, 0), (None, 60.0, 1.0, 5)],
        "r double, a double, f double, t int",
    )
    values = [
        r[0]
        for r in df.select(scores.clv_score(F.col("r"), F.col("a"), F.col("f"), F.col("t"), "simple")).collect()
    ]
    assert values == [pytest.approx(1440.0), pytest.approx(1152.0), 0.0, None]


def test_risk(spark):
    df = spark.createDataFrame(RISK_GRID, "r double, f double, m double, e double, t double")
    scores.register_sql_functions(spark)
    columns = [F.col(c) for c in "rfmet"]
    rows = df.select(
        "*", scores.risk_score(*columns).alias("column"), F.expr("calculate_risk_score(r, f, m, e, t)").alias("sql")
    ).collect()
    for row in rows:
        assert row["column"] == pytest.approx(expected_risk(row.r, row.f, row.m, row.e, row.t), abs=1e-12)
        assert row["sql"] == row["column"] and 0 <= row["column"] <= 1


def test_trend(spark):
    df = spark.createDataFrame(TREND_GRID, "c double, p double")
    scores.register_sql_functions(spark)
    rows = df.select(
        "*",
        scores.customer_trend(F.col("c"), F.col("p")).alias("column"),
        F.expr("determine_customer_trend(c, p)").alias("sql"),
        F.expr("determine_customer_trend(c, p, 0.3)").alias("wide"),
    ).collect()
    for row in rows:
        assert row["column"] == row["sql"] == expected_trend(row.c, row.p)
        assert row["wide"] == expected_trend(row.c, row.p, 0.3)


def test_scores_need_no_python_stage(spark):
    df = spark.range(10).select(scores.risk_score(*[F.col("id")] * 5), scores.customer_trend(F.col("id"), F.col("id")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def labels(spark, column, values, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def test_segments(spark):
    for floor, label in config.SEGMENT_FLOORS:
        assert labels(spark, rules.customer_segment, [floor], "int") == [label]
    assert labels(spark, rules.customer_segment, [554, 453, 343, 122, 111], "int") == [
        "Loyal Customers", "Potential Loyalists", "New Customers", "Lost", "Lost",
    ]


def test_risk_levels(spark):
    values = [0.4, 0.41, 0.5, 0.6, 0.61, 0.7, 0.71, 0.8, 0.81]
    assert labels(spark, rules.risk_level, values) == ["LOW"] + ["MEDIUM"] * 5 + ["HIGH"] * 3
    assert labels(spark, rules.risk_level_four, values) == ["LOW"] + ["MEDIUM"] * 3 + ["HIGH"] * 4 + ["CRITICAL"]


def test_limits(spark):
    assert labels(spark, rules.lifecycle_stage, [30, 31, 180, 181, 365, 366, None], "int") == [
        "new", "growing", "growing", "mature", "mature", "veteran", "veteran",
    ]
    assert labels(spark, rules.age_group, [24, 25, 34, 35, 49, 50, None], "int") == [
        "young_adult", "millennial", "millennial", "gen_x", "gen_x", "baby_boomer", "baby_boomer",
    ]
    assert labels(spark, rules.value_tier, [200.0, 200.1, 1000.0, 1000.1, 5000.0, 5000.1, None]) == [
        "low_value", "medium_value", "medium_value", "high_value", "high_value", "premium", "low_value",
    ]


def test_importance(spark):
    names = ["rfm_score", "predicted_clv", "engagement_score", "churn_risk_score", "frequency_30d", "monetary_avg_7d",
             "recency_30d", "age"]
    assert labels(spark, rules.rule_importance, names, "string") == [0.9, 0.9, 0.8, 0.8, 0.7, 0.7, 0.6, 0.4]


def test_actions(spark):
    rows = [
        (0.71, 0.2, 61.0, 6, 0.0, "low_value"),
        (0.71, 0.3, 60.0, 5, 0.0, "premium"),
        (0.7, 0.2, 61.0, 6, 1.0, "premium"),
        (0.41, 0.9, 0.0, 0, 2.0, "low_value"),
        (0.4, 0.1, 99.0, 9, 0.0, "premium"),
    ]
    df = spark.createDataFrame(rows, "p double, e double, r double, t int, f double, tier string")
    long = [
        r[0]
        for r in df.select(rules.recommended_actions(*[F.col(c) for c in ("p", "e", "r", "t", "f", "tier")])).collect()
    ]
    assert [len(a) for a in long] == [6, 0, 4, 2, 2]
    assert long[2][-1] == "VIP customer engagement program" and long[4][0] == "Continue standard engagement"
    short = [r[0] for r in df.select(rules.recommended_actions_short(F.col("p"), F.col("e"), F.col("r"))).collect()]
    assert [len(a) for a in short] == [4, 0, 2, 0, 0]
