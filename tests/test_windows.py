"""The single-pass windows equal one plain aggregate per window, on edge rows and under heavy skew."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staywise import config
from staywise.operators.engagement import engagement_columns, engagement_windows, with_engagement_score
from staywise.operators.rfm import rfm_columns, transaction_windows, with_transaction_windows

AS_OF = date(2024, 1, 31)
TX = "customer_id string, transaction_date date, transaction_amount decimal(12,2), product_category string"
EV = (
    "customer_id string, event_date date, event_type string, feature_name string, duration_minutes decimal(12,2),"
    " content_id int"
)


def day(age):
    return AS_OF - timedelta(days=age)


def transactions(spark):
    rng = random.Random(3)
    rows = [("edge", day(a), Decimal("10.00"), f"p{a}") for w in config.TRANSACTION_WINDOWS for a in (0, w, w + 1, -1)]
    rows += [("single", day(5), Decimal("7.50"), "x"), ("unpriced", day(5), None, "x"), ("unpriced", day(80), None, None)]
    rows += [("half", day(20), None, "x"), ("half", day(3), None, "x"), ("flat", day(9), Decimal("0.10"), "x")]
    rows += [("flat", day(a), Decimal("0.10"), "y") for a in (40, 60, 61, 300)]
    rows += [("old", day(400), Decimal("1.00"), "x")]
    # One customer owns a third of all rows.
    rows += [("hot", day(rng.randrange(0, 380)), Decimal(rng.randrange(1, 99999)) / 100, f"c{rng.randrange(40)}") for _ in range(700)]
    rows += [
        (f"n{rng.randrange(60)}", day(rng.randrange(0, 380)), Decimal(rng.randrange(-500, 99999)) / 100, f"c{rng.randrange(9)}")
        for _ in range(1400)
    ]
    return spark.createDataFrame(rows, TX)


def plain_window(tx, days):
    end = F.lit(AS_OF)
    date_, amount = F.col("transaction_date"), F.col("transaction_amount")
    inside = tx.filter((date_ >= F.date_sub(end, days)) & (date_ <= end))
    newer = F.when(date_ >= F.date_sub(end, days // 2), amount).otherwise(0)
    values = [
        F.datediff(end, F.max(date_)), F.count("*"), F.sum(amount), F.avg(amount.cast("double")), F.countDistinct("product_category"),
        F.stddev("transaction_amount"), F.count("*") / F.lit(days), F.sum(newer),
    ]
    return inside.groupBy("customer_id").agg(*[v.alias(n) for v, n in zip(values, rfm_columns(days), strict=True)])


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return float(a) == pytest.approx(float(b), rel=1e-9, abs=1e-9)


def test_transaction_windows_equal_plain_aggregates(spark):
    tx = transactions(spark)
    ours = {r["customer_id"]: r.asDict() for r in transaction_windows(tx, AS_OF).collect()}
    assert "old" not in ours
    for days in config.TRANSACTION_WINDOWS:
        plain = {r["customer_id"]: r.asDict() for r in plain_window(tx, days).collect()}
        for customer, row in ours.items():
            for name in rfm_columns(days):
                expected = plain.get(customer, {}).get(name)
                assert close(row[name], expected), (customer, name, row[name], expected)


@pytest.mark.parametrize("age", (1, 60))
@pytest.mark.parametrize(
    "low, high, spread", (("1000000.00", "1000000.50", 0.35355339), ("1000.0000", "1000.0010", 0.00070711), ("0.1", "0.1", 0.0))
)
def test_a_small_spread_is_not_lost(spark, low, high, spread, age):
    """Both amounts in one band, or in two; equal amounts have exactly none."""
    tx = spark.createDataFrame(
        [("a", day(1), Decimal(low), "x"), ("a", day(age), Decimal(high), "x")],
        "customer_id string, transaction_date date, transaction_amount decimal(16,4), product_category string"
    )
    got = transaction_windows(tx, AS_OF).first()["spending_variance_90d"]
    assert got == pytest.approx(spread, abs=1e-8) and (got == 0) == (low == high)


def test_windows_nest_and_every_customer_has_one_row(spark):
    tx = transactions(spark)
    customers = tx.select("customer_id").distinct()
    rows = with_transaction_windows(customers, tx, AS_OF).collect()
    assert len(rows) == customers.count()
    for r in rows:
        counts = [r[f"frequency_{w}d"] or 0 for w in config.TRANSACTION_WINDOWS]
        assert counts == sorted(counts)


def events(spark):
    rng = random.Random(5)
    kinds = [
        "login", "feature_usage", "support_ticket", "support_resolution", "forum_post", "review_submission",
        "content_view", "other",
    ]
    rows = []
    for i in range(2400):
        who = "hot" if i % 3 == 0 else f"n{rng.randrange(40)}"
        kind = rng.choice(kinds)
        rows.append(
            (
                who, day(rng.randrange(-2, 100)), kind,
                f"f{rng.randrange(12)}" if kind == "feature_usage" and rng.random() > 0.1 else None,
                Decimal(rng.randrange(1, 9000)) / 100 if kind == "content_view" else None,
                rng.randrange(500) if kind == "content_view" else None,
            )
        )
    rows += [("edge", day(a), "login", None, None, None) for a in (7, 8, 30, 31, 90, 91, -1)]
    return spark.createDataFrame(rows, EV)


def plain_engagement(ev, days):
    end, kind = F.lit(AS_OF), F.col("event_type")
    inside = ev.filter((F.col("event_date") >= F.date_sub(end, days)) & (F.col("event_date") <= end))
    count = lambda name: F.sum(F.when(kind == name, 1).otherwise(0))
    unique = lambda name, column: F.countDistinct(F.when(kind == name, F.col(column)))
    values = [
        count("login"), unique("login", "event_date"), count("feature_usage"), unique("feature_usage", "feature_name"),
        count("support_ticket"), count("support_resolution"), count("forum_post"), count("review_submission"),
        F.sum(F.when(kind == "content_view", F.col("duration_minutes")).otherwise(0)), unique("content_view", "content_id"),
    ]
    return inside.groupBy("customer_id").agg(*[v.alias(n) for v, n in zip(values, engagement_columns(days), strict=True)])


def test_engagement_windows_equal_plain_aggregates(spark):
    ev = events(spark)
    ours = {r["customer_id"]: r.asDict() for r in engagement_windows(ev, AS_OF).collect()}
    for days in config.ENGAGEMENT_WINDOWS:
        plain = {r["customer_id"]: r.asDict() for r in plain_engagement(ev, days).collect()}
        for customer, row in ours.items():
            for name in engagement_columns(days):
                assert close(row[name], plain.get(customer, {}).get(name)), (customer, name)


def test_engagement_score_bounds_and_defaults(spark):
    names = engagement_columns(30)
    full = [float(v) for v in (90, 30, 50, 40, 2, 9, 9, 9, 9000, 9)]
    unsolved = [float(v) for v in (0, 0, 0, 0, 4, 1, 0, 0, 0, 0)]
    df = spark.createDataFrame(
        [("none", *[None] * 10), ("full", *full), ("open", *unsolved)],
        "customer_id string, " + ", ".join(f"{n} double" for n in names),
    )
    rows = {r["customer_id"]: r for r in with_engagement_score(df).collect()}
    assert rows["none"]["engagement_score"] == pytest.approx(0.1)
    assert rows["full"]["engagement_score"] == pytest.approx(1.0)
    assert rows["open"]["support_engagement"] == 0.25
    assert rows["none"]["engagement_trend_30_90"] == "improving"
