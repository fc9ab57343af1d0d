"""Stored value counts, quarantine, prediction log, faulty text input and the carried serving state against plain versions."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.operators import drift, prediction_log, scoring
from staywise.operators.histograms import HistogramStore
from staywise.plans import frames, queries
from staywise.sources import readers
from staywise.streaming import rolling

DAYS = {"baseline": date(2024, 1, 1), "current": date(2024, 1, 2)}


def test_stored_counts_give_the_drift_of_the_rows(spark, tmp_path):
    rng = random.Random(1)
    sides = {
        side: spark.createDataFrame(
            [(rng.choice([None, *range(9)]), rng.gauss(shift, 2)) for _ in range(300)], "a int, b double"
        )
        for side, shift in (("baseline", 0), ("current", 1))
    }
    store = HistogramStore(str(tmp_path / "h"))
    assert store.days(spark) == set()
    for side, day in DAYS.items():
        for _ in range(2):  # the second replaces the first
            store.put(sides[side], ["a", "b"], day)
    store.put(sides["current"], ["a"], date(2024, 1, 3))
    assert store.days(spark) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    counts, stacked = store.compared(spark, DAYS), drift.stacked_features(sides, ["a", "b"])
    assert sorted(map(tuple, drift.psi_of_counts(counts).collect())) == sorted(map(tuple, drift.psi(stacked).collect()))
    assert sorted(map(tuple, drift.ks_of_counts(counts).collect())) == sorted(map(tuple, drift.ks(stacked).collect()))


def test_drift_reads_stored_partitions_only(spark, folder):
    for name in ("feature_drift_psi", "feature_drift_ks"):
        queries.QUERIES[name](spark, folder).collect()
        files = frames.drift_counts(spark, folder).inputFiles()
        assert files and all("/histograms-" in f and "/day=" in f for f in files)
        assert "lineitem" not in queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_input_state_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    before = readers.input_state(spark, [path])
    assert readers.input_state(spark, [path]) == before
    spark.range(1).write.mode("append").parquet(path)
    assert readers.input_state(spark, [path]) != before


def test_no_row_is_lost_between_scored_and_quarantined(spark, tmp_path):
    names = "customer_id string, recency_30d double, frequency_30d double, monetary_total_30d double, monetary_avg_30d double, engagement_score double, customer_tenure_months int, support_tickets_30d int, age int, value_tier string"
    rows = [("a", 1.0, 1.0, 1.0, 1.0, 0.5, 1, 0, None, "premium"), ("b", -1.0, 1.0, None, 1.0, 1.1, 1, 0, 17, "gold"), (None, 1.0, 1.0, 1.0, 1.0, 1.0, 0, 0, 100, None)]
    inputs = spark.createDataFrame(rows * 2, names)
    path = str(tmp_path / "out")
    out = scoring.scored_or_quarantined(inputs, path, scoring.INPUT_FIELDS, scoring.formula_probability)
    assert out.count() == 6 and out.select("fingerprint").distinct().count() == 3
    good = out.filter("outcome = 'scored'")
    assert [(r.customer_id, r.errors) for r in good.collect()] == [("a", [])] * 2
    assert "PartitionFilters: [isnotnull(outcome" in good._jdf.queryExecution().executedPlan().toString()
    bad = out.filter("outcome = 'quarantined'").collect()
    assert all(r.churn_probability is None and r.risk_level is None and r.errors for r in bad) and len(bad) == 4
    empty = scoring.scored_or_quarantined(inputs.limit(0), f"{path}-none", scoring.INPUT_FIELDS, scoring.formula_probability)
    assert empty.count() == 0


def test_predictions_count_once_their_window_has_closed(spark, tmp_path):
    path, as_of = str(tmp_path / "log"), date(2024, 3, 1)
    closed = as_of - timedelta(days=30)
    rows = [(f"c{i}", i % 2, 0.5, "m1" if i % 3 else "m2", (closed - timedelta(days=i % 10 - 1)).isoformat()) for i in range(60)]
    rows += [("unknown", 1, 0.5, "m1", closed.isoformat())]
    for part in (rows[:20], rows[20:]):
        prediction_log.append(spark.createDataFrame(part, prediction_log.SCHEMA), path)
    labels = {f"c{i}": int(i % 5 == 0) for i in range(60)}
    outcomes = spark.createDataFrame(list(labels.items()), "customer_id string, label int")
    got = {(r.scope, r.day, r.model_version): (r.predictions, r.accuracy) for r in prediction_log.accuracy(prediction_log.read(spark, path), outcomes, as_of, 30).collect()}
    want = {}
    for c, p, _, m, d in rows:
        day = date.fromisoformat(d)
        if c in labels and day <= closed:
            scopes = [("day", d, m)] + [("last 7 days", closed.isoformat(), m)] * (day > closed - timedelta(days=7))
            for scope in scopes:
                want.setdefault(scope, []).append(labels[c] == p)
    assert got == {k: (len(v), pytest.approx(sum(v) / len(v))) for k, v in want.items()}


def test_faulty_lines_are_kept_apart(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType())])
    lines = [
        '{"id": "a", "n": 1, "d": "2024-02-29"}',
        '{"id": "b", "n": 2, "d": "2023-02-29", "new": {"x": [1]}, "other": 5}',
        '{"id": "c", "n": "many", "d": null}',
        '{"id": "d"',
        "",
        "[1, 2]",
        '{"extra": "only"}',
    ]
    path = str(tmp_path / "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = readers.read_rescued(spark, path, schema, dates=["d"]).collect()
    assert len(rows) == len(lines)
    by_id = {r.id: r for r in rows if r.id}
    assert (by_id["a"].outcome, by_id["a"].d, by_id["a"]._extras) == ("ok", date(2024, 2, 29), None)
    assert (by_id["b"].outcome, by_id["b"].d, by_id["b"].bad_dates) == ("bad_date", None, ["d"])
    assert by_id["b"]._extras == {"new": '{"x":[1]}', "other": "5"}
    assert by_id["c"].outcome == "corrupt" and by_id["c"].n is None and by_id["c"]._corrupt == lines[2]
    assert {r._corrupt for r in rows if r.outcome == "corrupt"} >= {lines[2], lines[3], lines[5]}
    assert [r._extras for r in rows if r.outcome == "ok" and not r.id and r._extras] == [{"extra": "only"}]
    plain = readers.read_rescued(spark, path, schema)
    assert plain.filter("id = 'a'").first().d == date(2024, 2, 29) and plain.filter("id = 'b'").first().outcome == "corrupt"


REQUEST = "request_id long, at timestamp, ts timestamp, response_ms double, cache_hit boolean, error boolean"


@pytest.mark.parametrize("parts,buffer", [(1, 10), (4, 10), (7, 1000)])
def test_carried_state_does_not_depend_on_batches(spark, tmp_path, parts, buffer):
    rng = random.Random(parts)
    begin = datetime(2024, 1, 1)
    rows = []
    for i in range(200):
        at = begin + timedelta(seconds=rng.randrange(90))
        rows.append((i, at, at, None if i % 50 == 7 else float(i % 17), i % 3 == 0, i % 7 == 0))
    feed, out = str(tmp_path / "feed"), str(tmp_path / "state")
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], REQUEST).write.mode("append").parquet(feed)
        state = rolling.run(spark.readStream.schema(REQUEST).parquet(feed), out, buffer)
    got = rolling.figures(state).first()
    want = scoring.serving_metrics(spark.createDataFrame(rows, REQUEST), buffer).first()
    assert tuple(got) == tuple(want)
    assert len(state.first().newest) == min(buffer, 200)


def test_a_state_without_requests(spark):
    empty = spark.createDataFrame([], rolling.STATE)
    assert tuple(rolling.figures(empty).first())[:4] == (0, 0.0, 0.0, 0.0)
    after = rolling.advanced(empty, spark.createDataFrame([], REQUEST))
    assert tuple(rolling.figures(after).first())[:4] == (0, 0.0, 0.0, 0.0)
    assert after.select(F.size("newest")).first()[0] == 0
