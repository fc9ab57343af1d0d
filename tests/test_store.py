"""Stored tables: merges that touch only their buckets, versions with validity, results kept across runs, reuse up to expiry."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.operators import reuse, scoring
from staywise.operators.store import KeyedStore, ResultStore

START = date(2024, 1, 1)
SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.DateType()), T.StructField("x", T.LongType())])
ROWS = "id string, day date, x long"


def files(path):
    return {os.path.join(folder, f) for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store = KeyedStore(str(tmp_path / "t"), ("id",), "day", SCHEMA, buckets=8).create(spark)
    assert store.current(spark).count() == 0
    old = spark.createDataFrame([(f"k{i}", START, i) for i in range(200)], ROWS)
    assert store.merge(old) == list(range(8))
    before = files(store.path)
    updates = [("k1", START + timedelta(1), -1), ("k2", START - timedelta(1), -2), ("k3", START, -3), ("new", START, 7)]
    touched = store.merge(spark.createDataFrame(updates, ROWS))
    assert 0 < len(touched) < 8
    after = files(store.path)
    assert {f.split("bucket=")[1].split("/")[0] for f in before ^ after} == {str(b) for b in touched}
    want = {f"k{i}": (START, i) for i in range(200)} | {"k1": (START + timedelta(1), -1), "k3": (START, -3), "new": (START, 7)}
    for _ in range(2):  # merging again changes nothing
        assert {r.id: (r.day, r.x) for r in store.current(spark).collect()} == want
        store.merge(spark.createDataFrame(updates, ROWS))
    assert store.merge(old.limit(0)) == []
    with pytest.raises(ValueError, match="in every row"):
        store.merge(spark.createDataFrame([(None, START, 1)], ROWS))


def test_versions_are_valid_up_to_the_next(spark, tmp_path):
    rng = random.Random(4)
    store = KeyedStore(str(tmp_path / "h"), ("id",), "day", SCHEMA, buckets=4, history=True).create(spark)
    known = {}
    for _ in range(3):
        part = {(rng.choice(["hot", "hot", "a", "b", "c"]), START + timedelta(rng.randrange(40))): rng.randrange(99) for _ in range(25)}
        store.merge(spark.createDataFrame([(k, d, x) for (k, d), x in part.items()], ROWS))
        known |= part
    rows = store.read(spark).collect()
    assert {(r.id, r.day): r.x for r in rows} == known
    for r in rows:
        assert r.valid_to == min((d for k, d in known if k == r.id and d > r.day), default=None)
    assert store.current(spark).count() == len({k for k, _ in known})
    asked = [(i, rng.choice(["hot", "a", "b", "none"]), START + timedelta(rng.randrange(-3, 45))) for i in range(200)]
    got = store.as_of(spark.createDataFrame(asked, "request int, id string, wanted date"), "wanted", ["x"]).collect()
    assert len(got) == 200
    for r in got:
        day = max((d for k, d in known if k == r.id and d <= r.wanted), default=None)
        assert (r.day, r.x) == (day, known.get((r.id, day)))


def test_results_are_reused_across_runs_until_they_expire(spark, tmp_path):
    store = ResultStore(str(tmp_path / "r"), timedelta(hours=1), buckets=4)
    noon = datetime(2024, 1, 1, 23, 30)
    scored = []

    def score(rows):
        rows = rows.withColumn("churn_probability", F.col("v") / F.lit(10.0))
        scored.append({r.v for r in rows.collect()})
        return rows

    def run(minutes, rows):
        now = noon + timedelta(minutes=minutes)
        requests = spark.createDataFrame([(i, v, now - timedelta(seconds=60 - i)) for i, v in rows], "request_id int, v int, ts timestamp")
        return {r.request_id: (r.churn_probability, r.cache_hit) for r in store.answer(requests, ["v"], score, now).collect()}

    assert run(0, [(1, 5), (2, 5), (3, 6)]) == {1: (0.5, False), 2: (0.5, True), 3: (0.6, False)}
    assert run(40, [(1, 5), (2, 7), (3, None)]) == {1: (0.5, True), 2: (0.7, False), 3: (None, False)}
    assert run(70, [(1, 5), (2, 7), (3, 8)]) == {1: (0.5, False), 2: (0.7, True), 3: (0.8, False)}
    assert run(70, [(1, 5), (2, 7), (3, 8)]) == {1: (0.5, True), 2: (0.7, True), 3: (0.8, True)}
    assert scored == [{5, 6}, {None, 7}, {5, 8}, set()]
    assert store.live(spark, noon + timedelta(hours=9)).count() == 0


def plain_misses(rows, life):
    out, made = [], {}
    for key, t in sorted(rows):
        if key not in made or t >= made[key] + life:
            made[key] = t
            out.append((key, t))
    return sorted(out)


LOG = "request_id int, record string, at timestamp"


def test_misses_follow_expiry(spark):
    rng = random.Random(6)
    life = timedelta(hours=1)
    begin = datetime(1969, 12, 31, 12)  # times before 1970 have buckets of their own too
    rows = [(rng.choice(["hot"] * 8 + ["a", "b"]), begin + timedelta(minutes=rng.choice([1, 7, 60]) * rng.randrange(60))) for _ in range(300)]
    rows += [("edge", begin + life * k) for k in range(40)] + [("gap", begin), ("gap", begin + timedelta(days=30)), ("late", begin + life * 3)]
    log = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(rows)] + [(-1, None, begin), (-2, "a", None)], LOG)
    made = reuse.misses(log, "record", "at", life)
    assert sorted((r.record, r.miss_at) for r in made.collect()) == plain_misses(rows, life)
    used = {r.request_id: r.miss_at for r in reuse.served(log, made, "record", "at", life).collect()}
    want = plain_misses(rows, life)
    assert used == {i: max(m for k, m in want if k == key and m <= t) for i, (key, t) in enumerate(rows)}
    assert reuse.misses(log.limit(0), "record", "at", life).count() == 0


@pytest.mark.parametrize("cuts", [(30,), (10, 11, 200)])
def test_misses_do_not_depend_on_how_the_log_is_cut(spark, cuts):
    rng = random.Random(7)
    life = timedelta(minutes=50)
    begin = datetime(2024, 1, 1)
    rows = sorted({(rng.choice("xxxy"), begin + timedelta(minutes=rng.randrange(900))) for _ in range(260)}, key=lambda r: r[1])
    bounds = [0, *cuts, len(rows)]
    known, found = None, []
    for first, last in zip(bounds, bounds[1:], strict=False):
        # A cut never parts equal times.
        log = spark.createDataFrame([(i, *rows[i]) for i in range(first, last)], LOG)
        made = reuse.misses(log, "record", "at", life, known)
        found += [(r.record, r.miss_at) for r in made.collect()]
        newest = {}
        for key, t in found:
            newest[key] = max(t, newest.get(key, t))
        known = spark.createDataFrame(list(newest.items()), "record string, miss_at timestamp")
    assert sorted(found) == plain_misses(rows, life)


def test_fingerprints_of_missing_values_differ_from_empty_ones(spark):
    rows = spark.createDataFrame([(None, "a"), ("", "a")], "x string, y string")
    assert rows.select(scoring.fingerprint(["x", "y"])).distinct().count() == 2


def test_every_customer_seen_in_the_window_gets_todays_version(spark, tmp_path):
    """Not only those seen on the newest day: user 2 was last seen ten days before, user 3 only before the label date."""
    from datetime import date, datetime, timedelta

    from staywise.plans import frames
    from staywise.plans.queries import AS_OF, feature_upsert

    at = lambda day, hours=9: datetime(day.year, day.month, day.day, hours)
    rows = [
        (4, 1, at(AS_OF - timedelta(days=1)), "click"),
        (8, 2, at(AS_OF - timedelta(days=10)), "click"),
        (12, 2, at(frames.LABEL_DATE - timedelta(days=3)), "click"),
        (16, 3, at(frames.LABEL_DATE - timedelta(days=3)), "click"),
    ]
    schema = "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, value double, props string"
    spark.createDataFrame([(*r, 1.0, '{"k": 1}') for r in rows], schema).write.parquet(f"{tmp_path}/events.parquet")
    got = {r.customer_id[-1]: date.fromisoformat(r.version_date) for r in feature_upsert(spark, str(tmp_path)).collect()}
    assert got == {"1": AS_OF, "2": AS_OF, "3": frames.LABEL_DATE}


def test_reuse_of_registered_requests_follows_short_record_numbers(spark, folder, monkeypatch):
    """The rounds carry a number of the record, not its fingerprint."""
    from staywise.plans.queries import score_reuse_ttl

    kinds, found = [], reuse.misses

    def misses(log, *rest):
        kinds.append(dict(log.dtypes))
        return found(log, *rest)

    monkeypatch.setattr(reuse, "misses", misses)
    assert score_reuse_ttl(spark, folder).count()
    assert kinds == [{"request_id": "bigint", "record": "bigint", "ts": "timestamp"}]
