"""One registered query per capability. Each reads whole tables from ``folder`` and returns a DataFrame.

Dates are reported as text and arrays as joined text, so that results compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise import config, schemas
from staywise.functions import rules, scores
from staywise.operators import drift, feature_store, metrics, prediction_log, profile, quality, registry, reuse, scoring, sketches
from staywise.operators.engagement import (
    MEMBERS,
    engagement_columns,
    engagement_windows,
    with_engagement_score,
    with_engagement_windows,
)
from staywise.operators.rfm import rfm_columns, transaction_windows, with_rfm_scores, with_transaction_windows
from staywise.operators.store import KeyedStore, ResultStore
from staywise.plans import features as feature_plans
from staywise.plans import frames
from staywise.session import fresh_path, written
from staywise.sources import adapters, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF = frames.AS_OF


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _baseline():
    return F.lit(config.BASELINE_ACCURACY)


def _text(name: str):
    return F.col(name).cast("string").alias(name)


# ---- inputs and scalar functions -------------------------------------------------------------------------


@query
def customers_adapter(spark: SparkSession, folder: str) -> DataFrame:
    df = adapters.customers(spark, folder)
    return df.select(*[_text(c) if c == "signup_date" else c for c in df.columns])


@query
def ingest_text(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table written as JSON lines with planted faults (cut lines, impossible dates, unknown columns) and read back."""
    number = F.substring("customer_id", 2, 20).cast("bigint")
    df = adapters.customers(spark, folder).withColumns(
        {
            "signup_date": F.when(number % 31 == 0, "2023-02-31").otherwise(F.col("signup_date").cast("string")),
            "campaign": F.when(number % 37 == 0, F.concat(F.lit("c"), (number % 5).cast("string"))),
        }
    )
    line = F.to_json(F.struct(*df.columns))
    path = fresh_path(spark, "lines")
    df.select(F.when(number % 29 == 0, F.substring(line, 1, 18)).otherwise(line)).write.text(path)
    rows = readers.read_rescued(spark, path, schemas.CUSTOMERS, dates=["signup_date"])
    return rows.groupBy("outcome", "city_type", F.col(readers.EXTRAS)["campaign"].alias("campaign")).agg(
        F.count("*").alias("customers"),
        F.count("signup_date").alias("dated"),
        F.sum(F.datediff("signup_date", F.lit(adapters.SIGNUP_START)).cast("bigint")).alias("days"),
        F.max(readers.CORRUPT).alias("line"),
    )


@query
def customer_trend(spark: SparkSession, folder: str) -> DataFrame:
    df = with_transaction_windows(
        adapters.customers(spark, folder), frames.history(spark, folder, days=90, category=False), AS_OF, (30, 90), False
    )
    current, previous = F.col("purchase_frequency_30d"), F.col("purchase_frequency_90d")
    return df.select(
        "customer_id",
        current.alias("current_value"),
        previous.alias("previous_value"),
        scores.customer_trend(current, previous).alias("trend"),
    )


def _clv(spark: SparkSession, folder: str, variant: str) -> DataFrame:
    df = with_transaction_windows(
        adapters.customers(spark, folder), frames.history(spark, folder, category=False), AS_OF, (90, 365), False
    )
    return df.select("customer_id", profile.predicted_clv(variant).alias("predicted_clv"))


@query
def clv_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _clv(spark, folder, "standard")


@query
def clv_scores_v2(spark: SparkSession, folder: str) -> DataFrame:
    return _clv(spark, folder, "simple")


@query
def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    scores.register_sql_functions(spark)
    df = with_engagement_score(frames.windowed(spark, folder, windows=(30, 90, 365)))
    return spark.sql(
        """
        SELECT customer_id,
               calculate_clv_score(monetary_total_365d, monetary_avg_90d, purchase_frequency_90d,
                                   customer_tenure_months) AS predicted_clv,
               calculate_risk_score(recency_365d, purchase_frequency_30d, monetary_total_30d,
                                    engagement_score, support_tickets_30d) AS churn_risk_score,
               determine_customer_trend(purchase_frequency_30d, purchase_frequency_90d) AS trend
        FROM {df}
        """,
        df=df,
    )


@query
def snapshot_features(spark: SparkSession, folder: str) -> DataFrame:
    snapshot = _snapshot(spark, folder).withColumns(profile.snapshot_columns(AS_OF))
    return snapshot.select("customer_id", *profile.snapshot_columns(AS_OF))


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Per-customer totals as a snapshot table would hold them; the last purchase is over the whole history."""
    today = F.lit(AS_OF)
    day, amount = F.col("transaction_date"), F.col("transaction_amount")
    recent = lambda days: (day >= F.date_sub(today, days)) & (day <= today)
    money = lambda days: F.coalesce(F.sum(F.when(recent(days), amount)), F.lit(0)).cast("double")
    totals = (
        adapters.transactions(spark, folder, category=False)
        .groupBy("customer_id")
        .agg(
            F.max(day).alias("last_purchase_date"),
            F.count_if(recent(30)).alias("purchases_30d"),
            F.count_if(recent(90)).alias("purchases_90d"),
            F.count("*").alias("total_orders"),
            F.sum(amount).cast("double").alias("total_revenue"),
            money(30).alias("revenue_30d"),
            money(60).alias("revenue_60d"),
        )
    )
    events = engagement_windows(adapters.engagement(spark, folder), AS_OF, (30,))
    share = lambda column, limit: F.least(F.coalesce(column, F.lit(0)) / float(limit), F.lit(1.0))
    return (
        adapters.customers(spark, folder)
        .select("customer_id")
        .join(totals, "customer_id", "left")
        .join(events, "customer_id", "left")
        .withColumns(
            {
                "login_frequency_30d": share(F.col("login_count_30d"), 30),
                "support_interactions_30d": share(F.col("support_resolved_30d"), 10),
                "feature_usage_score": share(F.col("feature_usage_30d"), 10),
                "community_participation": share(F.col("forum_posts_30d") + F.col("reviews_30d"), 5),
            }
        )
    )


# ---- windowed features -----------------------------------------------------------------------------------


def _rfm_windows(spark: SparkSession, folder: str, diversity: bool) -> DataFrame:
    rows = frames.history(spark, folder, category=diversity)
    return with_transaction_windows(adapters.customers(spark, folder), rows, AS_OF, diversity=diversity)


@query
def rfm_windows(spark: SparkSession, folder: str) -> DataFrame:
    names = [c for w in config.TRANSACTION_WINDOWS for c in rfm_columns(w) if not c.startswith("category_div")]
    return _rfm_windows(spark, folder, diversity=False).select(
        "customer_id",
        *[F.round(c, 4).alias(c) if c.startswith("spending_variance") else c for c in names],
    )


@query
def rfm_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return _rfm_windows(spark, folder, diversity=True).select(
        "customer_id", *[f"category_diversity_{w}d" for w in config.TRANSACTION_WINDOWS]
    )


ENGAGEMENT_DISTINCTS = ("active_days", "features_used", "unique_content")


def _engagement_split(distinct: bool) -> list[str]:
    names = [c for w in config.ENGAGEMENT_WINDOWS for c in engagement_columns(w)]
    return [c for c in names if c.startswith(ENGAGEMENT_DISTINCTS) == distinct]


def _engagement_windows(spark: SparkSession, folder: str) -> DataFrame:
    return with_engagement_windows(adapters.customers(spark, folder), adapters.engagement(spark, folder), AS_OF)


@query
def engagement_windows_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _engagement_windows(spark, folder).select("customer_id", *_engagement_split(False))


QUERIES["engagement_windows"] = QUERIES.pop("engagement_windows_counts")


@query
def engagement_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return _engagement_windows(spark, folder).select("customer_id", *_engagement_split(True))


@query
def rfm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return with_rfm_scores(_thirty_days(spark, folder)).select(
        "customer_id", "recency_score", "frequency_score", "monetary_score", "rfm_score", "customer_segment"
    )


def _thirty_days(spark: SparkSession, folder: str) -> DataFrame:
    return with_transaction_windows(
        adapters.customers(spark, folder), frames.history(spark, folder, days=30, category=False), AS_OF, (30,), False
    )


@query
def customer_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and spend per segment."""
    return (
        with_rfm_scores(_thirty_days(spark, folder))
        .groupBy("customer_segment")
        .agg(
            F.count("*").alias("customers"),
            F.round(F.sum(F.col("monetary_total_30d").cast("decimal(18,4)")).cast("double"), 2).alias("spend_30d"),
            F.min("rfm_score").alias("lowest_score"),
            F.max("rfm_score").alias("highest_score"),
        )
    )


# ---- derived features ------------------------------------------------------------------------------------


@query
def engagement_scores(spark: SparkSession, folder: str) -> DataFrame:
    df = with_engagement_score(
        with_engagement_windows(
            adapters.customers(spark, folder), adapters.engagement(spark, folder), AS_OF, (30,)
        )
    )
    return df.select("customer_id", *config.ENGAGEMENT_WEIGHTS, "engagement_score", "engagement_trend_30_90")


@query
def risk_and_health(spark: SparkSession, folder: str) -> DataFrame:
    df = with_engagement_score(frames.windowed(spark, folder, windows=(30,)))
    return profile.with_risk_and_health(df).select("customer_id", "churn_risk_score", "customer_health_score")


@query
def lifecycle_features(spark: SparkSession, folder: str) -> DataFrame:
    columns = profile.lifecycle_columns(AS_OF)
    return adapters.customers(spark, folder).withColumns(columns).select("customer_id", *columns)


@query
def affinity_features(spark: SparkSession, folder: str) -> DataFrame:
    df = with_transaction_windows(adapters.customers(spark, folder), frames.history(spark, folder), AS_OF, (90, 365))
    columns = profile.affinity_columns()
    return (
        df.withColumns(columns)
        .withColumn("spending_consistency", F.round("spending_consistency", 6))
        .select("customer_id", *columns)
    )


@query
def rfm_distinct_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Category diversity of every window from stored daily sketches."""
    rows = sketches.daily_sketches(
        frames.history(spark, folder), "customer_id", "transaction_date", {"category_diversity": "product_category"}
    )
    daily = written(rows, "sketches")
    return sketches.united(daily, "customer_id", AS_OF, config.TRANSACTION_WINDOWS, ["category_diversity"])


@query
def engagement_distinct_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Active days, used features and seen contents of every window from stored daily sketches."""
    rows = sketches.daily_sketches(adapters.engagement(spark, folder), "customer_id", "event_date", MEMBERS)
    return sketches.united(written(rows, "sketches"), "customer_id", AS_OF, config.ENGAGEMENT_WINDOWS, list(MEMBERS))


@query
def demographic_features(spark: SparkSession, folder: str) -> DataFrame:
    columns = profile.demographic_columns(AS_OF)
    return adapters.customers(spark, folder).withColumns(columns).select("customer_id", *columns)


@query
def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    """The complete feature table."""
    df = feature_plans.feature_table(
        adapters.customers(spark, folder),
        frames.history(spark, folder),
        adapters.engagement(spark, folder),
        AS_OF,
        creation_timestamp=False,
    )
    inexact = {f"spending_variance_{w}d": 4 for w in config.TRANSACTION_WINDOWS} | {"spending_consistency": 6}
    return df.select(
        *[
            F.round(c, inexact[c]).alias(c) if c in inexact else _text(c) if c == "signup_date" else c
            for c in df.columns
        ]
    )


@query
def importance_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule-based importance of every windowed feature, with the number of customers that have a value."""
    df = frames.windowed(spark, folder, windows=(30,), diversity=True)
    names = [*rfm_columns(30), *engagement_columns(30)]
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("filled_rows")) for c in names])
    return counts.select(F.inline(pairs)).withColumn("importance", rules.rule_importance(F.col("feature")))


# ---- feature tables --------------------------------------------------------------------------------------


def _store_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    demographics = adapters.customers(spark, folder).select("customer_id", "age", "city_type", "subscription_tier")
    behavior = engagement_windows(adapters.engagement(spark, folder), AS_OF, (90,))
    spending = _thirty_days(spark, folder).select("customer_id", "frequency_30d", "monetary_total_30d")
    return {"demographics": demographics, "behavior": behavior, "transactions": spending}


def _stored_features(spark: SparkSession, folder: str) -> dict[str, KeyedStore]:
    """The three stored tables of the 30-day features, filled with today's version."""
    today = F.lit(AS_OF).alias("version_date")
    spending = transaction_windows(frames.history(spark, folder, days=30), AS_OF, (30,))
    rows = {
        "demographics": adapters.customers(spark, folder),
        "behavior": engagement_windows(adapters.engagement(spark, folder), AS_OF, (30,)),
        "transactions": spending,
    }
    stores = {}
    for name, described in feature_store.TABLES.items():
        store = KeyedStore(fresh_path(spark, name), described.primary_keys, "version_date", described.schema)
        store.create(spark).merge(described.conform(rows[name].select("*", today)))
        stores[name] = store
    return stores


@query
def feature_table_pk_check(spark: SparkSession, folder: str) -> DataFrame:
    """Key checks of the stored tables themselves."""
    stores = _stored_features(spark, folder)
    return feature_store.key_report({name: (s.current(spark), s.keys) for name, s in stores.items()})


VERSIONED = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("version_date", T.DateType()),
        T.StructField("login_count_30d", T.LongType()),
        T.StructField("content_minutes_30d", T.DoubleType()),
    ]
)


def _behavior_version(spark: SparkSession, folder: str, day) -> DataFrame:
    return engagement_windows(adapters.engagement(spark, folder), day, (30,), members=False).select(
        "customer_id", F.lit(day).alias("version_date"), "login_count_30d", "content_minutes_30d"
    )


@query
def feature_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Behaviour as of the label date, stored; today's version of every customer merged into their buckets."""
    store = KeyedStore(fresh_path(spark, "behavior"), ("customer_id",), "version_date", VERSIONED).create(spark)
    store.merge(_behavior_version(spark, folder, frames.LABEL_DATE))
    store.merge(_behavior_version(spark, folder, AS_OF))
    return store.current(spark).select("customer_id", "login_count_30d", "content_minutes_30d", _text("version_date"))


@query
def feature_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the customers who appear in the request log."""
    tables = _store_tables(spark, folder)
    df = feature_store.looked_up(
        list(tables.values()), "customer_id", adapters.request_log(spark, folder).select("customer_id")
    )
    return df.select(
        "customer_id", "age", "city_type", "subscription_tier", "login_count_90d", "features_used_90d",
        "content_minutes_90d", "frequency_30d", "monetary_total_30d",
    )


DAILY_VERSIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("version_date", T.DateType()),
        T.StructField("events", T.LongType()),
        T.StructField("minutes", T.DoubleType()),
    ]
)


@query
def feature_lookup_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Newest stored daily version on or before each request; versions are merged in two steps, as two days' jobs would."""
    versions = (
        adapters.engagement(spark, folder)
        .groupBy("customer_id", F.col("event_date").alias("version_date"))
        .agg(
            F.count("*").alias("events"),
            F.coalesce(F.sum("duration_minutes"), F.lit(0)).cast("double").alias("minutes"),
        )
    )
    store = KeyedStore(fresh_path(spark, "versions"), ("customer_id",), "version_date", DAILY_VERSIONS, history=True)
    earlier = F.col("version_date") <= F.lit(frames.LABEL_DATE)
    store.create(spark).merge(versions.filter(earlier))
    store.merge(versions.filter(~earlier))
    # The version must be older than the request day itself, or the request would see its own event.
    requests = adapters.request_log(spark, folder).select(
        "request_id", "customer_id", F.date_sub(F.col("ts").cast("date"), 1).alias("known_until")
    )
    df = store.as_of(requests, "known_until", ["events", "minutes"])
    return df.select(
        "request_id", "customer_id", _text("known_until"), _text("version_date"), "events", "minutes"
    )


def _labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring inputs with label and creation date; customers without any tenure have no label yet."""
    return (
        frames.scored_inputs(spark, folder)
        .withColumn(
            "churned", F.when(F.col("customer_tenure_months") > 0, (F.col("probability") > 0.5).cast("int"))
        )
        .withColumn(
            "created_at",
            F.greatest(F.date_sub(F.lit(AS_OF), F.col("recency_30d").cast("int")), F.col("signup_date")),
        )
    )


@query
def extract_recent_labeled(spark: SparkSession, folder: str) -> DataFrame:
    df = feature_store.recent_labelled(_labelled_features(spark, folder), AS_OF)
    return df.select(*[_text(c) if c == "created_at" else c for c in df.columns])


@query
def data_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_summary(adapters.intake(spark, folder), "customer_id")


@query
def data_quality_columns(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_by_column(adapters.intake(spark, folder))


@query
def cardinality_profile(spark: SparkSession, folder: str) -> DataFrame:
    df = adapters.customers(spark, folder).withColumn("age_group", rules.age_group(F.col("age")))
    return quality.cardinality(df, ["customer_name", "city_type", "subscription_tier", "age_group"])


@query
def target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return quality.class_distribution(frames.labelled(spark, folder))


@query
def prepared_data(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared training rows, written as one dated partition and read back through it."""
    df = frames.labelled(spark, folder).select(
        "customer_id", "recency_30d", "frequency_30d", "monetary_total_30d", "engagement_score",
        "customer_tenure_months", "support_tickets_30d", "age", "value_tier", "label", "split",
    )
    path, ds = fresh_path(spark, "prepared"), AS_OF.isoformat()
    sinks.write_partition(df, path, "ds", ds)
    stored = spark.read.schema(f"{_ddl(df)}, ds STRING").parquet(path)
    return stored.filter(F.col("ds") == ds)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


# ---- scoring ---------------------------------------------------------------------------------------------


def _joined_actions():
    return F.array_join("recommended_actions", "; ").alias("recommended_actions")


@query
def validate_inputs(spark: SparkSession, folder: str) -> DataFrame:
    checked = scoring.checked_inputs(adapters.intake(spark, folder).withColumn("row_key", _row_key()))
    return checked.select(
        "row_key", F.array_join("errors", "; ").alias("errors"), "is_valid", "value_tier", "age"
    )


def _row_key():
    return F.md5(
        F.concat_ws(
            "|",
            "customer_id",
            F.col("recency_30d").cast("int").cast("string"),
            F.col("frequency_30d").cast("int").cast("string"),
            F.col("customer_tenure_months").cast("string"),
            F.col("support_tickets_30d").cast("string"),
        )
    )


@query
def score_customers(spark: SparkSession, folder: str) -> DataFrame:
    df = scoring.decided(frames.scored_inputs(spark, folder))
    return df.select(*[_joined_actions() if c == "recommended_actions" else c for c in df.columns])


@query
def score_with_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Unchecked requests validated, scored and stored in one pass, scored and quarantined rows apart."""
    inputs = adapters.intake(spark, folder).select(*scoring.INPUT_FIELDS)
    stored = scoring.scored_or_quarantined(inputs, fresh_path(spark, "scored"), scoring.INPUT_FIELDS, scoring.formula_probability)
    return stored.withColumn("errors", F.array_join("errors", "; "))


@query
def risk_bands4(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("probability")
    return frames.scored_inputs(spark, folder).select(
        "customer_id", F.round(p, 4).alias("churn_probability"), rules.risk_level_four(p).alias("risk_level")
    )


@query
def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.decided(frames.scored_inputs(spark, folder)).select(
        "customer_id", F.size("recommended_actions").alias("action_count"), _joined_actions()
    )


@query
def recommendations_v2(spark: SparkSession, folder: str) -> DataFrame:
    actions = rules.recommended_actions_short(
        F.col("probability"), F.col("engagement_score"), F.col("recency_30d")
    )
    return (
        frames.scored_inputs(spark, folder)
        .withColumn("recommended_actions", actions)
        .select("customer_id", F.size("recommended_actions").alias("action_count"), _joined_actions())
    )


@query
def score_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every request of the log answered, each distinct record scored once."""
    inputs = written(frames.scoring_inputs(spark, folder).select(*scoring.INPUT_FIELDS), "inputs")
    requests = adapters.request_log(spark, folder).select("request_id", "customer_id", "ts")
    answered = scoring.score_once(
        requests.join(inputs, "customer_id"),
        scoring.INPUT_FIELDS,
        lambda rows: rows.select(
            "fingerprint",
            "customer_id",
            "first_request",
            F.round(scoring.formula_probability(), 4).alias("churn_probability"),
        ),
    )
    return answered.select("request_id", "customer_id", "churn_probability", "cache_hit")


REUSE_FOR = timedelta(hours=1)


def _utc(column: str):
    """The stored time as an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(column)))


def _asked(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of known customers with their scoring inputs; ``ts`` as an instant."""
    inputs = written(frames.scoring_inputs(spark, folder).select(*scoring.INPUT_FIELDS), "inputs")
    requests = adapters.request_log(spark, folder).select("request_id", "customer_id", _utc("ts").alias("ts"))
    return requests.join(inputs, "customer_id")


@query
def score_reuse_ttl(spark: SparkSession, folder: str) -> DataFrame:
    """One row per scoring that a result lifetime of one hour asks for, with the requests that its result serves."""
    inputs = frames.scoring_inputs(spark, folder).select(*scoring.INPUT_FIELDS)
    inputs = written(inputs.withColumn("fingerprint", scoring.fingerprint(scoring.INPUT_FIELDS)), "inputs")
    # What travels through every round is a number of the record, a fifth of its fingerprint's length. Written, so that a number stays.
    numbers = inputs.select("fingerprint").distinct().withColumn("record", F.monotonically_increasing_id())
    owners = inputs.join(written(numbers, "numbers"), "fingerprint")
    owners = written(
        owners.select("customer_id", "record", F.round(scoring.formula_probability(), 4).alias("churn_probability")), "owners"
    )
    requests = adapters.request_log(spark, folder).select("request_id", "customer_id", _utc("ts").alias("ts"))
    log = written(requests.join(owners, "customer_id").select("request_id", "record", "ts"), "asked")
    made = written(reuse.misses(log, "record", "ts", REUSE_FOR), "misses")
    served = reuse.served(log, made, "record", "ts", REUSE_FOR)
    used = served.groupBy("record", "miss_at").agg(
        F.count("*").alias("requests"), F.min_by("request_id", F.struct("ts", "request_id")).alias("request_id")
    )
    # A request's own record again, by its id; equal input rows share a record, which stands for them once.
    answered = used.drop("record").join(log.select("request_id", "record"), "request_id")
    return answered.join(owners.dropDuplicates(["record"]), "record").select(
        "request_id",
        "customer_id",
        F.date_format("miss_at", "yyyy-MM-dd HH:mm:ss").alias("scored_at"),
        "requests",
        "churn_probability",
    )


# Runs over one store of results, ten days' lifetime: the third finds results of the second, while those of the first have expired.
RUN_DAYS = (date(2024, 1, 10), date(2024, 1, 18), date(2024, 1, 24))
RESULT_DAYS = 10


@query
def score_store_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Three scoring runs, each over the requests since the run before, with results kept in one store."""
    store = ResultStore(fresh_path(spark, "results"), timedelta(days=RESULT_DAYS))
    asked = written(_asked(spark, folder), "asked")
    day = F.col("ts").cast("date")
    runs, since = None, None
    for until in RUN_DAYS:
        part = asked.filter(day < F.lit(until) if since is None else (day < F.lit(until)) & (day >= F.lit(since)))
        answered = store.answer(
            part,
            scoring.INPUT_FIELDS,
            lambda rows: rows.withColumn("churn_probability", F.round(scoring.formula_probability(), 4)),
            datetime.combine(until, time()),
        )
        answered = answered.select(
            F.lit(until.isoformat()).alias("run"), "request_id", "customer_id", "churn_probability", "cache_hit"
        )
        runs, since = answered if runs is None else runs.unionByName(answered), until
    return runs


@query
def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.decided(frames.scored_inputs(spark, folder))
    return scoring.batch_summary(scored)


@query
def score_summary_by_tier(spark: SparkSession, folder: str) -> DataFrame:
    """The batch summary per subscription tier with the total under 'all'."""
    inputs = frames.scored_inputs(spark, folder)
    scored = scoring.decided(inputs, keep=["subscription_tier"])
    return scoring.batch_summary(scored, ["subscription_tier"]).fillna("all", ["subscription_tier"])


@query
def serving_metrics(spark: SparkSession, folder: str) -> DataFrame:
    df = scoring.serving_metrics(adapters.request_log(spark, folder))
    return df.withColumn("last_prediction", F.date_format("last_prediction", "yyyy-MM-dd HH:mm:ss"))


# ---- evaluation ------------------------------------------------------------------------------------------


@query
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_counts(frames.candidate_rows(spark, folder), ["model"])


@query
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_scores(frames.candidate_rows(spark, folder), ["model"])


@query
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.class_report(frames.candidate_rows(spark, folder), ["model"])


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.roc_auc(frames.candidate_rows(spark, folder), ["model"])


@query
def overfit_gaps(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.candidate_rows(spark, folder).filter(F.col("split") != "test")
    return metrics.overfit_gaps(rows, ["model"])


@query
def business_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.business_metrics(frames.candidate_rows(spark, folder), ["model"])


@query
def cv_stability(spark: SparkSession, folder: str) -> DataFrame:
    """Stability over 5 and over 10 hash folds."""
    rows = frames.candidate_rows(spark, folder)
    folds = F.array(
        *[
            F.struct(F.lit(k).alias("k"), rules.hash_fold(F.col("customer_id"), config.SPLIT_SEED, k).alias("fold"))
            for k in (5, 10)
        ]
    )
    return metrics.fold_stability(rows.select("*", F.inline(folds)), "fold", ["model", "k"])


@query
def live_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions logged in the last 7 days against what happened, per day."""
    log = (
        adapters.request_log(spark, folder)
        .select("customer_id", F.col("ts").cast("date").alias("day"))
        .filter(F.col("day") >= F.date_sub(F.lit(AS_OF), 7))
    )
    outcomes = frames.labelled(spark, folder).select("customer_id", "label", "prediction")
    return (
        log.join(outcomes, "customer_id")
        .groupBy("day")
        .agg(
            F.count("*").alias("predictions"),
            (F.count_if(F.col("label") == F.col("prediction")).cast("double") / F.count("*")).alias("accuracy"),
        )
        .select(_text("day"), "predictions", "accuracy")
    )


@query
def live_accuracy_logged(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of logged predictions per closed day and over the newest seven; predictions of three days are still open."""
    day = F.date_sub(F.date_add(F.lit(frames.LABEL_DATE), 3), (F.substring("customer_id", 2, 20).cast("bigint") % 12).cast("int"))
    known = written(frames.labelled(spark, folder).select("customer_id", "prediction", "probability", "label"), "predicted")
    path = fresh_path(spark, "log")
    made = known.select("customer_id", "prediction", "probability", F.lit(config.MODEL_VERSION).alias("model_version"), day.alias("day"))
    # Two runs of the scoring job, one after the other.
    for part in (F.col("day") <= F.lit(frames.LABEL_DATE), F.col("day") > F.lit(frames.LABEL_DATE)):
        prediction_log.append(made.filter(part).withColumn("day", F.col("day").cast("string")), path)
    return prediction_log.accuracy(prediction_log.read(spark, path), known, AS_OF, frames.OUTCOME_DAYS)


# ---- drift, gates, registry ------------------------------------------------------------------------------


def _accuracy_by_tier(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.classification_scores(frames.labelled(spark, folder), ["subscription_tier"]).select(
        "subscription_tier", "n", F.col("accuracy").alias("current_accuracy")
    )


@query
def performance_drift(spark: SparkSession, folder: str) -> DataFrame:
    return _accuracy_by_tier(spark, folder).select(
        "subscription_tier",
        "n",
        "current_accuracy",
        _baseline().alias("baseline_accuracy"),
        drift.performance_drift(F.col("current_accuracy"), _baseline()).alias("performance_drift"),
    )


@query
def feature_drift_psi(spark: SparkSession, folder: str) -> DataFrame:
    return drift.psi_of_counts(frames.drift_counts(spark, folder))


@query
def feature_drift_ks(spark: SparkSession, folder: str) -> DataFrame:
    return drift.ks_of_counts(frames.drift_counts(spark, folder))


@query
def drift_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return drift.drift_alerts(drift.psi_of_counts(frames.drift_counts(spark, folder)), "psi")


@query
def retrain_decision(spark: SparkSession, folder: str) -> DataFrame:
    """Decision per subscription tier; the data drift is the largest KS gap of any feature."""
    worst = drift.ks_of_counts(frames.drift_counts(spark, folder)).agg(F.max("ks").alias("drift_score"))
    rows = _accuracy_by_tier(spark, folder).withColumn("baseline_accuracy", _baseline())
    # One row per tier next to a single value.
    joined = rows.withColumn("_one", F.lit(1)).join(F.broadcast(worst.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return drift.retrain_decision(joined)


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    prepared = written(frames.candidate_rows(spark, folder), "predictions")
    rows = prepared.filter(F.col("split") == "test")
    scores_by_model = metrics.classification_scores(rows, ["model"]).select("model", "n", "accuracy")
    joined = scores_by_model.join(metrics.roc_auc(rows, ["model"]), "model")
    joined = joined.join(prepared.groupBy("model").agg(F.count("*").alias("samples")), "model")
    return drift.candidate_validation(joined.withColumn("baseline_accuracy", _baseline()))


@query
def candidate_validation(spark: SparkSession, folder: str) -> DataFrame:
    checked = _validated(spark, folder).drop("samples")
    return checked.withColumn("rejection_reasons", F.array_join("rejection_reasons", "; "))


@query
def model_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Registry rows of all candidates, written to the registry table and read back with the current version."""
    rows = registry.registry_rows(_validated(spark, folder), AS_OF.isoformat(), "samples")
    path = fresh_path(spark, "registry")
    registry.append_rows(rows, path)
    return registry.with_current(spark.read.schema(rows.schema).parquet(path))


@query
def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    rows = frames.candidate_rows(spark, folder).filter(F.col("split") == "val")
    board = metrics.classification_scores(rows, ["model"]).select(
        "model", F.col("accuracy").alias("val_accuracy")
    )
    return metrics.leaderboard(board, frames.CANDIDATES)


@query
def ab_compare(spark: SparkSession, folder: str) -> DataFrame:
    """Two hash arms, conversion = a purchase in the 30 days after the label date."""
    bought = frames.buyers_after(spark, folder, frames.LABEL_DATE, 30).withColumn("bought", F.lit(True))
    arms = adapters.customers(spark, folder).select(
        "customer_id", rules.hash_split(F.col("customer_id"), 7, (("A", 0.5), ("B", 0.5))).alias("arm")
    )
    joined = arms.join(bought, "customer_id", "left").withColumn("bought", rules.flag(F.col("bought")))
    return drift.ab_compare(joined, "arm", "bought")


@query
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return frames.labelled(spark, folder).select("customer_id", "label", "split")
