"""Bulk scoring: input checks, decisions, risk levels, actions, result reuse, summaries and serving metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise import config
from staywise.functions import rules

INPUT_FIELDS = ("customer_id", *config.SCORING_RANGES, "value_tier")


def formula_probability() -> Column:
    """Fixed churn formula on recency, frequency and engagement, held inside [0, 1]."""
    raw = "(recency_30d / 100D) * 0.3D + (1D / (frequency_30d + 1D)) * 0.3D + (1D - engagement_score) * 0.4D"
    return F.expr(f"least(greatest({raw}, 0D), 1D)")


def checked_inputs(inputs: DataFrame) -> DataFrame:
    """Adds ``errors`` (array), ``is_valid``, the normalised ``value_tier`` and the default age.

    Bad rows stay in the table, so that callers can send them to quarantine instead of losing them.
    """
    problems = [F.when(F.col("customer_id").isNull(), F.lit("customer_id: missing"))]
    for name, (low, high) in config.SCORING_RANGES.items():
        column = F.col(name)
        if name not in config.OPTIONAL_SCORING_FIELDS:
            problems.append(F.when(column.isNull(), F.lit(f"{name}: missing")))
        problems.append(F.when(column < low, F.lit(f"{name}: below {low}")))
        if high is not None:
            problems.append(F.when(column > high, F.lit(f"{name}: above {high}")))
    tier = F.col("value_tier")
    return (
        inputs.withColumn("errors", F.array_compact(F.array(*problems)))
        .withColumn("is_valid", F.size("errors") == 0)
        .withColumn("age", F.coalesce("age", F.lit(config.DEFAULT_AGE)))
        .withColumn(
            "value_tier",
            F.when(tier.isin(*config.SCORING_TIERS), tier).otherwise(config.DEFAULT_SCORING_TIER),
        )
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows fit for scoring, quarantine)."""
    return checked.filter("is_valid").drop("errors", "is_valid"), checked.filter("NOT is_valid")


def aligned(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The expected features in training order; absent ones become 0."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0).alias(c) for c in expected if c not in keep])


def decided(df: DataFrame, probability: str = "probability", keep: Sequence[str] = ()) -> DataFrame:
    """Scored records. Decisions use the unrounded probability; reported numbers have 4 places."""
    p = F.col(probability)
    return df.select(
        "customer_id",
        *keep,
        F.round(p, 4).alias("churn_probability"),
        (p > 0.5).alias("churn_prediction"),
        rules.risk_level(p).alias("risk_level"),
        F.round(rules.confidence(p), 4).alias("confidence_score"),
        rules.recommended_actions(
            p,
            F.col("engagement_score"),
            F.col("recency_30d"),
            F.col("support_tickets_30d"),
            F.col("frequency_30d"),
            F.col("value_tier"),
        ).alias("recommended_actions"),
        F.lit(config.MODEL_VERSION).alias("model_version"),
    )


def score_with_model(model, inputs: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scored records from a fitted pipeline: align, transform, decide. Works on batch and streaming input."""
    from pyspark.ml.functions import vector_to_array

    extra = [c for c in INPUT_FIELDS if c in inputs.columns]
    ready = aligned(inputs, features, keep=extra)
    probability = F.element_at(vector_to_array("probability"), 2)
    return decided(model.transform(ready).withColumn("churn_p", probability), "churn_p")


def scored_or_quarantined(inputs: DataFrame, path: str, fields: Sequence[str], probability: Callable[[], Column]) -> DataFrame:
    """Validate, score and store in one pass: rows that may be scored and rows that may not go to two partitions of one commit.

    Every row keeps its fingerprint; a quarantined row has its errors and no score. Returns the stored table.
    """
    checked = checked_inputs(inputs.withColumn("fingerprint", fingerprint(fields)))
    p = F.when(F.col("is_valid"), probability())
    rows = checked.select(
        "fingerprint",
        "customer_id",
        "errors",
        F.round(p, 4).alias("churn_probability"),
        F.when(F.col("is_valid"), rules.risk_level(p)).alias("risk_level"),
        F.lit(config.MODEL_VERSION).alias("model_version"),
        F.when(F.col("is_valid"), "scored").otherwise("quarantined").alias("outcome"),
    )
    rows.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return inputs.sparkSession.read.schema(rows.schema).parquet(path)


def fingerprint(columns: Sequence[str]) -> Column:
    """md5 of the record as key-sorted JSON, missing values written out."""
    record = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.md5(record)


def score_once(
    requests: DataFrame, fields: Sequence[str], score: Callable[[DataFrame], DataFrame], at: str = "ts"
) -> DataFrame:
    """Score every distinct record once and hand the result to all requests for it.

    The first request of a record (by time, then id) is the miss, the others are hits. A record asked for by
    a large share of all requests costs one small row per map task in the grouping; the join back splits it
    like any skewed key.
    """
    marked = requests.withColumn("fingerprint", fingerprint(fields))
    distinct = marked.groupBy("fingerprint", *fields).agg(F.min(F.struct(at, "request_id")).alias("first_request"))
    scored = score(distinct)
    return marked.select("request_id", "fingerprint", at).join(scored, "fingerprint").withColumn(
        "cache_hit", F.struct(at, "request_id") > F.col("first_request")
    )


def batch_summary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Batch size, rows per risk level and mean of the reported probabilities: one row.

    With ``by`` columns: one row per value and, as in a rollup, the subtotals with NULL in their place.
    """
    level = F.col("risk_level")
    total = F.sum(F.col("churn_probability").cast("decimal(10,4)")).cast("double")
    rows = scored.rollup(*by) if by else scored.groupBy()
    return rows.agg(
        F.count("*").alias("batch_size"),
        F.count_if(level == "HIGH").alias("high_risk_count"),
        F.count_if(level == "MEDIUM").alias("medium_risk_count"),
        F.count_if(level == "LOW").alias("low_risk_count"),
        F.round(F.coalesce(F.try_divide(total, F.count("*")), F.lit(0.0)), 4).alias("average_churn_probability"),
    )


def newest_requests(log: DataFrame, rows: int) -> DataFrame:
    """The newest rows of the log, by time and id.

    Rows are counted per day first (one record a day), which gives the day that the newest ``rows`` cannot reach behind.
    From there on every task keeps its newest ``rows`` only and hands those to the last one; older files are not read.
    """
    newest_first = Window.orderBy(F.desc("day"))
    days = log.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    reached = days.withColumn("before", F.sum("n").over(newest_first) - F.col("n")).filter(F.col("before") < rows)
    edge = reached.agg(F.min("day").alias("day"), F.count_if(F.col("day").isNull()).alias("undated")).first()
    if edge["day"] is not None and not edge["undated"]:
        log = log.filter(F.col("ts") >= F.lit(edge["day"]).cast(log.schema["ts"].dataType))
    return log.orderBy(F.desc("ts"), F.desc("request_id")).limit(rows)


def serving_metrics(log: DataFrame, buffer: int = config.LATENCY_BUFFER) -> DataFrame:
    """Totals and rates of the whole log, mean latency of the newest ``buffer`` requests."""
    totals = log.agg(
        F.count("*").alias("total_predictions"),
        F.count_if("cache_hit").alias("_hits"),
        F.count_if("error").alias("_errors"),
        F.max("ts").alias("last_prediction"),
    )
    newest = newest_requests(log, buffer).agg(F.avg("response_ms").alias("_latency"))
    requests = F.greatest(F.col("total_predictions"), F.lit(1)).cast("double")
    # Two one-row tables laid over each other.
    both = totals.unionByName(newest, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "total_predictions",
        F.round(F.coalesce("_latency", F.lit(0.0)), 2).alias("avg_response_time_ms"),
        F.round(F.col("_hits") / requests, 4).alias("cache_hit_rate"),
        F.round(F.col("_errors") / requests, 4).alias("error_rate"),
        "last_prediction",
    )
