"""Data-quality and cardinality profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise import config


def out_of_range(ranges: dict[str, tuple]) -> dict[str, Column]:
    """Per field: is the value outside its range (NULL counts as inside)."""
    checks = {}
    for name, (low, high) in ranges.items():
        bad = F.col(name) < low
        if high is not None:
            bad = bad | (F.col(name) > high)
        checks[name] = F.coalesce(bad, F.lit(False))
    return checks


def quality_summary(df: DataFrame, key: str, ranges: dict[str, tuple] = config.SCORING_RANGES) -> DataFrame:
    """One row: records, share of missing values, duplicated keys, rows with a violation, quality score.

    Rows are grouped by key first (that finds the duplicates); everything else adds up over the groups.
    """
    columns = df.columns
    missing = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    checks = list(out_of_range(ranges).values())
    bad = F.lit(False)
    for check in checks:
        bad = bad | check
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"), F.sum(missing).alias("missing"), F.count_if(bad).alias("bad")
    )
    n = F.sum("n")
    return per_key.agg(
        n.alias("records_extracted"),
        F.round(100.0 * F.sum("missing") / (n * len(columns)), 4).alias("missing_values_pct"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("duplicate_keys"),
        F.sum("bad").alias("rows_with_violation"),
        F.round(1.0 - F.sum("bad") / n, 4).alias("data_quality_score"),
    )


def quality_by_column(df: DataFrame, ranges: dict[str, tuple] = config.SCORING_RANGES) -> DataFrame:
    """One row per column: missing values and range violations."""
    checks = out_of_range(ranges)
    counts = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns],
        *[F.count_if(check).alias(f"bad_{name}") for name, check in checks.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"missing_{c}").alias("missing_count"),
                F.coalesce(F.try_divide(F.col(f"missing_{c}").cast("double"), F.col("n")), F.lit(0.0)).alias(
                    "missing_share"
                ),
                (F.col(f"bad_{c}") if c in checks else F.lit(0).cast("bigint")).alias("violations"),
            )
            for c in df.columns
        ]
    )
    return counts.select(F.inline(rows))


def cardinality(df: DataFrame, columns: Sequence[str], limit: int = config.MAX_CATEGORIES) -> DataFrame:
    """Exact distinct values per column and whether the column is few-valued enough to be encoded.

    The columns are stacked into (name, value) pairs and reduced before the shuffle: one pass, no row is
    multiplied across the network once per column as several distinct counts would do.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .distinct()
        .groupBy("column_name")
        .agg(F.count("value").alias("distinct_values"))
        .withColumn("kept", F.col("distinct_values") <= limit)
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    counted = df.agg(
        F.count(label).alias("n"), F.count_if(F.col(label) == 1).alias("churn"), F.count_if(F.col(label) == 0).alias("retain")
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                F.col(name).alias("n_rows"),
                F.coalesce(F.try_divide(F.col(name).cast("double"), F.col("n")), F.lit(0.0)).alias("share"),
            )
            for name in ("churn", "retain")
        ]
    )
    return counted.select(F.inline(pairs))
