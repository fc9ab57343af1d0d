"""Keyed feature tables: key checks, merge writes, lookups, point-in-time lookups, labelled extracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise import schemas
from staywise.operators.engagement import engagement_columns
from staywise.operators.rfm import rfm_columns


@dataclass(frozen=True)
class FeatureTable:
    """Description of one stored feature table."""

    name: str
    primary_keys: tuple[str, ...]
    schema: T.StructType
    description: str = ""

    def create(self, spark: SparkSession, path: str) -> None:
        """Write the empty table, so that readers find the schema."""
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(path)

    def conform(self, df: DataFrame) -> DataFrame:
        """The table's columns in order and type; fails on a missing column."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])


# The three stored tables of the 30-day features.
TABLES = {
    table.name: table
    for table in (
        FeatureTable(
            "demographics", ("customer_id",), schemas.DEMOGRAPHIC_FEATURES, "customer demographics and profile"
        ),
        FeatureTable(
            "behavior",
            ("customer_id",),
            schemas.windowed_features(engagement_columns(30), ("content_minutes",)),
            "engagement counts",
        ),
        FeatureTable(
            "transactions",
            ("customer_id",),
            schemas.windowed_features(
                rfm_columns(30), ("monetary", "spending", "purchase_frequency", "recent_spending")
            ),
            "purchases and spend",
        ),
    )
}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def key_report(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table: rows, duplicated keys, whether the key is unique."""
    result = None
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
        row = per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        )
        result = row if result is None else result.unionByName(row)
    return result.withColumn("is_unique", F.col("duplicate_keys") == 0)


def newest(df: DataFrame, keys: Sequence[str], *version: str) -> DataFrame:
    """The row with the highest version per key.

    Spark keeps only the best row per key of each map task before the shuffle, so a key with very many
    versions does not travel whole.
    """
    latest_first = Window.partitionBy(*keys).orderBy(*[F.desc(v) for v in version])
    return df.withColumn("_place", F.row_number().over(latest_first)).filter("_place = 1").drop("_place")


def merged(existing: DataFrame, updates: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest row per key of both tables; on equal versions the update wins."""
    both = existing.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
    return newest(both, keys, version, "_update").drop("_update")


def merge_write(updates: DataFrame, path: str, target: str, keys: Sequence[str], version: str) -> None:
    """Merge into the table at ``path`` and write the result to ``target``.

    The stored table is read with its own schema: columns that the updates lack keep their stored values, new ones are added.
    A Parquet table cannot be overwritten while it is read, so each merge writes a new folder; the caller
    points readers to it afterwards.
    """
    existing = updates.sparkSession.read.parquet(path)
    kept = [c for c in existing.columns if c not in updates.columns]
    fresh = [c for c in updates.columns if c not in existing.columns]
    stored = newest(existing, keys, version)
    for name in fresh:
        stored = stored.withColumn(name, F.lit(None).cast(updates.schema[name].dataType))
    rows = merged(stored.drop(*kept), updates, keys, version)
    if kept:
        rows = rows.join(stored.select(*keys, *kept), list(keys), "left")
    rows.write.mode("overwrite").parquet(target)


def looked_up(tables: Sequence[DataFrame], key: str, ids: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Inner join of the feature tables, restricted to the wanted ids.

    A short id list becomes a pushed-down ``IN``; an id table is applied to the first table as a semi join
    before anything else is joined.
    """
    first = tables[0]
    if isinstance(ids, DataFrame):
        first = first.join(ids.select(key).distinct(), key, "left_semi")
    elif ids is not None:
        first = first.filter(F.col(key).isin(list(ids)))
    for other in tables[1:]:
        first = first.join(other, key)
    return first


def as_of_lookup(
    requests: DataFrame, versions: DataFrame, key: str, wanted: str, version: str, values: Sequence[str]
) -> DataFrame:
    """For each request the newest version dated on or before it (NULL values if there is none).

    Both dates are days and ``versions`` has at most one row per key and day. Requests are reduced to
    distinct (key, day) pairs before they are ordered, so the rows sorted together for one key are bounded by the
    number of days, however many requests the key has. No (request, version) pairs are formed.
    """
    payload = F.struct(F.col(version).alias("version"), *values)
    known = versions.select(key, F.col(version).alias("_day"), F.lit(0).alias("_kind"), payload.alias("_payload"))
    asked = (
        requests.select(key, F.col(wanted).alias("_day"))
        .distinct()
        .select(key, "_day", F.lit(1).alias("_kind"), F.lit(None).cast(known.schema["_payload"].dataType).alias("_payload"))
    )
    so_far = Window.partitionBy(key).orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    answers = (
        known.unionByName(asked)
        .withColumn("_found", F.last("_payload", ignorenulls=True).over(so_far))
        .filter("_kind = 1")
        .select(
            key,
            F.col("_day").alias(wanted),
            F.col("_found.version").alias(version),
            *[F.col(f"_found.{v}").alias(v) for v in values],
        )
    )
    return requests.join(answers, [key, wanted], "left")


LABELLED_COLUMNS = (
    "customer_id",
    "recency_30d",
    "frequency_30d",
    "monetary_total_30d",
    "engagement_score",
    "customer_tenure_months",
    "support_tickets_30d",
    "churned",
    "created_at",
)


def recent_labelled(features: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Labelled rows created in the last ``days`` days, as SQL over the feature table."""
    return features.sparkSession.sql(
        f"""
        SELECT {", ".join(LABELLED_COLUMNS)}
        FROM {{features}}
        WHERE created_at >= DATE '{as_of.isoformat()}' - INTERVAL '{int(days)}' DAY AND churned IS NOT NULL
        """,
        features=features,
    )
