"""Keyed tables on disk: hash buckets as partitions, merges that rewrite only the buckets they touch, versions with validity.

Buckets come from a hash of the key, so they are even whatever the keys look like; a large one is written as several files. A merge reads and
overwrites (partition by partition) the buckets of its updates only. A merge that is run again gives the same table: the newest
version of a key wins, and of equal versions the update.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.operators.feature_store import as_of_lookup, newest
from staywise.operators.scoring import fingerprint
from staywise.session import written

BUCKET = "bucket"
VALID_TO = "valid_to"
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def _put(rows: DataFrame, path: str, mode: str, *partitions: str) -> None:
    """Write rows into their partitions; a large partition becomes several files."""
    placed = rows.hint("rebalance", *partitions)
    writer = placed.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def _touched(rows: DataFrame) -> list[int]:
    """The buckets of some rows, never more than the table has."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


@dataclass(frozen=True)
class KeyedStore:
    """One row per key, or with ``history`` one per key and version, valid from its version up to ``valid_to`` (NULL: still valid).

    ``schema`` names all columns that are stored, keys and version included. Rows with a null key or version are refused.
    """

    path: str
    keys: tuple[str, ...]
    version: str
    schema: T.StructType
    buckets: int = BUCKETS
    history: bool = False

    def _stored_schema(self) -> T.StructType:
        fields = list(self.schema.fields)
        if self.history:
            fields.append(T.StructField(VALID_TO, self.schema[self.version].dataType))
        return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])

    def create(self, spark: SparkSession) -> KeyedStore:
        """The empty table, if there is none yet."""
        empty = spark.createDataFrame([], self._stored_schema())
        empty.write.mode("ignore").partitionBy(BUCKET).parquet(self.path)
        return self

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """All stored rows, or those of some buckets (other files are not opened)."""
        stored = spark.read.schema(self._stored_schema()).parquet(self.path)
        return stored if buckets is None else stored.where(F.col(BUCKET).isin(list(buckets)))

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key."""
        rows = self.read(spark)
        return (rows.where(F.col(VALID_TO).isNull()).drop(VALID_TO) if self.history else rows).drop(BUCKET)

    def merge(self, updates: DataFrame) -> list[int]:
        """Put updates into the table and return the buckets that were rewritten."""
        spark = updates.sparkSession
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows = written(updates.select(*columns).withColumn(BUCKET, bucket_of(self.keys, self.buckets)), "updates")
        missing = " OR ".join(f"{c} IS NULL" for c in (*self.keys, self.version))
        if rows.where(missing).limit(1).count():
            raise ValueError(f"updates of {self.path} need {', '.join((*self.keys, self.version))} in every row")
        touched = _touched(rows)
        if touched:
            # Written before it goes over the folders that it was read from.
            merged = written(self._merged(self.read(spark, touched), rows), "merged")
            _put(merged, self.path, "overwrite", BUCKET)
        return touched

    def _merged(self, stored: DataFrame, updates: DataFrame) -> DataFrame:
        if not self.history:
            both = stored.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
            return newest(both, self.keys, self.version, "_update").drop("_update")
        both = stored.drop(VALID_TO).withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
        versions = newest(both, (*self.keys, self.version), "_update").drop("_update")
        # A key has at most one row per version, so what is sorted together is bounded by the number of versions.
        in_order = Window.partitionBy(*self.keys).orderBy(self.version)
        kept = [f.name for f in self.schema.fields]
        return versions.select(*kept, F.lead(self.version).over(in_order).alias(VALID_TO), BUCKET)

    def as_of(self, requests: DataFrame, wanted: str, values: Sequence[str]) -> DataFrame:
        """Each request with the version of its key that was valid on the day ``wanted`` (NULL without one). One-column keys only.

        Only the requests' buckets are read, and of those the versions whose validity meets the days asked for.
        """
        (key,) = self.keys
        spark = requests.sparkSession
        asked = written(requests.select(bucket_of(self.keys, self.buckets), wanted).distinct(), "asked")
        first, last = asked.agg(F.min(wanted), F.max(wanted)).first()
        versions = self.read(spark, _touched(asked))
        versions = versions.where((F.col(self.version) <= F.lit(last)) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.lit(first))))
        return as_of_lookup(requests, versions.select(key, self.version, *values), key, wanted, self.version, values)


@dataclass(frozen=True)
class ResultStore:
    """Scores that later runs reuse until they expire, by day of scoring and bucket of the record's fingerprint."""

    path: str
    lifetime: timedelta
    buckets: int = BUCKETS

    SCHEMA = "fingerprint string, churn_probability double, scored_at timestamp, scored_day string, bucket int"

    def stored(self, spark: SparkSession) -> DataFrame:
        spark.createDataFrame([], self.SCHEMA).write.mode("ignore").partitionBy("scored_day", BUCKET).parquet(self.path)
        return spark.read.schema(self.SCHEMA).parquet(self.path)

    def live(self, spark: SparkSession, now: datetime) -> DataFrame:
        """Results that may be used at ``now``; folders of earlier days are not opened."""
        since = now - self.lifetime
        at = F.col("scored_at")
        rows = self.stored(spark).where(F.col("scored_day") >= F.lit(since.date().isoformat()))
        return rows.where((at > F.lit(since)) & (at <= F.lit(now)))

    def answer(
        self,
        requests: DataFrame,
        fields: Sequence[str],
        probability: Callable[[DataFrame], DataFrame],
        now: datetime,
        at: str = "ts",
    ) -> DataFrame:
        """All requests (request_id, ``at``, ``fields``) with their score, and whether it was there before.

        Records with a live result are hits. Of the others each distinct record is scored once (``probability`` adds
        ``churn_probability``) and the result appended; its first request is the miss. A run repeated with the same ``now`` finds its own results.
        """
        spark = requests.sparkSession
        marked = written(requests.withColumn("fingerprint", fingerprint(fields)), "asked")
        wanted = marked.select("fingerprint").distinct()
        live = newest(self.live(spark, now), ["fingerprint"], "scored_at")
        # Written before the store grows: hits are what was there before this run.
        hits = written(live.join(wanted, "fingerprint", "left_semi").select("fingerprint", "churn_probability"), "hits")
        records = marked.join(hits, "fingerprint", "left_anti")
        # A record that a third of all requests ask for leaves each task as one row.
        distinct = records.groupBy("fingerprint", *fields).agg(F.min(F.struct(at, "request_id")).alias("first_request"))
        scored = written(probability(distinct).select("fingerprint", "churn_probability", "first_request"), "scored")
        fresh = scored.select(
            "fingerprint",
            "churn_probability",
            F.lit(now).alias("scored_at"),
            F.lit(now.date().isoformat()).alias("scored_day"),
            bucket_of(["fingerprint"], self.buckets),
        )
        _put(fresh, self.path, "append", "scored_day", BUCKET)
        answers = written(hits.unionByName(scored, allowMissingColumns=True), "answers")
        hit = F.col("first_request").isNull() | (F.struct(at, "request_id") > F.col("first_request"))
        return marked.join(answers, "fingerprint").withColumn("cache_hit", hit).drop("first_request")
