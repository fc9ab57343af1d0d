"""Reuse of results for a fixed time after they were made.

A result serves its record until it expires; the first request from then on makes the next one. Which requests miss is a chain in time: from
each instant a pointer leads to the first instant after expiry, and the misses are what the first instant reaches. The chain is followed
by pointer doubling, in as many rounds as the logarithm of its length, never record by record.

Pointers are found inside buckets of time as long as the lifetime: the next instant lies in the next bucket or is the head of a later one. So a record
that a third of all requests ask for is spread over as many tasks as there are buckets; what is sorted for one record are its
buckets, whose number is the time span over the lifetime. Instants are reduced to distinct ones in the map tasks first.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import written

MOST_ROUNDS = 64


def _micros(lifetime: timedelta) -> int:
    return lifetime // timedelta(microseconds=1)


def _in_bucket(name: str, life: int) -> Column:
    """The bucket of a column of microseconds, exact for times before 1970 too."""
    return F.expr(f"cast(({name} - pmod({name}, {life}L)) div {life}L as bigint)")


def pointers(instants: DataFrame, life: int) -> DataFrame:
    """(record, t, next): for distinct instants (record, t) the first one at ``t + life`` or later, NULL without one."""
    data = instants.select("record", "t", _in_bucket("t", life).alias("b"))
    asked = data.select("record", F.col("t").alias("origin"), (F.col("t") + life).alias("t"), (F.col("b") + 1).alias("b"))
    both = data.withColumn("origin", F.lit(None).cast("long")).unionByName(asked)
    # A request at the moment of expiry is not served any more: questions stand before instants of the same time.
    onward = Window.partitionBy("record", "b").orderBy("t", F.col("origin").isNull()).rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("near", F.first(F.when(F.col("origin").isNull(), F.col("t")), ignorenulls=True).over(onward))
    found = written(found.where("origin is not null").select("record", F.col("origin").alias("t"), "b", "near"), "near")

    heads = data.groupBy("record", "b").agg(F.min("t").alias("head"))
    open_ends = found.where("near is null").select("record", "b", F.lit(None).cast("long").alias("head")).distinct()
    later = Window.partitionBy("record").orderBy("b").rowsBetween(1, Window.unboundedFollowing)
    heads = heads.unionByName(open_ends).groupBy("record", "b").agg(F.min("head").alias("head"))
    heads = written(heads.withColumn("far", F.first("head", ignorenulls=True).over(later)).select("record", "b", "far"), "heads")
    return found.join(heads, ["record", "b"], "left").select("record", "t", F.coalesce("near", "far").alias("next"))


def misses(requests: DataFrame, record: str, at: str, lifetime: timedelta, known: DataFrame | None = None) -> DataFrame:
    """(record, miss_at): the instants at which a result has to be made.

    ``known`` (record, miss_at) are the newest misses of earlier requests, all older than these: their results are still used. Runs over
    consecutive parts of a log give the same misses as one run over the whole log. Requests without record or time are left out.
    """
    life = _micros(lifetime)
    instants = requests.select(F.col(record).alias("record"), F.unix_micros(at).alias("t")).where("record is not null and t is not null")
    instants = written(instants.distinct(), "instants")
    if known is not None:
        before = known.select(F.col(record).alias("record"), (F.unix_micros("miss_at") + life).alias("free_at"))
        instants = instants.join(before, "record", "left").where("free_at is null or t >= free_at").select("record", "t")
        instants = written(instants, "instants")
    jump = written(pointers(instants, life).where("next is not null"), "jump")
    reached = written(instants.groupBy("record").agg(F.min("t").alias("t")), "reached")
    found = reached
    for _ in range(MOST_ROUNDS):
        # What is reached so far lies fewer steps away than a jump is long, so each jump leads to an instant not reached yet.
        further = written(found.join(jump, ["record", "t"]).select("record", F.col("next").alias("t")), "further")
        if not further.limit(1).count():
            return found.select(F.col("record").alias(record), F.timestamp_micros("t").alias("miss_at"))
        found = found.unionByName(further)
        onward = jump.select("record", F.col("t").alias("next"), F.col("next").alias("after"))
        jump = written(jump.join(onward, ["record", "next"]).select("record", "t", F.col("after").alias("next")), "jump")
    raise RuntimeError(f"the chain of misses did not end in {MOST_ROUNDS} rounds")


def served(requests: DataFrame, made: DataFrame, record: str, at: str, lifetime: timedelta) -> DataFrame:
    """The requests with ``miss_at``, the time at which the result they get was made."""
    life = _micros(lifetime)
    asked = requests.withColumn("_t", F.unix_micros(at)).withColumn("_b", _in_bucket("_t", life))
    results = made.select(F.col(record).alias("_record"), F.unix_micros("miss_at").alias("_made"))
    results = results.withColumn("_b", _in_bucket("_made", life))
    # A result is younger than its lifetime when it is used: it was made in the request's bucket or in the one before.
    near = results.unionByName(results.withColumn("_b", F.col("_b") + 1))
    per_bucket = near.groupBy("_record", "_b").agg(F.sort_array(F.collect_list("_made")).alias("_all"))  # two at most
    joined = asked.join(
        per_bucket.withColumnRenamed("_b", "_bucket"), (F.col(record) == F.col("_record")) & (F.col("_b") == F.col("_bucket"))
    )
    usable = F.filter("_all", lambda m: (m <= F.col("_t")) & (F.col("_t") < m + life))
    return joined.withColumn("miss_at", F.timestamp_micros(F.array_max(usable))).drop("_t", "_b", "_bucket", "_record", "_all")
