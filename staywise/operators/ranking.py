"""Exact global ranks, quintiles, running totals and quantiles without a single-task window.

A window without a partition key sends every row to one task. Here the rows are range-partitioned in the
required order and sorted inside their partitions; the position of a row is then its place in its partition plus
the number of rows in the partitions before. Only one record per partition is needed for the second part, so
the offset table has one row per shuffle partition and group in it, whatever the number of data rows.

With very many groups that table may grow; Spark broadcasts it below its own threshold and shuffles it beyond.

The sorted rows are written, with their place, before partition numbers are used: a recomputed partition would
otherwise be free to come back with other boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staywise.session import written

_ROW_BITS = 33  # monotonically_increasing_id() = partition number << 33 | row number in the partition


def _with_offsets(placed: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the offsets. They are written first, so Spark knows their size when it chooses between broadcast and shuffle."""
    return placed.join(written(offsets, "offsets"), list(keys))


def global_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], total: str = "group_rows") -> DataFrame:
    """Adds ``position`` (1-based, per group, NULLs first) and the number of rows of the group.

    The order columns must end in something unique, otherwise ties are broken arbitrarily.
    """
    keys = [*group, *order]
    columns = df.columns
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(sorted_rows.select(*columns, F.monotonically_increasing_id().alias("_place")), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    parts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    # One row per (group, partition) from here on.
    everything = Window.partitionBy(*group)
    before = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *group,
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(everything).alias(total),
    )
    return _with_offsets(placed, offsets, [*group, "_part"]).select(
        *columns, (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias("position"), total
    )


def ntile_of(position: Column, rows: Column, buckets: int) -> Column:
    """Bucket number of a position: the first ``rows % buckets`` buckets hold one row more."""
    small = F.floor(rows / buckets)
    extra = rows % buckets
    in_large = position <= extra * (small + 1)
    large_bucket = F.ceil(position / (small + 1))
    small_bucket = extra + F.ceil((position - extra * (small + 1)) / F.greatest(small, F.lit(1)))
    return F.when(in_large, large_bucket).otherwise(small_bucket).cast("int")


def global_ntile(df: DataFrame, key: str, metrics: dict[str, Column], buckets: int) -> DataFrame:
    """Exact ``ntile`` of several metrics over the whole table: key plus one bucket column per metric.

    The metrics are stacked, so one range shuffle serves all of them. They are compared as doubles, ascending,
    NULLs first, ties by key.
    """
    stacked = df.select(
        key,
        F.inline(
            F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in metrics.items()])
        ),
    )
    ranked = global_rank(stacked, ["metric"], ["value", key])
    bucket = ntile_of(F.col("position"), F.col("group_rows"), buckets)
    return (
        ranked.select(key, "metric", bucket.alias("bucket"))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("metric") == name, F.col("bucket"))).alias(name) for name in metrics])
    )


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds ``<value>_upto`` (inclusive running total in the given order) and ``<value>_all`` (group total).

    The order columns must be unique within a group: aggregate equal keys first.
    """
    keys = [*group, *order]
    columns = df.columns
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(sorted_rows.select(*columns, F.spark_partition_id().alias("_part")), "ordered")
    parts = placed.groupBy(*group, "_part").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    everything = Window.partitionBy(*group)
    before = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *group,
        "_part",
        *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}_before") for v in values],
        *[F.sum(f"_{v}").over(everything).alias(f"{v}_all") for v in values],
    )
    local = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.select("*", *[F.sum(v).over(local).alias(f"_{v}_local") for v in values])
    return _with_offsets(totals, offsets, [*group, "_part"]).select(
        *columns,
        *[(F.col(f"_{v}_before") + F.col(f"_{v}_local")).alias(f"{v}_upto") for v in values],
        *[f"{v}_all" for v in values],
    )


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and share; NULL values are left out.

    The built-in exact percentile keeps all distinct values of a group in one buffer. Here equal values are
    counted first, and each wanted position is looked up in the running counts.
    """
    return quantiles_of_counts(df.groupBy(*group, value).agg(F.count("*").alias("n")), group, value, shares)


def quantiles_of_counts(counted: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """The same from counted values: one row per group and value, with its number of rows ``n``."""
    placed = running_totals(counted.filter(F.col(value).isNotNull()), group, [value], ["n"])
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    # 0-based positions covered by this value: [n_upto - n, n_upto - 1]
    first, last = F.col("n_upto") - F.col("n"), F.col("n_upto") - 1
    target = lambda share: share * (F.col("n_all") - 1)
    holds_low = lambda share: F.floor(target(share)).between(first, last)
    holds_high = lambda share: F.ceil(target(share)).between(first, last)
    hits = placed.withColumn("share", F.explode(F.filter(wanted, lambda s: holds_low(s) | holds_high(s))))
    share, numeric = F.col("share"), F.col(value).cast("double")
    return (
        hits.groupBy(*group, "share")
        .agg(
            F.max(F.when(holds_low(share), numeric)).alias("_low"),
            F.max(F.when(holds_high(share), numeric)).alias("_high"),
            F.max(target(share) - F.floor(target(share))).alias("_fraction"),
        )
        .select(*group, "share", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_fraction")).alias("quantile"))
    )
