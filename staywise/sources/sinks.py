"""Writers: dated partitions, append-only logs, bucketed tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partition(df: DataFrame, path: str, name: str, value: str | date) -> None:
    """Replace one partition of a Parquet table; the other partitions stay untouched, so a repeated run is safe."""
    (
        df.withColumn(name, F.lit(str(value)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def append_log(log: DataFrame, path: str, at: str = "ts") -> None:
    """Append to a log table partitioned by day, so that readers of recent days open only those folders.

    Rows of a day are spread over many files by the shuffle (AQE splits large days), not sent to one writer.
    """
    with_day = log.withColumn("day", F.col(at).cast("date").cast("string"))
    with_day.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Save as a table bucketed and sorted by the keys: joins and aggregates on them need no shuffle later."""
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
