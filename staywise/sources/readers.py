"""Typed batch and streaming readers for the customer, transaction and engagement inputs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise import schemas

FORMATS = ("parquet", "orc", "json", "csv")


def read_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Batch read with a stated schema: no inference pass over the data."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if fmt == "csv":
        options.setdefault("header", "true")
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def stream_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Streaming read of a folder; new files become new rows."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of names, sizes and times of all files below some paths; it changes whenever one of them does."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(configuration).listFiles(path, True)
        while files.hasNext():
            status = files.next()
            seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


CORRUPT, EXTRAS = "_corrupt", "_extras"


def read_rescued(spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[str] = (), pattern: str = "yyyy-MM-dd") -> DataFrame:
    """JSON lines whose faults are kept instead of failing the job or vanishing.

    ``_corrupt`` holds the line if it is no JSON object or a value has another type than stated (its column is then NULL), ``_extras`` the columns that
    the schema does not name, as text. ``dates`` are read as text and parsed; ``bad_dates`` names those with text that is no date.
    ``outcome`` is ok, bad_date or corrupt.
    """
    read_as = T.StructType([T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in schema.fields])
    read_as = read_as.add(CORRUPT, T.StringType())
    known = [f.name for f in schema.fields]
    lines = spark.read.text(path).select("value", F.from_json("value", read_as, {"columnNameOfCorruptRecord": CORRUPT}).alias("row"))
    texts = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    extras = F.map_filter(texts, lambda name, _: ~name.isin(known))
    wrong = F.array_compact(
        F.array(
            *[F.when(F.col(f"row.{d}").isNotNull() & parse_date(F.col(f"row.{d}"), pattern).isNull(), F.lit(d)) for d in dates]
        )
        if dates
        else F.array().cast("array<string>")
    )
    columns = [(parse_date(F.col(f"row.{n}"), pattern) if n in dates else F.col(f"row.{n}")).alias(n) for n in known]
    corrupt = F.col(f"row.{CORRUPT}")
    return lines.select(
        *columns,
        corrupt.alias(CORRUPT),
        F.when(corrupt.isNull() & (F.size(extras) > 0), extras).alias(EXTRAS),
        wrong.alias("bad_dates"),
        F.when(corrupt.isNotNull(), "corrupt").when(F.size(wrong) > 0, "bad_date").otherwise("ok").alias("outcome"),
    )


INPUTS = {"customers": schemas.CUSTOMERS, "transactions": schemas.TRANSACTIONS, "engagement": schemas.ENGAGEMENT}


def read_input(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", streaming: bool = False, **options: str
) -> DataFrame:
    """One of the three canonical inputs, as a batch or a stream."""
    read = stream_typed if streaming else read_typed
    return read(spark, path, INPUTS[name], fmt, **options)


def from_rows(spark: SparkSession, rows: Iterable[tuple], names: list[str]) -> DataFrame:
    """Small literal tables, for examples and tests."""
    return spark.createDataFrame(list(rows), names)


def parse_date(column: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date from text. Unparseable text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(column, F.lit(pattern)).cast("date")


def with_parsed_date(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(column, parse_date(F.col(column), pattern))
