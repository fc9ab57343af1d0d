"""Which rows may have an id of a list: a bitmap goes to every task, so that only few others travel to an exact join.

Each id sets one bit. Rows whose bit is not set have no id of the list and stay where they are; the others are for a join to decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.session import written

BITS_EACH = 32  # at least, so that one row in 32 at most is taken for one of the list
MOST_BITS = 1 << 27  # 16 MB, whatever the size of the list; of a longer list the bitmap rules out fewer rows


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).try_cast("long")), F.lit(bits))


def presence(ids: DataFrame) -> Callable[[DataFrame, str], tuple[DataFrame, DataFrame]]:
    """A function of (rows, key) that gives the rows whose key may be in the one column of ``ids`` and those whose key surely is not.

    Null is an id like any other, and what cannot be read as a whole number counts as null.
    """
    listed = written(ids.toDF("id").distinct(), "listed")
    bits = min(MOST_BITS, max(1 << 15, 1 << (BITS_EACH * listed.count() - 1).bit_length()))
    places = listed.select(_place("id", bits).alias("place")).withColumn("_presence_part", F.bitmap_bucket_number("place"))
    # Dealt first: partial bitmaps would be as many as tasks.
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_presence_bits")
    parts = written(places.repartition("_presence_part").groupBy("_presence_part").agg(bitmap), "presence")

    def split(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        place = _place(key, bits)
        at = F.bitmap_bit_position(place)
        octet = F.conv(F.hex(F.substring("_presence_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.coalesce(F.getbit(octet, (at % 8).cast("int")) == 1, F.lit(False))
        near = rows.join(F.broadcast(parts), F.bitmap_bucket_number(place) == F.col("_presence_part"), "left")
        return tuple(near.where(c).drop("_presence_part", "_presence_bits") for c in (is_set, ~is_set))

    return split
