"""Connected components of an edge list by star contraction, wholly in DataFrames.

Each round hangs every node's larger neighbours on its smallest one, then the smaller ones. Rounds grow with the logarithm of
the longest path. Minima are combined on the map side, and the joins leave hot nodes to AQE's skew splitting; no node's
neighbours are ever gathered. Every round is written to the shared work folder, so a lost executor replays one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.session import written

MOST_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u, v: long); component is the smallest node reached.

    Loops, repeated edges and either direction are fine; null ends are left out. No edge gives no rows.
    """
    pairs = edges.where("u is not null and v is not null and u <> v")
    stars = written(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    before = _state(stars)
    if not before[0]:
        return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(MOST_ROUNDS):
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        hung = written(hung, "stars")
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
