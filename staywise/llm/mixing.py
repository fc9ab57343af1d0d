"""Mixing sources to target weights by iterative proportional fitting, by built-in functions only.

Documents are counted once into cells (source, language, topic) with their tokens; hot sources are combined on the map side. Raking then scales the
cells' weights to the source, language and topic targets in turn until no factor differs from 1. Cells are a table of their own size,
never a driver array: each sweep is three sums and joins, written to the work folder. Documents are drawn with the calibrated expectation of
their cell: budget x weight / tokens of the cell. Expectations above 1 give whole copies and one more by chance.

Chance is the md5 of the id, so a draw can be repeated anywhere; rows with one id share it. Null ids share one draw as well.

Targets: ``Targets`` gives each dimension an exponent (1 keeps the observed share, 0 makes all values equal) or explicit weights; both are normalised.
Values without an explicit weight get none. Raking goes on until the marginals are met; targets that the
cells cannot meet together raise an error. Null sources and languages count as empty strings. Texts without words
weigh nothing and are not drawn. Empty tables give empty results. Input columns are kept in one struct, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.session import written

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE = 1e-9
# Targets that cannot be met together leave the largest step where it is; so many sweeps without a lower one end the raking with an error.
STALLED = 40
# A table of so many cells is below 1 MB an executor can hold; more cells are joined by a shuffle.
BROADCAST_CELLS = 20_000

# Topics by a pattern, first match counts; the rest is prose.
TOPICS = (
    ("legal", r"[Ll]icense|[Cc]opyright|rights reserved"),
    ("data", r"[0-9]{4}"),
    ("list", r"\n[^\n]*\n[^\n]*\n[^\n]*\n[^\n]*\n"),
)


@dataclass(frozen=True)
class Targets:
    budget: float = 0.5  # expected tokens drawn, as a share of all tokens
    power: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.7, "topic": 0.5})
    weights: dict[str, dict[str, float]] = field(default_factory=dict)


def topic_of(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def described(docs: DataFrame) -> DataFrame:
    """``row`` (all input columns), doc_id, the three dimensions and n_tokens."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        docs["doc_id"].alias("doc_id"),
        F.coalesce(docs["source"], F.lit("")).alias("source"),
        F.coalesce(docs["lang"], F.lit("")).alias("lang"),
        topic_of(text).alias("topic"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_tokens"),
    )


def _targets(cells: DataFrame, name: str, targets: Targets) -> DataFrame:
    """(value, goal): goals of one dimension, summing to 1."""
    shares = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("t"))
    if name in targets.weights:
        given = targets.weights[name]
        pairs = [x for value, weight in given.items() for x in (F.lit(value), F.lit(float(weight)))]
        raw = F.coalesce(F.create_map(*pairs)[F.col("value")], F.lit(0.0))
    else:
        raw = F.pow(F.col("t").cast("double"), F.lit(targets.power[name]))
    shares = shares.select("value", raw.alias("raw"))
    total = shares.agg(F.sum("raw").alias("total"))
    return shares.join(F.broadcast(total)).select("value", (F.col("raw") / F.col("total")).alias("goal"))  # one row


def rake(cells: DataFrame, targets: Targets = Targets(), stalled: int = STALLED) -> DataFrame:
    """``cells`` (dimensions, tokens > 0) with ``weight``, summing to 1, whose marginals meet the targets."""
    now = cells.select(*DIMENSIONS, "tokens", F.col("tokens").cast("double").alias("weight"))
    for name in DIMENSIONS:
        goal = _targets(cells, name, targets).select(F.col("value").alias(name), F.col("goal").alias(f"goal_{name}"))
        now = now.join(goal, name)
    now = written(now.withColumn("moved", F.lit(0.0)), "cells")
    few = now.count() <= BROADCAST_CELLS
    least, since = float("inf"), 0
    while since < stalled:
        now = written(_sweep(now, few), "cells")
        moved = now.agg(F.max("moved")).first()[0]
        if moved is None or moved < TOLERANCE:
            return now.select(*DIMENSIONS, "tokens", "weight")
        least, since = (moved, 0) if moved < 0.999 * least else (least, since + 1)
    raise ValueError(f"the targets cannot be met together: sums still move by {least:.3g} of themselves")


def _sweep(now: DataFrame, few: bool) -> DataFrame:
    """Each dimension scaled to its goals once; ``moved`` is the largest step away from a factor of 1.

    ``few``: there are no more sums than ``BROADCAST_CELLS``, so they may be sent to the cells.
    """
    goals = [f"goal_{name}" for name in DIMENSIONS]
    now = now.select(*DIMENSIONS, "tokens", "weight", *goals, F.lit(0.0).alias("moved"))
    for name in DIMENSIONS:
        sums = now.groupBy(name).agg(F.sum("weight").alias("had"))
        factor = F.when(F.col("had") > 0, F.col(f"goal_{name}") / F.col("had")).otherwise(F.lit(0.0))
        step = F.when(F.col("weight") > 0, F.abs(factor - 1)).otherwise(F.lit(0.0))
        now = now.join(F.broadcast(sums) if few else sums, name).select(
            *DIMENSIONS, "tokens", (F.col("weight") * factor).alias("weight"), *goals, F.greatest("moved", step).alias("moved")
        )
    return now


def expectations(rows: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """(dimensions, probability): expected copies of a document of each cell, from described rows."""
    cells = written(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "cells")
    total = F.broadcast(cells.agg(F.sum("tokens").alias("total")))  # one row
    return (
        rake(cells, targets)
        .join(total)
        .select(*DIMENSIONS, (F.lit(targets.budget) * F.col("total") * F.col("weight") / F.col("tokens")).alias("probability"))
    )


def chance(doc_id: Column) -> Column:
    """A number in [0, 1) from the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def drawn(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Described rows with ``probability`` and ``copies``."""
    table = written(table, "expectations")
    if table.count() <= BROADCAST_CELLS:
        table = F.broadcast(table)
    joined = rows.join(table, list(DIMENSIONS), "left")
    expected = F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(F.lit(0.0))
    whole = F.floor(expected)
    return joined.select(
        "row", "doc_id", *DIMENSIONS, "n_tokens",
        expected.alias("probability"),
        (whole + (chance(F.col("doc_id")) < expected - whole).cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """Every row with its expectation and its number of copies in the mixture."""
    rows = described(docs)
    slim = written(rows.select(*DIMENSIONS, "n_tokens"), "described")
    return drawn(rows, expectations(slim, targets))
