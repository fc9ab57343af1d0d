"""Aggregates over many nested trailing windows in one pass.

All windows end at ``as_of``, so each is a prefix of the list of *age bands*: with edges 7, 30, 90 a row of
age 12 lies in band 30 and therefore in every window of 30 days or more. The rows are reduced once to one
small record per (key, band); the windows are then sums over those few records.

An exact distinct count fits in as well: a member (say, a product category) occurs in a window exactly if its
newest occurrence does, so it is enough to know its smallest band.

Shuffles, with what each of them carries:

1. (key, role, band or member): raw rows, already combined on the map side, once for the measures and once
   for the members. A key that owns a third of all rows leaves each map task as a handful of records.
   Without members this is (key, band) and step 2 falls away.
2. (key, band): one record per member of step 1, combined again before the exchange.
3. (key): at most one record per band. The wide per-window columns exist only behind this exchange, so they
   are never shuffled; the result is partitioned by the key, ready for the join with the customer table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURE, MEMBER = 0, 1


def band_edges(windows: Sequence[int], halves: bool = False) -> list[int]:
    edges = set(windows)
    if halves:
        edges |= {w // 2 for w in windows}
    return sorted(edges)


def within(rows: DataFrame, date_column: str, as_of: date, days: int) -> DataFrame:
    """Rows dated in ``[as_of - days, as_of]``, written so that the range reaches the scan."""
    end = F.lit(as_of)
    return rows.filter((F.col(date_column) >= F.date_sub(end, days)) & (F.col(date_column) <= end))


def band(age: str, edges: Sequence[int]) -> str:
    """SQL for the smallest edge that is not below the age."""
    return "CASE " + " ".join(f"WHEN {age} <= {edge} THEN {edge}" for edge in edges) + " END"


def band_records(
    rows: DataFrame,
    key: str,
    date_column: str,
    as_of: date,
    edges: Sequence[int],
    measures: dict[str, str],
    facts: dict[str, str],
    members: dict[str, str],
) -> DataFrame:
    """One record per (key, band) with the given facts and, per member kind, how many members are newest there.

    All expressions are SQL text.

    measures  row-level inputs of the facts, by name
    facts     aggregates over the measures (``age`` is available too)
    members   member kind -> text value of the row (NULL where the row has no such member); kinds must not
              overlap on a row
    """
    aged = within(rows, date_column, as_of, edges[-1]).selectExpr(
        key,
        f"datediff(DATE '{as_of.isoformat()}', {date_column}) AS age",
        *[f"{value} AS {name}" for name, value in {**_member_columns(members), **measures}.items()],
    )
    narrow = aged.selectExpr("*", f"{band('age', edges)} AS band")
    aggregates = [F.expr(f"{fact} AS {name}") for name, fact in facts.items()]
    if not members:
        return narrow.groupBy(key, "band").agg(*aggregates)
    # Two copies of each row, one per role; a copy carries only what its role needs.
    types = dict(narrow.dtypes)
    nothing = {name: f"CAST(NULL AS {types[name]})" for name in ("age", "kind", "member", "band", *measures)}
    as_measure = [
        f"'role', {MEASURE}, 'group_band', band, 'kind', {nothing['kind']}, 'member', {nothing['member']}",
        "'seen', band, 'age', age",
        *[f"'{name}', {name}" for name in measures],
    ]
    as_member = [
        f"'role', {MEMBER}, 'group_band', {nothing['band']}, 'kind', kind, 'member', member",
        f"'seen', band, 'age', {nothing['age']}",
        *[f"'{name}', {nothing[name]}" for name in measures],
    ]
    copies = narrow.selectExpr(
        key, f"inline(array(named_struct({', '.join(as_measure)}), named_struct({', '.join(as_member)})))"
    ).filter(f"role = {MEASURE} OR member IS NOT NULL")
    first = copies.groupBy(key, "role", "group_band", "kind", "member").agg(
        F.min("seen").alias("newest"), *aggregates
    )
    # Facts of the member role are dropped here; each (key, band) has exactly one measure record.
    return first.groupBy(key, F.col("newest").alias("band")).agg(
        *[F.expr(f"max(CASE WHEN role = {MEASURE} THEN {name} END) AS {name}") for name in facts],
        *[F.expr(f"count_if(kind = '{name}') AS {name}") for name in members],
    )


def _member_columns(members: dict[str, str]) -> dict[str, str]:
    if not members:
        return {}
    kinds = " ".join(f"WHEN {value} IS NOT NULL THEN '{name}'" for name, value in members.items())
    return {"kind": f"CASE {kinds} END", "member": f"coalesce({', '.join(members.values())})"}


def over_windows(records: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Combine the band records of each key: a bounded number of rows per key, wide columns built locally."""
    return records.repartition(key).groupBy(key).agg(*[F.expr(f"{sql} AS {name}") for name, sql in columns.items()])


def up_to(days: int, column: str, combine: str = "sum") -> str:
    """SQL for the sum (or other aggregate) of a fact over the bands of one window; NULL if the key has no band there."""
    return f"{combine}(CASE WHEN band <= {days} THEN {column} END)"


def only(edge: int, column: str) -> str:
    """SQL for a fact of one band; NULL if the key has no such band."""
    return f"max(CASE WHEN band = {edge} THEN {column} END)"
