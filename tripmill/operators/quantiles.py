"""Exact interpolated quantiles from counted values.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here equal values are counted first, by a plain ``groupBy`` on keys and value: most of the
work is done before the shuffle and a group with a third of all rows is spread over its
values. What is left are running totals over counted values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Intervals per doubling of the value; 256 makes each 0.27 % wide.
_PER_OCTAVE = 256
# Keeps positive intervals above zero's and negative ones below it.
_ZERO_GAP = 1 << 20


def _holds(rank: str, start: str, rows: str) -> str:
    return f"({rank} >= {start} AND {rank} < {start} + {rows})"


def _place(share: float) -> str:
    """Rank of a quantile, counted from 0 and usually between two rows."""
    return f"(CAST(_last AS DOUBLE) * {share!r}D)"


def _ends(share: float) -> tuple[str, str]:
    return f"floor({_place(share)})", f"ceil({_place(share)})"


def with_ranks(counts: DataFrame, keys: Sequence[str], value: str, count: str) -> DataFrame:
    """Add the rank of the first row of each value and of the last row of its group.

    One task handles the distinct values of a group, sorted and spilling when needed; use
    it where their number is bounded, and ``grouped_quantiles`` where it is not.
    """
    group = Window.partitionBy(*keys)
    before = group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns(
        {
            "_start": F.coalesce(F.sum(count).over(before), F.lit(0)),
            "_last": F.sum(count).over(group) - 1,
        }
    )


def quantile(share: float, value: str, count: str) -> Column:
    """Aggregate of rows from ``with_ranks``: the two rows around the place, interpolated."""
    low, high = (f"max(CASE WHEN {_holds(end, '_start', count)} THEN {value} END)" for end in _ends(share))
    return F.expr(f"{low} + ({high} - {low}) * max({_place(share)} - floor({_place(share)}))")


def _interval(value: str) -> Column:
    """Number of the interval a value lies in; grows with the value.

    Never NULL, and known to Catalyst not to be: otherwise it would add a test for that to
    one of the two uses of the counts, and the shuffle behind them could not be shared.
    """
    size = f"floor(log2(abs({value})) * {_PER_OCTAVE}) + {_ZERO_GAP}"
    return F.expr(f"coalesce(CASE WHEN {value} > 0 THEN {size} WHEN {value} < 0 THEN -({size}) END, 0)")


def grouped_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, count: str, shares: dict[str, float]
) -> DataFrame:
    """Quantiles per group for values that may all differ, such as ratios.

    Each group is cut into narrow value intervals and only those that hold a wanted rank
    are looked into, so that no task sees a whole group. ``counts`` holds each value of a
    group with its number of rows in ``count``; NULL values are left out. ``shares`` maps
    result columns to the wanted share, such as ``{"median": 0.5}``.
    """
    keys = list(keys)
    known = counts.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("_v"), F.col(count).alias("_n"), _interval(value).alias("_i")
    )
    # One row per group and interval: a few thousand per group at most.
    intervals = known.groupBy(*keys, "_i").agg(F.sum("_n").alias("_rows"))
    intervals = with_ranks(intervals, keys, "_i", "_rows")
    ranks = [end for share in shares.values() for end in _ends(share)]
    holds_any = " OR ".join(_holds(rank, "_start", "_rows") for rank in ranks)
    wanted = intervals.filter(holds_any).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_i").alias("_wanted"), F.col("_start").alias("_first"), "_last"
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_i") == F.col("_wanted")]
    inside = known.join(wanted, reduce(Column.__and__, same))
    before = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = inside.withColumn("_start", F.col("_first") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return ranked.groupBy(*keys).agg(
        *[quantile(share, "_v", "_n").alias(name) for name, share in shares.items()]
    )


# What is counted by value: which trips, which number of theirs, and whether per payment type.
MEASURES = {
    "usual_distance": ("trip_distance > 0 AND trip_distance < 200", "trip_distance", False),
    "fare": ("fare_amount > 0 AND trip_distance > 0", "fare_amount", False),
    "distance": ("fare_amount > 0 AND trip_distance > 0", "trip_distance", False),
    "duration": ("fare_amount > 0 AND trip_distance > 0", "trip_duration_seconds", False),
    "tip_percentage": ("fare_amount > 0 AND fare_amount < 500", "tip_percentage", True),
}


def value_counts(fact: DataFrame) -> DataFrame:
    """(measure, payment_type_id, value, n): how many trips have each value of each measure.

    One scan for all reports on quantiles of whole columns. Counts of several batches add up to those of
    all trips. A measure that is not counted per payment type has none in its rows.
    """
    rows = [
        f"'{name}', {'payment_type_id' if paid else 'CAST(NULL AS INT)'}, CASE WHEN {test} THEN CAST({value} AS DOUBLE) END"
        for name, (test, value, paid) in MEASURES.items()
    ]
    long = fact.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (measure, payment_type_id, value)")
    return long.filter("value IS NOT NULL").groupBy("measure", "payment_type_id", "value").agg(F.count("*").alias("n"))
