"""Approximate quantiles from mergeable KLL sketches.

A sketch has a fixed size whatever it has seen, and sketches of batches are merged into one of all trips; an exact
quantile needs every distinct value. ``SIZE`` bounds the error: the rank of what a sketch gives differs from the wanted
share by less than ``RANK_ERROR`` in 99 of 100 cases. Counts stay exact. A sketch gives a value that occurs,
so nothing is interpolated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.exact import int_mean, mean
from tripmill.operators.quantiles import MEASURES
from tripmill.operators.rollups import metered

SIZE = 1024
RANK_ERROR = 0.005


def value_sketches(fact: DataFrame) -> DataFrame:
    """One row with a sketch per measure that is not counted per payment type; one scan."""
    return fact.agg(
        *[_sketch(f"CASE WHEN {test} THEN {value} END").alias(name) for name, (test, value, paid) in MEASURES.items() if not paid]
    )


def payment_sketches(fact: DataFrame) -> DataFrame:
    """(payment_type_id, tip_percentage) with a sketch of the tip ratios of each payment type."""
    test, value, _ = MEASURES["tip_percentage"]
    return fact.filter(test).groupBy("payment_type_id").agg(_sketch(value).alias("tip_percentage"))


def zone_pickup(fact: DataFrame) -> DataFrame:
    """The rollup of pickup zones with a median from sketches: one aggregation, which shuffles a row per zone and task."""
    return (
        fact.filter(metered())
        .groupBy(F.col("pu_location_id").alias("location_id"))
        .agg(
            F.count("*").alias("pickup_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            int_mean("trip_duration_seconds").alias("avg_duration"),
            quantile(_sketch("fare_amount"), 0.5).alias("median_fare"),
        )
    )


def od_flows(fact: DataFrame, min_trips: int = 100) -> DataFrame:
    """The rollup of routes with quantiles from sketches."""
    grouped = (
        fact.filter(metered())
        .groupBy("pu_location_id", "do_location_id")
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            int_mean("trip_duration_seconds").alias("avg_duration_sec"),
            _sketch("fare_amount").alias("_fares"),
        )
        .filter(F.col("trip_count") >= min_trips)
    )
    wanted = {"median_fare": 0.5, "p90_fare": 0.9}
    return grouped.withColumns({name: quantile(F.col("_fares"), share) for name, share in wanted.items()}).drop("_fares")


def merged_values(sketches: DataFrame) -> DataFrame:
    return sketches.agg(*[merge(name).alias(name) for name, (_, _, paid) in MEASURES.items() if not paid])


def merged_payments(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("payment_type_id").agg(merge("tip_percentage").alias("tip_percentage"))


def _sketch(value: str) -> Column:
    return F.kll_sketch_agg_double(F.expr(f"CAST({value} AS DOUBLE)"), F.lit(SIZE))


def merge(sketch: str) -> Column:
    """Aggregate of sketches."""
    return F.kll_merge_agg_double(sketch, F.lit(SIZE))


def quantile(sketch: Column, share: float) -> Column:
    """NULL for a sketch that has seen nothing."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
