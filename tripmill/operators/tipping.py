"""Payment methods and tipping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.bands import Bands
from tripmill.functions.exact import (
    count_where,
    int_mean,
    mean,
    minutes,
    percent,
    ratio_mean,
    round_half_up,
)
from tripmill.functions.ranking import over_all
from tripmill.operators import sketches
from tripmill.operators.quantiles import grouped_quantiles
from tripmill.operators.rollups import fare_in_range
from tripmill.operators.star import with_payment_type
from tripmill.plans.tables import TripTables

# Classes of tippers. Ratios between two classes (such as 14.95) belong to
# the last one, as does a missing ratio.
TIPPERS = Bands(
    "No Tip",
    "Low (1-9%)",
    "Standard (10-15%)",
    "Good (15-20%)",
    "Generous (20-30%)",
    "Very Generous (30%+)",
)
# Ranges of distance and fare.
DISTANCE_RANGES = Bands("<1 mi", "1-2 mi", "2-5 mi", "5-10 mi", "10+ mi")
FARE_RANGES = Bands("<$10", "$10-20", "$20-30", "$30-50", "$50+")
_MILE_LIMITS = [1, 2, 5, 10]
_FARE_LIMITS = [10, 20, 30, 50]

_PAYMENT = ["payment_type_name", "is_card_payment", "allows_tip"]


def _tipped() -> Column:
    return count_where(F.col("tip_amount") > 0)


def _paid(t: TripTables) -> DataFrame:
    return with_payment_type(t.fact_trip.filter(fare_in_range()), t)


def by_payment_type(t: TripTables, approx: bool = False) -> DataFrame:
    """Share, tips and tip quartiles per payment type; with ``approx`` the quartiles come from sketches.

    The sums shuffle a handful of rows. The quartiles need every distinct ratio, and ratios
    are as good as unbounded, hence the operator that never gathers a group in one task.
    """
    grouped = (
        _paid(t)
        .groupBy(*_PAYMENT)
        .agg(
            F.count("*").alias("trip_count"),
            mean("tip_amount").alias("avg_tip"),
            mean("fare_amount").alias("avg_fare"),
            ratio_mean("tip_percentage").alias("avg_tip_pct"),
            _tipped().alias("trips_with_tip"),
        )
    )
    # Counted by id, then named: a value may come twice in a group of that name, which the
    # ranks take in their stride.
    shares = {"tip_pct_q25": 0.25, "tip_pct_median": 0.5, "tip_pct_q75": 0.75}
    if approx:
        tips = with_payment_type(t.payment_sketches, t).groupBy(*_PAYMENT).agg(sketches.merge("tip_percentage").alias("tips"))
        quartiles = tips.select(*_PAYMENT, *[sketches.quantile(F.col("tips"), s).alias(n) for n, s in shares.items()])
    else:
        counts = t.value_counts.filter(F.col("measure") == "tip_percentage")
        counts = with_payment_type(counts.withColumnRenamed("value", "tip_percentage"), t)
        quartiles = grouped_quantiles(counts, _PAYMENT, "tip_percentage", "n", shares)
    quartiles = quartiles.withColumnsRenamed({k: f"_{k}" for k in _PAYMENT})
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in _PAYMENT])
    joined = grouped.join(quartiles, same, "left").drop(*[f"_{k}" for k in _PAYMENT])
    return (
        joined.withColumns(
            {
                "pct_of_trips": percent(F.col("trip_count"), over_all(F.sum("trip_count"))),
                "tipping_frequency_pct": percent(F.col("trips_with_tip"), F.col("trip_count")),
            }
        )
        .orderBy(F.col("trip_count").desc(), *_PAYMENT)
    )


def tipping_by_hour(t: TripTables) -> DataFrame:
    return (
        with_payment_type(t.mv_payment_patterns, t)
        .orderBy("payment_type_name", "is_weekend", "pickup_hour", "payment_type_id")
        .select(
            "payment_type_name",
            "pickup_hour",
            "is_weekend",
            "trip_count",
            "avg_tip",
            "avg_fare",
            "avg_tip_pct",
            percent(F.col("trips_with_tip"), F.col("trip_count")).alias("tipping_frequency_pct"),
        )
    )


def tipper_categories(t: TripTables) -> DataFrame:
    ratio = F.col("tip_percentage")
    band = TIPPERS.number(
        ratio == 0, ratio < 10, ratio.between(10, 14.9), ratio.between(15, 19.9), ratio.between(20, 29.9)
    )
    grouped = (
        _paid(t)
        .filter("allows_tip")
        .groupBy(band.alias("band"))
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            minutes(int_mean("trip_duration_seconds")).alias("avg_duration_min"),
        )
    )
    shares = grouped.withColumn("pct_of_trips", percent(F.col("trip_count"), over_all(F.sum("trip_count"))))
    return shares.orderBy("band").select(
        TIPPERS.label(F.col("band")).alias("tipper_category"),
        "trip_count",
        "pct_of_trips",
        "avg_fare",
        "avg_distance",
        "avg_duration_min",
    )


def tip_by_trip_bands(t: TripTables) -> DataFrame:
    miles = DISTANCE_RANGES.below(F.col("trip_distance"), _MILE_LIMITS)
    fares = FARE_RANGES.below(F.col("fare_amount"), _FARE_LIMITS)
    grouped = (
        _paid(t)
        .filter("allows_tip")
        .groupBy(miles.alias("miles"), fares.alias("fares"))
        .agg(
            F.count("*").alias("trip_count"),
            ratio_mean("tip_percentage").alias("avg_tip_pct"),
            percent(_tipped(), F.count("*")).alias("tipping_frequency_pct"),
        )
    )
    return grouped.select(
        DISTANCE_RANGES.label(F.col("miles")).alias("distance_range"),
        FARE_RANGES.label(F.col("fares")).alias("fare_range"),
        "trip_count",
        "avg_tip_pct",
        "tipping_frequency_pct",
    ).orderBy("distance_range", "fare_range")


def api_by_payment_type(t: TripTables) -> DataFrame:
    grouped = (
        _paid(t)
        .groupBy(*_PAYMENT)
        .agg(
            F.count("*").alias("trip_count"),
            round_half_up(mean("tip_amount"), 2).alias("avg_tip"),
            round_half_up(mean("fare_amount"), 2).alias("avg_fare"),
            round_half_up(ratio_mean("tip_percentage"), 2).alias("avg_tip_pct"),
            round_half_up(percent(_tipped(), F.count("*")), 2).alias("tipping_frequency_pct"),
        )
    )
    share = round_half_up(percent(F.col("trip_count"), over_all(F.sum("trip_count"))), 2)
    return (
        grouped.withColumn("pct_of_trips", share)
        .withColumnRenamed("payment_type_name", "payment_type")
        .withColumnRenamed("is_card_payment", "is_card")
        .orderBy(F.col("trip_count").desc(), "payment_type", "is_card", "allows_tip")
    )
