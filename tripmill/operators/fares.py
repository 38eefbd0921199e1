"""Fare structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.bands import Bands
from tripmill.functions.exact import count_where, mean, percent, ratio_mean, round_half_up, total
from tripmill.functions.ranking import over_all
from tripmill.operators.rollups import fare_in_range
from tripmill.operators.star import with_rate_code
from tripmill.plans.tables import TripTables

# Ranges of the tip-to-fare ratio. A negative tip falls into the second,
# a missing ratio into the last.
TIP_RANGES = Bands("0% (No Tip)", "1-9%", "10-14%", "15-19%", "20-24%", "25-29%", "30%+")


def _share_of_total(name: str) -> Column:
    return ratio_mean(f"try_divide({name}, total_amount) * 100.0D")


# Charge columns and what their average is called in the reports.
_AVERAGES = {
    "fare_amount": "avg_base_fare",
    "extra": "avg_extra",
    "mta_tax": "avg_mta_tax",
    "tip_amount": "avg_tip",
    "tolls_amount": "avg_tolls",
    "improvement_surcharge": "avg_improvement_surcharge",
    "congestion_surcharge": "avg_congestion_surcharge",
    "airport_fee": "avg_airport_fee",
    "cbd_congestion_fee": "avg_cbd_fee",
    "total_amount": "avg_total",
}
_TOTALS = {
    "fare_amount": "total_base_fare",
    "tip_amount": "total_tips",
    "tolls_amount": "total_tolls",
    "congestion_surcharge": "total_congestion",
    "total_amount": "total_revenue",
}
_SHARES = {
    "tip_amount": "tip_pct_of_total",
    "tolls_amount": "tolls_pct_of_total",
    "congestion_surcharge": "congestion_pct_of_total",
}


def breakdown(t: TripTables) -> DataFrame:
    return t.fact_trip.filter(fare_in_range() & (F.col("total_amount") > 0)).agg(
        F.count("*").alias("total_trips"),
        *[mean(c).alias(name) for c, name in _AVERAGES.items()],
        *[total(c).alias(name) for c, name in _TOTALS.items()],
        *[_share_of_total(c).alias(name) for c, name in _SHARES.items()],
    )


def surcharge_frequency(t: TripTables) -> DataFrame:
    # Surcharge columns and the short names used for them.
    counted = {
        "congestion": "congestion_surcharge",
        "airport_fee": "airport_fee",
        "cbd_fee": "cbd_congestion_fee",
        "tolls": "tolls_amount",
        "extra": "extra",
    }
    applied = {name: F.col(column) > 0 for name, column in counted.items()}
    return t.fact_trip.filter(fare_in_range()).agg(
        F.count("*").alias("total_trips"),
        *[count_where(test).alias(f"trips_with_{name}") for name, test in applied.items()],
        *[
            percent(count_where(applied[name]), F.count("*")).alias(f"{name}_pct")
            for name in ("congestion", "airport_fee", "cbd_fee", "tolls")
        ],
        *[
            mean(f"CASE WHEN {counted[name]} > 0 THEN {counted[name]} END").alias(f"avg_{name}_when_applied")
            for name in ("congestion", "airport_fee", "tolls")
        ],
    )


def by_rate_code(t: TripTables) -> DataFrame:
    return (
        with_rate_code(t.fact_trip.filter(fare_in_range()), t)
        .groupBy("rate_code_name")
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("tip_amount").alias("avg_tip"),
            mean("tolls_amount").alias("avg_tolls"),
            mean("extra").alias("avg_extra"),
            mean("total_amount").alias("avg_total"),
            ratio_mean("tip_percentage").alias("avg_tip_percentage"),
        )
        .orderBy(F.col("trip_count").desc(), "rate_code_name")
    )


def tip_ratio_distribution(t: TripTables) -> DataFrame:
    ratio = F.col("tip_percentage")
    band = TIP_RANGES.number(F.col("tip_amount") == 0, *[ratio < limit for limit in (10, 15, 20, 25, 30)])
    grouped = (
        t.fact_trip.filter(fare_in_range())
        .groupBy(band.alias("band"))
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare_in_range"),
            mean("tip_amount").alias("avg_tip_in_range"),
        )
    )
    shares = grouped.withColumn("pct_of_trips", percent(F.col("trip_count"), over_all(F.sum("trip_count"))))
    return shares.orderBy("band").select(
        TIP_RANGES.label(F.col("band")).alias("tip_range"),
        "trip_count",
        "pct_of_trips",
        "avg_fare_in_range",
        "avg_tip_in_range",
    )


def api_breakdown(t: TripTables) -> DataFrame:
    """Average components of all trips, the free ones included."""
    # Field names of the response.
    fields = {
        "fare_amount": "base_fare",
        "extra": "extra",
        "mta_tax": "mta_tax",
        "tip_amount": "tip",
        "tolls_amount": "tolls",
        "improvement_surcharge": "improvement_surcharge",
        "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "airport_fee",
        "total_amount": "total",
    }
    return t.fact_trip.filter(fare_in_range()).agg(
        F.count("*").alias("total_trips"),
        *[round_half_up(mean(c), 2).alias(name) for c, name in fields.items()],
        round_half_up(_share_of_total("tip_amount"), 2).alias("tip_percentage_of_total"),
    )


def api_surcharges(t: TripTables) -> DataFrame:
    full = surcharge_frequency(t)
    names = ["congestion", "airport_fee", "tolls"]
    return full.select(
        "total_trips",
        *[F.col(f"trips_with_{n}").alias(f"{n}_count") for n in names],
        *[round_half_up(F.col(f"{n}_pct"), 2).alias(f"{n}_pct") for n in names],
    )
