"""The six reusable rollups and the summary row, each one aggregation of the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.exact import AMOUNT_STEP, count_where, int_mean, mean, ratio_mean, total, units
from tripmill.operators.quantiles import quantile, with_ranks


def fare_in_range(most: float = 500.0) -> Column:
    return (F.col("fare_amount") > 0) & (F.col("fare_amount") < most)


def metered() -> Column:
    return fare_in_range() & (F.col("trip_distance") > 0)


def route_fares(fact: DataFrame) -> DataFrame:
    """Trips per route and fare, with the sums the averages need.

    The common ground of the zone and route rollups, so that three of them cost one scan of
    the fact table. Fares are kept as they are, so medians are fares that occur; fares in
    whole cents below 500 bound the rows of a route by 50,000. A route holding a
    third of all trips is reduced before the shuffle and spread over its fares in it.
    """
    return (
        fact.filter(metered())
        .groupBy("pu_location_id", "do_location_id", F.col("fare_amount").alias("fare"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.expr(units("trip_distance"))).alias("miles"),
            F.sum("trip_duration_seconds").alias("seconds"),
        )
    )


def _fare_quantile(share: float) -> Column:
    return quantile(share, "fare", "n")


def _counted_means() -> dict[str, Column]:
    return {
        "fare": F.expr(f"CAST(sum({units('fare')} * n) AS DOUBLE) / {AMOUNT_STEP}D / sum(n)"),
        "distance": F.expr(f"CAST(sum(miles) AS DOUBLE) / {AMOUNT_STEP}D / sum(n)"),
        "seconds": F.expr("CAST(sum(seconds) AS DOUBLE) / sum(n)"),
    }


def zone_pickup(routes: DataFrame) -> DataFrame:
    """From ``route_fares``: destinations are merged, then fares ranked within a zone."""
    means = _counted_means()
    fares = routes.groupBy("pu_location_id", "fare").agg(
        *[F.sum(c).alias(c) for c in ("n", "miles", "seconds")]
    )
    return (
        with_ranks(fares, ["pu_location_id"], "fare", "n")
        .groupBy(F.col("pu_location_id").alias("location_id"))
        .agg(
            F.sum("n").alias("pickup_count"),
            means["fare"].alias("avg_fare"),
            means["distance"].alias("avg_distance"),
            means["seconds"].alias("avg_duration"),
            _fare_quantile(0.5).alias("median_fare"),
        )
    )


def zone_dropoff(routes: DataFrame) -> DataFrame:
    """From ``route_fares``."""
    means = _counted_means()
    return routes.groupBy(F.col("do_location_id").alias("location_id")).agg(
        F.sum("n").alias("dropoff_count"),
        means["fare"].alias("avg_fare"),
        means["distance"].alias("avg_distance"),
    )


def od_flows(routes: DataFrame, min_trips: int = 100) -> DataFrame:
    """From ``route_fares``; routes with few trips are left out."""
    means = _counted_means()
    keys = ["pu_location_id", "do_location_id"]
    return (
        with_ranks(routes, keys, "fare", "n")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("trip_count"),
            means["fare"].alias("avg_fare"),
            means["distance"].alias("avg_distance"),
            means["seconds"].alias("avg_duration_sec"),
            _fare_quantile(0.5).alias("median_fare"),
            _fare_quantile(0.9).alias("p90_fare"),
        )
        .filter(F.col("trip_count") >= min_trips)
    )


def hourly_demand(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("fare_amount") > 0)
        .groupBy("pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend")
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            total("total_amount").alias("total_revenue"),
            mean("trip_distance").alias("avg_distance"),
            int_mean("passenger_count").alias("avg_passengers"),
        )
    )


def vendor_performance(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("fare_amount") > 0)
        .groupBy("vendor_id")
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("tip_amount").alias("avg_tip"),
            mean("trip_distance").alias("avg_distance"),
            int_mean("trip_duration_seconds").alias("avg_duration_sec"),
            count_where(F.col("store_and_fwd_flag") == "Y").alias("store_fwd_count"),
            int_mean("passenger_count").alias("avg_passengers"),
        )
    )


def payment_patterns(fact: DataFrame) -> DataFrame:
    tipped = count_where(F.col("tip_amount") > 0)
    return (
        fact.filter(fare_in_range())
        .groupBy("payment_type_id", "pickup_hour", "is_weekend")
        .agg(
            F.count("*").alias("trip_count"),
            mean("tip_amount").alias("avg_tip"),
            mean("fare_amount").alias("avg_fare"),
            ratio_mean("try_divide(tip_amount, fare_amount) * 100.0D").alias("avg_tip_pct"),
            tipped.alias("trips_with_tip"),
            (F.count("*") - tipped).alias("trips_no_tip"),
        )
    )


def summary_statistics(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("fare_amount") > 0).agg(
        F.lit("overall").alias("metric_type"),
        F.count("*").alias("total_trips"),
        total("fare_amount").alias("total_fare_amount"),
        total("tip_amount").alias("total_tips"),
        total("total_amount").alias("total_revenue"),
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        int_mean("trip_duration_seconds").alias("avg_duration"),
        int_mean("passenger_count").alias("avg_passengers"),
        F.min("pickup_datetime").alias("first_trip_date"),
        F.max("pickup_datetime").alias("last_trip_date"),
    )
