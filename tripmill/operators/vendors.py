"""Vendor share and performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions.exact import count_where, mean, minutes, percent, ratio_mean, round_half_up
from tripmill.functions.ranking import over_all
from tripmill.operators.rollups import fare_in_range
from tripmill.operators.star import with_vendor
from tripmill.plans.tables import TripTables


def performance(t: TripTables) -> DataFrame:
    """One row per vendor id, so two vendors of the same name stay apart."""
    hours = F.col("avg_duration_sec") / F.lit(3600.0)
    joined = with_vendor(t.mv_vendor_performance, t)
    return (
        joined.select(
            "vendor_id",
            "vendor_name",
            "vendor_short_name",
            "trip_count",
            percent(F.col("trip_count"), over_all(F.sum("trip_count"))).alias("market_share_pct"),
            "avg_fare",
            "avg_tip",
            "avg_distance",
            minutes(F.col("avg_duration_sec")).alias("avg_duration_min"),
            "avg_passengers",
            "store_fwd_count",
            percent(F.col("store_fwd_count"), F.col("trip_count")).alias("store_fwd_pct"),
            F.try_divide("avg_fare", "avg_distance").alias("fare_per_mile"),
            F.try_divide(F.col("avg_distance"), hours).alias("avg_speed_mph"),
        )
        .orderBy(F.col("trip_count").desc(), "vendor_id")
        .drop("vendor_id")
    )


def by_hour(t: TripTables) -> DataFrame:
    return (
        with_vendor(t.fact_trip.filter(F.col("fare_amount") > 0), t)
        .groupBy("vendor_name", "pickup_hour")
        .agg(
            F.count("*").alias("trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            mean("tip_amount").alias("avg_tip"),
        )
        .orderBy("vendor_name", "pickup_hour")
    )


def service_quality(t: TripTables) -> DataFrame:
    issues = count_where(F.col("store_and_fwd_flag") == "Y")
    tipped = count_where(F.col("tip_amount") > 0)
    return (
        with_vendor(t.fact_trip.filter(fare_in_range()), t)
        .groupBy("vendor_name")
        .agg(
            F.count("*").alias("total_trips"),
            issues.alias("connection_issues"),
            percent(issues, F.count("*")).alias("issue_rate_pct"),
            ratio_mean("avg_speed_mph").alias("avg_speed_mph"),
            ratio_mean("tip_percentage").alias("avg_tip_pct"),
            percent(tipped, F.count("*")).alias("tipping_frequency_pct"),
        )
        .orderBy(F.col("total_trips").desc(), "vendor_name")
    )


def monthly_share(t: TripTables) -> DataFrame:
    day = F.col("pickup_date")
    grouped = (
        with_vendor(t.fact_trip.filter(F.col("fare_amount") > 0), t)
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"), "vendor_name")
        .agg(F.count("*").alias("trip_count"))
    )
    of_month = F.sum("trip_count").over(Window.partitionBy("year", "month"))
    return grouped.withColumn("market_share_pct", percent(F.col("trip_count"), of_month)).orderBy(
        "year", "month", F.col("trip_count").desc(), "vendor_name"
    )


def api_performance(t: TripTables) -> DataFrame:
    return performance(t).select(
        "vendor_name",
        F.col("vendor_short_name").alias("vendor_short"),
        "trip_count",
        *[round_half_up(F.col(c), 2).alias(c) for c in ("market_share_pct", "avg_fare", "avg_tip", "avg_distance")],
        round_half_up(F.col("avg_duration_min"), 1).alias("avg_duration_min"),
    )
