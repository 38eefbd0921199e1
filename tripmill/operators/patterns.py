"""Reports computed on the fact table directly, without the rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import check_limit
from tripmill.functions.exact import int_mean, mean, minutes, percent
from tripmill.functions.ranking import over_all, top
from tripmill.operators.star import with_both_zones, with_vendor, with_zone
from tripmill.plans.tables import TripTables


def zone_popularity(t: TripTables, limit: int = 10) -> DataFrame:
    rows = (
        with_zone(t.fact_trip, t, "pu_location_id", "zone", home_only=True)
        .groupBy("zone")
        .agg(F.count("*").alias("trip_count"), mean("fare_amount").alias("avg_fare"))
    )
    return top(rows, check_limit(limit), F.col("trip_count").desc())


def hourly_since(t: TripTables, start: dt.date = dt.date(2025, 1, 1)) -> DataFrame:
    return (
        t.fact_trip.filter((F.col("pickup_month") >= f"{start:%Y-%m}") & (F.col("pickup_date") >= F.lit(start)))
        .groupBy("pickup_hour")
        .agg(F.count("*").alias("trip_count"), mean("trip_distance").alias("avg_distance"))
        .orderBy("pickup_hour")
    )


def od_flows(t: TripTables, limit: int = 100) -> DataFrame:
    """Routes by zone name, with no smallest size."""
    rows = (
        with_both_zones(t.fact_trip, t, "origin", "destination", home_only=True)
        .groupBy("origin", "destination")
        .agg(
            F.count("*").alias("trip_count"),
            mean("trip_distance").alias("avg_distance"),
            minutes(int_mean("trip_duration_seconds")).alias("avg_duration_min"),
        )
    )
    return top(rows, check_limit(limit), F.col("trip_count").desc())


def fare_anomaly(t: TripTables, limit: int = 100) -> DataFrame:
    dear = (F.col("trip_distance") > 0.5) & (F.col("fare_amount") > 0) & (F.col("fare_per_mile") > 50)
    rows = with_zone(t.fact_trip.filter(dear), t, "pu_location_id", "zone").select(
        "trip_id", "zone", "fare_amount", "trip_distance", "fare_per_mile"
    )
    return top(rows, check_limit(limit), F.col("fare_per_mile").desc())


def vendor_share(t: TripTables) -> DataFrame:
    counted = with_vendor(t.fact_trip, t).groupBy("vendor_name").agg(F.count("*").alias("trip_count"))
    share = percent(F.col("trip_count"), over_all(F.sum("trip_count")))
    return counted.withColumn("market_share_pct", share).orderBy("vendor_name")
