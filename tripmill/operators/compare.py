"""Two zones side by side: one row per metric, with the difference first minus second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.exact import mean, ratio_mean
from tripmill.operators.airport import is_airport_trip
from tripmill.operators.star import with_zone
from tripmill.plans.tables import TripTables


def _side_by_side(df: DataFrame, first: str, second: str, metrics: dict[str, Column]) -> DataFrame:
    """Aggregate rows with a ``zone`` column per zone and turn metrics into rows."""
    names = list(metrics)
    per_zone = (
        df.filter(F.col("zone").isin(first, second))
        .groupBy("zone")
        .agg(*[m.cast("double").alias(name) for name, m in metrics.items()])
    )
    long = per_zone.unpivot("zone", names, "metric", "value")
    wide = long.groupBy("metric").agg(
        F.max(F.when(F.col("zone") == first, F.col("value"))).alias("zone_a"),
        F.max(F.when(F.col("zone") == second, F.col("value"))).alias("zone_b"),
    )
    return wide.withColumn("difference", F.col("zone_a") - F.col("zone_b")).orderBy("metric")


def popularity(t: TripTables, first: str, second: str) -> DataFrame:
    """Zones of one name count as one: pickups add up, the other metrics are averaged."""
    zones = with_zone(t.mv_zone_pickup, t, "location_id", "zone", home_only=True)
    return _side_by_side(
        zones,
        first,
        second,
        {
            "pickup_count": F.sum("pickup_count"),
            "avg_fare": ratio_mean("avg_fare"),
            "avg_distance": ratio_mean("avg_distance"),
            "median_fare": ratio_mean("median_fare"),
        },
    )


def airport(t: TripTables, first: str, second: str) -> DataFrame:
    trips = t.fact_trip.filter(is_airport_trip() & (F.col("fare_amount") > 0))
    origins = with_zone(trips, t, "pu_location_id", "zone", home_only=True)
    return _side_by_side(
        origins,
        first,
        second,
        {
            "airport_trip_count": F.count("*"),
            "avg_fare": mean("fare_amount"),
            "avg_distance": mean("trip_distance"),
        },
    )


def flows(t: TripTables, first: str, second: str) -> DataFrame:
    routes = with_zone(t.mv_od_flows, t, "pu_location_id", "zone", home_only=True)
    return _side_by_side(
        routes,
        first,
        second,
        {
            "route_count": F.count("*"),
            "total_trips": F.sum("trip_count"),
            "avg_fare": ratio_mean("avg_fare"),
            "avg_distance": ratio_mean("avg_distance"),
            "avg_duration_min": ratio_mean("avg_duration_sec / 60.0D"),
            "fare_per_mile": ratio_mean("try_divide(avg_fare, avg_distance)"),
        },
    )
