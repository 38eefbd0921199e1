"""Zone popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import API_ROWS, check_limit
from tripmill.functions.exact import mean, minutes, round_half_up
from tripmill.functions.ranking import top, top_ranked
from tripmill.operators.clean import month_of
from tripmill.operators.star import with_zone
from tripmill.plans.tables import TripTables


def _home_rollup(t: TripTables, rollup: DataFrame) -> DataFrame:
    home = F.lit(t.settings.home)
    return with_zone(rollup, t, "location_id", "zone", home_only=True).withColumn("borough", home)


def top_pickup(t: TripTables, limit: int = 20) -> DataFrame:
    rows = _home_rollup(t, t.mv_zone_pickup).select(
        "zone",
        "borough",
        "pickup_count",
        "avg_fare",
        "avg_distance",
        "median_fare",
        minutes(F.col("avg_duration")).alias("avg_duration_min"),
    )
    return top_ranked(rows, check_limit(limit), "pickup_count", "popularity_rank")


def top_dropoff(t: TripTables, limit: int = 20) -> DataFrame:
    rows = _home_rollup(t, t.mv_zone_dropoff).select(
        "zone", "borough", "dropoff_count", "avg_fare", "avg_distance"
    )
    return top_ranked(rows, check_limit(limit), "dropoff_count", "popularity_rank")


def activity_score(t: TripTables, limit: int = 30) -> DataFrame:
    """Pickups and dropoffs per zone; zones without trips are kept with zeros."""
    pickups = t.mv_zone_pickup.select("location_id", "pickup_count", F.col("avg_fare").alias("_fare_from"))
    dropoffs = t.mv_zone_dropoff.select("location_id", "dropoff_count", F.col("avg_fare").alias("_fare_to"))
    joined = (
        t.dim_location.filter(F.col("borough") == t.settings.home)
        .join(pickups, "location_id", "left")
        .join(dropoffs, "location_id", "left")
        .na.fill(0, ["pickup_count", "dropoff_count"])
        .na.fill(0.0, ["_fare_from", "_fare_to"])
    )
    # A zone is one-sided beyond this ratio.
    ratio = 1.5
    out, into = F.col("pickup_count"), F.col("dropoff_count")
    rows = joined.select(
        "zone",
        "pickup_count",
        "dropoff_count",
        (out + into).alias("total_activity"),
        ((F.col("_fare_from") + F.col("_fare_to")) / 2).alias("combined_avg_fare"),
        F.when(out > into * F.lit(ratio), "Origin Zone")
        .when(into > out * F.lit(ratio), "Destination Zone")
        .otherwise("Balanced")
        .alias("zone_type"),
    )
    return top(rows, check_limit(limit), F.col("total_activity").desc())


def recent_start(t: TripTables):
    """First day of the recent window: a constant of the query, so it prunes the scan.

    The latest date comes from the hourly rollup, which is far smaller than the fact table.
    """
    days = t.settings.recent_days
    if t.settings.as_of is not None:
        return F.date_sub(F.lit(t.settings.as_of), days)
    latest = t.mv_hourly_demand.agg(F.max("pickup_date")).scalar()
    return F.date_sub(latest, days)


def activity_by_hour(t: TripTables) -> DataFrame:
    start = recent_start(t)
    # The month is the partition column of the fact table; the start is a constant, so it prunes.
    recent = t.fact_trip.filter((F.col("pickup_month") >= month_of(start)) & (F.col("pickup_date") >= start))
    recent = recent.filter(F.col("fare_amount") > 0)
    return (
        with_zone(recent, t, "pu_location_id", "zone", home_only=True)
        .groupBy("zone", "pickup_hour")
        .agg(F.count("*").alias("trip_count"), mean("fare_amount").alias("avg_fare"))
        .orderBy("zone", "pickup_hour")
    )


def api_top_pickup(t: TripTables, limit: int = 20) -> DataFrame:
    rows = _home_rollup(t, t.mv_zone_pickup)
    kept = top(
        rows.select("zone", "borough", "pickup_count", "avg_fare", "avg_distance", "median_fare"),
        check_limit(limit, API_ROWS),
        F.col("pickup_count").desc(),
    )
    return kept.withColumns(
        {c: round_half_up(F.col(c), 2) for c in ("avg_fare", "avg_distance", "median_fare")}
    )


def api_top_dropoff(t: TripTables, limit: int = 20) -> DataFrame:
    rows = _home_rollup(t, t.mv_zone_dropoff)
    kept = top(
        rows.select("zone", "borough", "dropoff_count", "avg_fare", "avg_distance"),
        check_limit(limit, API_ROWS),
        F.col("dropoff_count").desc(),
    )
    return kept.withColumns({c: round_half_up(F.col(c), 2) for c in ("avg_fare", "avg_distance")})


def api_stats(t: TripTables) -> DataFrame:
    return t.summary_statistics.select(
        "total_trips",
        round_half_up(F.col("total_revenue"), 2).alias("total_revenue"),
        round_half_up(F.col("avg_fare"), 2).alias("avg_fare"),
        round_half_up(F.col("avg_distance"), 2).alias("avg_distance"),
        round_half_up(minutes(F.col("avg_duration")), 1).alias("avg_duration_min"),
        F.col("first_trip_date").alias("date_range_start"),
        F.col("last_trip_date").alias("date_range_end"),
    )
