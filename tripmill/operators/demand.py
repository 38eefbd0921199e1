"""Temporal demand, all from the hourly rollup.

The rollup has one row per date and hour, so averages here are plain averages over those
rows, not weighted by trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.exact import int_mean, percent, ratio_mean, round_half_up, total
from tripmill.functions.ranking import over_all
from tripmill.plans.tables import TripTables

# Names of the days, Sunday first.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _day_name() -> Column:
    days = F.array(*[F.lit(d) for d in DAY_NAMES])
    return F.element_at(days, F.col("pickup_day_of_week") + 1)


def _trips() -> Column:
    return F.sum("trip_count")


def hourly(t: TripTables) -> DataFrame:
    grouped = t.mv_hourly_demand.groupBy("pickup_hour").agg(
        _trips().alias("total_trips"),
        ratio_mean("avg_fare").alias("avg_fare"),
        total("total_revenue").alias("total_revenue"),
    )
    share = percent(F.col("total_trips"), over_all(F.sum("total_trips")))
    return grouped.withColumn("pct_of_total", share).orderBy("pickup_hour")


def day_of_week(t: TripTables) -> DataFrame:
    return (
        t.mv_hourly_demand.groupBy("pickup_day_of_week", "is_weekend")
        .agg(
            _trips().alias("total_trips"),
            ratio_mean("avg_fare").alias("avg_fare"),
            total("total_revenue").alias("total_revenue"),
        )
        .withColumn("day_name", _day_name())
        .select("pickup_day_of_week", "day_name", "is_weekend", "total_trips", "avg_fare", "total_revenue")
        .orderBy("pickup_day_of_week")
    )


def heatmap(t: TripTables) -> DataFrame:
    """Weekday by hour, with demand relative to the busiest cell."""
    cells = t.mv_hourly_demand.groupBy("pickup_day_of_week", "pickup_hour").agg(
        _trips().alias("trip_count"), ratio_mean("avg_fare").alias("avg_fare")
    )
    relative = F.col("trip_count").cast("double") / over_all(F.max("trip_count"))
    return cells.withColumn("normalized_demand", relative).orderBy("pickup_day_of_week", "pickup_hour")


def monthly_trend(t: TripTables) -> DataFrame:
    day = F.col("pickup_date")
    return (
        t.mv_hourly_demand.groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(
            _trips().alias("total_trips"),
            ratio_mean("avg_fare").alias("avg_fare"),
            total("total_revenue").alias("total_revenue"),
            (_trips().cast("double") / F.count_distinct("pickup_date")).alias("avg_trips_per_day"),
        )
        .orderBy("year", "month")
    )


def weekend_vs_weekday(t: TripTables) -> DataFrame:
    return (
        t.mv_hourly_demand.groupBy("is_weekend", "pickup_hour")
        .agg(
            _trips().alias("total_trips"),
            ratio_mean("avg_fare").alias("avg_fare"),
            ratio_mean("avg_distance").alias("avg_distance"),
        )
        .orderBy("is_weekend", "pickup_hour")
    )


def rush_hour(t: TripTables) -> DataFrame:
    """Mean trips per hour of day, over the dates on which that hour had trips."""
    hour = F.col("pickup_hour")
    # Inclusive hour ranges and their names.
    category = (
        F.when(hour.between(7, 9), "Morning Rush")
        .when(hour.between(17, 19), "Evening Rush")
        .when(hour.between(0, 5), "Late Night")
        .otherwise("Regular Hours")
    )
    return (
        t.mv_hourly_demand.groupBy("pickup_hour")
        .agg(int_mean("trip_count").alias("avg_hourly_trips"))
        .withColumn("time_category", category)
        .orderBy(F.col("avg_hourly_trips").desc(), "pickup_hour")
    )


def api_hourly(t: TripTables) -> DataFrame:
    return (
        t.mv_hourly_demand.groupBy(F.col("pickup_hour").alias("hour"))
        .agg(
            _trips().alias("total_trips"),
            round_half_up(ratio_mean("avg_fare"), 2).alias("avg_fare"),
            round_half_up(total("total_revenue"), 2).alias("total_revenue"),
        )
        .orderBy("hour")
    )


def api_day_of_week(t: TripTables) -> DataFrame:
    return day_of_week(t).select(
        F.col("pickup_day_of_week").alias("day_number"),
        "day_name",
        "is_weekend",
        "total_trips",
        round_half_up(F.col("avg_fare"), 2).alias("avg_fare"),
    )


def api_heatmap(t: TripTables) -> DataFrame:
    return (
        t.mv_hourly_demand.groupBy(F.col("pickup_day_of_week").alias("day"), F.col("pickup_hour").alias("hour"))
        .agg(_trips().alias("trips"))
        .orderBy("day", "hour")
    )
