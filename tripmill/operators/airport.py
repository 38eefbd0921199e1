"""Airport trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import API_ROWS, check_limit
from tripmill.functions.bands import Bands
from tripmill.functions.exact import count_where, int_mean, mean, minutes, percent, ratio_mean, round_half_up, total
from tripmill.functions.ranking import over_all, top
from tripmill.operators.rollups import fare_in_range
from tripmill.operators.star import with_rate_code, with_zone
from tripmill.plans.tables import TripTables

# The rate codes of the two airports with their own fare.
JFK, NEWARK = 2, 3
TRIP_TYPES = Bands("JFK Airport", "Newark Airport", "Other Airport", "Regular Trip")
# The comparison accepts fares up to this amount, unlike the other reports.
_COMPARED_BELOW = 1000.0


def _rate(code: int) -> Column:
    return F.col("rate_code_id") == code


def _fee() -> Column:
    return F.col("airport_fee") > 0


def is_airport_trip() -> Column:
    return _rate(JFK) | _rate(NEWARK) | _fee()


def _by_type(t: TripTables, *measures: Column) -> DataFrame:
    kind = TRIP_TYPES.number(_rate(JFK), _rate(NEWARK), _fee())
    grouped = (
        t.fact_trip.filter(fare_in_range(_COMPARED_BELOW))
        .groupBy(kind.alias("kind"))
        .agg(F.count("*").alias("trip_count"), *measures)
    )
    return (
        grouped.withColumn("trip_type", TRIP_TYPES.label(F.col("kind")))
        .drop("kind")
        .orderBy(F.col("trip_count").desc(), "trip_type")
    )


def comparison(t: TripTables) -> DataFrame:
    return _by_type(
        t,
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        minutes(int_mean("trip_duration_seconds")).alias("avg_duration_min"),
        mean("tip_amount").alias("avg_tip"),
        ratio_mean("tip_percentage").alias("avg_tip_pct"),
        mean("total_amount").alias("avg_total"),
    )


def _home_origins(t: TripTables) -> DataFrame:
    trips = t.fact_trip.filter(is_airport_trip() & (F.col("fare_amount") > 0))
    return with_zone(trips, t, "pu_location_id", "zone", home_only=True)


def top_origins(t: TripTables, limit: int = 20) -> DataFrame:
    """Home zones by airport trips, with the airport most of them go to.

    The most frequent of three labels is read off three counts, which keeps the whole
    aggregation in generated code; ties go to the alphabetically first label.
    """
    counted = (
        _home_origins(t)
        .groupBy("zone")
        .agg(
            F.count("*").alias("airport_trip_count"),
            mean("fare_amount").alias("avg_fare"),
            mean("trip_distance").alias("avg_distance"),
            ratio_mean("tip_percentage").alias("avg_tip_pct"),
            count_where(_rate(JFK)).alias("_jfk"),
            count_where(_rate(NEWARK)).alias("_newark"),
        )
        .filter(F.col("airport_trip_count") >= t.settings.min_airport_trips)
    )
    jfk, newark = F.col("_jfk"), F.col("_newark")
    other = F.col("airport_trip_count") - jfk - newark
    # Airport labels.
    commonest = (
        F.when((jfk >= newark) & (jfk >= other), "JFK").when(newark >= other, "Newark").otherwise("Other")
    )
    rows = counted.withColumn("most_common_airport", commonest).drop("_jfk", "_newark")
    return top(rows, check_limit(limit), F.col("airport_trip_count").desc())


def by_hour(t: TripTables) -> DataFrame:
    """Here only the two rate codes make an airport trip; the fee is not looked at."""
    at_airport = F.coalesce(_rate(JFK) | _rate(NEWARK), F.lit(False))
    grouped = (
        t.fact_trip.filter(F.col("fare_amount") > 0)
        .groupBy(at_airport.alias("at_airport"), "pickup_hour")
        .agg(F.count("*").alias("trip_count"), mean("fare_amount").alias("avg_fare"))
    )
    label = F.when(F.col("at_airport"), "Airport").otherwise("Regular")
    return (
        grouped.select(label.alias("trip_type"), "pickup_hour", "trip_count", "avg_fare")
        .orderBy("trip_type", "pickup_hour")
    )


def revenue(t: TripTables) -> DataFrame:
    grouped = (
        with_rate_code(t.fact_trip.filter(F.col("fare_amount") > 0), t)
        .filter("is_airport")
        .groupBy("rate_code_name")
        .agg(
            F.count("*").alias("trip_count"),
            total("total_amount").alias("total_revenue"),
            mean("total_amount").alias("avg_revenue_per_trip"),
        )
    )
    share = percent(F.col("total_revenue"), over_all(F.sum("total_revenue")))
    return grouped.withColumn("pct_of_total_revenue", share).orderBy(
        F.col("total_revenue").desc(), "rate_code_name"
    )


def api_comparison(t: TripTables) -> DataFrame:
    return _by_type(
        t,
        round_half_up(mean("fare_amount"), 2).alias("avg_fare"),
        round_half_up(mean("trip_distance"), 2).alias("avg_distance"),
        round_half_up(minutes(int_mean("trip_duration_seconds")), 1).alias("avg_duration_min"),
        round_half_up(mean("tip_amount"), 2).alias("avg_tip"),
    )


def api_top_origins(t: TripTables, limit: int = 20, min_trips: int = 10) -> DataFrame:
    rows = (
        _home_origins(t)
        .groupBy("zone")
        .agg(
            F.count("*").alias("trip_count"),
            round_half_up(mean("fare_amount"), 2).alias("avg_fare"),
            round_half_up(mean("trip_distance"), 2).alias("avg_distance"),
        )
        .filter(F.col("trip_count") >= min_trips)
    )
    return top(rows, check_limit(limit, API_ROWS), F.col("trip_count").desc())
