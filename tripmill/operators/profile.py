"""Profiles of raw, unfiltered trips and of the zone lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import check_limit
from tripmill.functions.exact import count_where, mean, percent, round_half_up
from tripmill.functions.ranking import over_all, top
from tripmill.operators import clean
from tripmill.operators.rollups import fare_in_range
from tripmill.plans.tables import TripTables
from tripmill.sources import trips


def preview(t: TripTables, rows: int = 10) -> DataFrame:
    """The first trips in order of pickup, ties by all columns."""
    columns = [c for c in t.raw.columns if c != "tpep_pickup_datetime"]
    return trips.preview(t.raw.orderBy("tpep_pickup_datetime", *columns), rows)


def schema(t: TripTables) -> DataFrame:
    """Names and types of the raw columns, in order."""
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(t.raw.schema, start=1)]
    layout = "position int, column_name string, column_type string, nullable boolean"
    return t.spark.createDataFrame(fields, layout)


def row_count(t: TripTables) -> DataFrame:
    return t.raw.agg(F.count("*").alias("total_trips"))


def date_range(t: TripTables) -> DataFrame:
    pickup = F.col("tpep_pickup_datetime")
    return t.raw.agg(F.min(pickup).alias("first_trip"), F.max(pickup).alias("last_trip"))


def borough_distribution(t: TripTables) -> DataFrame:
    return (
        t.zone_lookup.filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "borough")
    )


def home_zones(t: TripTables) -> DataFrame:
    return (
        t.dim_location.filter(F.col("borough") == t.settings.home)
        .select("location_id", "borough", "zone")
        .orderBy("location_id")
    )


def _routes(t: TripTables) -> DataFrame:
    """Raw trips per pair of ends: as many rows as there are routes, whatever the input."""
    return t.raw.groupBy("PULocationID", "DOLocationID").agg(F.count("*").alias("n"))


def _share_of_raw(t: TripTables, test: Column, name: str, percentage: str, with_total: bool) -> DataFrame:
    """Counting per route first leaves the lookup of home zones to a few thousand rows."""
    trips_all = F.coalesce(F.sum("n"), F.lit(0))
    hits = F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    columns = [trips_all.alias("total_trips")] if with_total else []
    return clean.with_home_ends(_routes(t), t.home_ids).agg(
        *columns,
        hits.alias(name),
        round_half_up(percent(hits, trips_all), 2).alias(percentage),
    )


def home_pickup_share(t: TripTables) -> DataFrame:
    return _share_of_raw(t, F.col("home_pickup"), "home_pickup", "pickup_percentage", True)


def home_dropoff_share(t: TripTables) -> DataFrame:
    return _share_of_raw(t, F.col("home_dropoff"), "home_dropoff", "dropoff_percentage", True)


def home_both_share(t: TripTables) -> DataFrame:
    return _share_of_raw(t, F.col("home_pickup") & F.col("home_dropoff"), "both_home", "percentage", False)


def home_either_share(t: TripTables) -> DataFrame:
    return _share_of_raw(t, F.col("home_pickup") | F.col("home_dropoff"), "either_home", "percentage", False)


def top_routes(t: TripTables, limit: int = 10) -> DataFrame:
    routes = (
        clean.in_scope(t.raw, t.home_ids)
        .groupBy("PULocationID", "DOLocationID")
        .agg(F.count("*").alias("trip_count"))
    )
    return top(routes, check_limit(limit), F.col("trip_count").desc())


def location_cardinality(t: TripTables) -> DataFrame:
    """Trips and distinct ends; again few rows are left to deduplicate."""
    return _routes(t).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_trips"),
        F.count_distinct("PULocationID").alias("unique_pickup_zones"),
        F.count_distinct("DOLocationID").alias("unique_dropoff_zones"),
    )


def _distribution(t: TripTables, column: str) -> DataFrame:
    """Rows and share per value; a missing value is a group of its own."""
    grouped = t.raw.groupBy(column).agg(F.count("*").alias("trip_count"))
    share = round_half_up(percent(F.col("trip_count"), over_all(F.sum("trip_count"))), 2)
    return grouped.withColumn("percentage", share)


def _by_count(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.col("trip_count").desc(), F.col(column).asc_nulls_last())


def vendor_distribution(t: TripTables) -> DataFrame:
    return _by_count(_distribution(t, "VendorID"), "VendorID")


def payment_distribution(t: TripTables) -> DataFrame:
    return _by_count(_distribution(t, "payment_type"), "payment_type")


def rate_distribution(t: TripTables) -> DataFrame:
    return _by_count(_distribution(t, "RatecodeID"), "RatecodeID")


def passenger_distribution(t: TripTables) -> DataFrame:
    return _distribution(t, "passenger_count").orderBy(F.col("passenger_count").asc_nulls_last())


def fare_stats(t: TripTables) -> DataFrame:
    return t.raw.filter(fare_in_range()).agg(
        round_half_up(mean("fare_amount"), 2).alias("avg_fare"),
        round_half_up(F.min("fare_amount"), 2).alias("min_fare"),
        round_half_up(F.max("fare_amount"), 2).alias("max_fare"),
        round_half_up(mean("tip_amount"), 2).alias("avg_tip"),
        round_half_up(mean("trip_distance"), 2).alias("avg_distance"),
    )


def hourly(t: TripTables) -> DataFrame:
    hour = F.hour("tpep_pickup_datetime").alias("hour")
    return t.raw.groupBy(hour).agg(F.count("*").alias("trip_count")).orderBy("hour")


def top_pickups(t: TripTables, limit: int = 10) -> DataFrame:
    counted = t.raw.groupBy("PULocationID").agg(F.count("*").alias("trip_count"))
    return top(counted, check_limit(limit), F.col("trip_count").desc())


def top_dropoffs(t: TripTables, limit: int = 10) -> DataFrame:
    counted = t.raw.groupBy("DOLocationID").agg(F.count("*").alias("trip_count"))
    return top(counted, check_limit(limit), F.col("trip_count").desc())


def quality(t: TripTables) -> DataFrame:
    riders = F.col("passenger_count")
    return t.raw.agg(
        F.count("*").alias("total_trips"),
        count_where(F.col("fare_amount") <= 0).alias("invalid_fares"),
        count_where(F.col("trip_distance") <= 0).alias("invalid_distance"),
        count_where((riders <= 0) | (riders > 6)).alias("invalid_passengers"),
        count_where(F.col("PULocationID").isNull() | F.col("DOLocationID").isNull()).alias("null_locations"),
    )
