"""Checks and counts on loaded tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.functions.exact import count_where, int_mean, mean, minutes
from tripmill.operators.rollups import fare_in_range
from tripmill.plans.tables import REPORTED, TripTables


def data_quality_report(t: TripTables) -> DataFrame:
    return t.fact_trip.agg(
        F.count("*").alias("total_records"),
        count_where(fare_in_range()).alias("valid_fares"),
        count_where(F.col("trip_distance") > 0).alias("valid_distances"),
        count_where(F.col("trip_duration_seconds") > 0).alias("valid_durations"),
        count_where(F.col("passenger_count").between(1, 6)).alias("valid_passengers"),
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_distance"),
        minutes(int_mean("trip_duration_seconds")).alias("avg_duration_min"),
        F.min("pickup_datetime").alias("earliest_trip"),
        F.max("pickup_datetime").alias("latest_trip"),
    )


def table_counts(t: TripTables) -> DataFrame:
    """Rows of every table of the load."""
    counts = [
        getattr(t, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name in REPORTED
    ]
    return reduce(DataFrame.unionAll, counts)


def load_averages(t: TripTables) -> DataFrame:
    return t.fact_trip.agg(
        F.count("*").alias("total"),
        mean("fare_amount").alias("avg_fare"),
        mean("trip_distance").alias("avg_dist"),
        minutes(int_mean("trip_duration_seconds")).alias("avg_duration_min"),
    )


def contract_violations(t: TripTables) -> DataFrame:
    """Nulls in required columns and repeated keys, per table.

    Spark enforces neither NOT NULL nor a primary key, so the load is checked with this.
    Repeats are counted by key, which any number of tasks can share.
    """
    parts = []
    for table, required in schema.REQUIRED.items():
        rows, key = getattr(t, table), schema.PRIMARY_KEY[table]
        absent = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
        nulls = rows.agg(count_where(absent).alias("violations"))
        repeats = rows.groupBy(key).agg((F.count("*") - 1).alias("extra"))
        repeats = repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations"))
        for rule, found in (("not null", nulls), ("primary key", repeats)):
            parts.append(found.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"))
    return reduce(DataFrame.unionAll, parts)
