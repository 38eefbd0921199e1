"""Joins of trips or rollups to the dimensions.

Vendors, payment types and rate codes are rows written in the source, so a broadcast is
bounded by construction. Locations come from a file: no hint is given, Catalyst broadcasts
them while they are below ``spark.sql.autoBroadcastJoinThreshold`` (AQE checks again at run
time) and shuffles beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.plans.tables import TripTables


def with_vendor(df: DataFrame, t: TripTables) -> DataFrame:
    return df.join(F.broadcast(t.dim_vendor), "vendor_id")


def with_payment_type(df: DataFrame, t: TripTables) -> DataFrame:
    return df.join(F.broadcast(t.dim_payment_type), "payment_type_id")


def with_rate_code(df: DataFrame, t: TripTables) -> DataFrame:
    return df.join(F.broadcast(t.dim_rate_code), "rate_code_id")


def with_zone(df: DataFrame, t: TripTables, key: str, zone: str, home_only: bool = False) -> DataFrame:
    """Add the zone name of ``key`` as ``zone``; optionally keep only home zones."""
    places = t.dim_location
    if home_only:
        places = places.filter(F.col("borough") == t.settings.home)
    places = places.select(F.col("location_id").alias("_place"), F.col("zone").alias(zone))
    return df.join(places, F.col(key) == F.col("_place")).drop("_place")


def with_both_zones(
    df: DataFrame, t: TripTables, origin: str, destination: str, home_only: bool = False
) -> DataFrame:
    df = with_zone(df, t, "pu_location_id", origin, home_only)
    return with_zone(df, t, "do_location_id", destination, home_only)
