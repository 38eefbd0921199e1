"""Origin-destination flows, all from the route rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import API_ROWS, check_limit
from tripmill.functions.bands import Bands
from tripmill.functions.exact import minutes, percent, ratio_mean, round_half_up
from tripmill.functions.ranking import top, top_ranked
from tripmill.operators.star import with_both_zones, with_zone
from tripmill.plans.tables import TripTables

# Classes of routes by mean distance.
DISTANCES = Bands(
    "Very Short (<1 mi)", "Short (1-2 mi)", "Medium (2-5 mi)", "Long (5-10 mi)", "Very Long (10+ mi)"
)
_DISTANCE_LIMITS = [1, 2, 5, 10]


def _home_routes(t: TripTables) -> DataFrame:
    return with_both_zones(t.mv_od_flows, t, "origin_zone", "destination_zone", home_only=True)


def top_routes(t: TripTables, limit: int = 50) -> DataFrame:
    hours = F.col("avg_duration_sec") / F.lit(3600.0)
    rows = _home_routes(t).select(
        "origin_zone",
        "destination_zone",
        "trip_count",
        "avg_fare",
        "avg_distance",
        minutes(F.col("avg_duration_sec")).alias("avg_duration_min"),
        "median_fare",
        "p90_fare",
        F.try_divide("avg_fare", "avg_distance").alias("fare_per_mile"),
        F.try_divide(F.col("avg_distance"), hours).alias("avg_speed_mph"),
    )
    return top_ranked(rows, check_limit(limit), "trip_count", "route_rank")


def flow_asymmetry(t: TripTables, limit: int = 30) -> DataFrame:
    """Both directions of a pair of zones side by side.

    A route from a zone to itself has no direction: it counts towards the total only.
    """
    start, end, trips = F.col("pu_location_id"), F.col("do_location_id"), F.col("trip_count")
    pairs = (
        t.mv_od_flows.groupBy(F.least(start, end).alias("low"), F.greatest(start, end).alias("high"))
        .agg(
            F.sum(F.when(start < end, trips).otherwise(F.lit(0))).alias("forward_count"),
            F.sum(F.when(start > end, trips).otherwise(F.lit(0))).alias("reverse_count"),
            F.sum(trips).alias("total_count"),
        )
        .filter(F.col("total_count") >= t.settings.min_pair_trips)
    )
    named = with_zone(pairs, t, "low", "zone_1", home_only=True)
    named = with_zone(named, t, "high", "zone_2", home_only=True)
    forward, back = F.col("forward_count"), F.col("reverse_count")
    gap = F.abs(forward - back)

    def dominant(first: str, second: str):
        return F.concat(F.col(first), F.lit(" → "), F.col(second), F.lit(" dominant"))

    rows = named.select(
        "zone_1",
        "zone_2",
        "forward_count",
        "reverse_count",
        "total_count",
        gap.alias("flow_imbalance"),
        percent(gap, F.col("total_count")).alias("imbalance_pct"),
        F.when(forward > back * 2, dominant("zone_1", "zone_2"))
        .when(back > forward * 2, dominant("zone_2", "zone_1"))
        .otherwise("Balanced")
        .alias("flow_pattern"),
    )
    return top(rows, check_limit(limit), F.col("total_count").desc())


def zone_centrality(t: TripTables, limit: int = 20) -> DataFrame:
    """Zones by number of destinations; zones of the same name count as one."""
    rows = (
        with_zone(t.mv_od_flows, t, "pu_location_id", "origin_zone", home_only=True)
        .groupBy("origin_zone")
        .agg(
            F.count_distinct("do_location_id").alias("unique_destinations"),
            F.sum("trip_count").alias("total_trips"),
            ratio_mean("avg_fare").alias("avg_fare"),
            ratio_mean("avg_distance").alias("avg_distance"),
        )
    )
    return top(rows, check_limit(limit), F.col("unique_destinations").desc(), F.col("total_trips").desc())


def distance_categories(t: TripTables) -> DataFrame:
    band = DISTANCES.below(F.col("avg_distance"), _DISTANCE_LIMITS)
    grouped = (
        _home_routes(t)
        .groupBy(band.alias("band"))
        .agg(
            F.count("*").alias("route_count"),
            F.sum("trip_count").alias("total_trips"),
            ratio_mean("avg_fare").alias("avg_fare"),
            ratio_mean("avg_duration_sec / 60.0D").alias("avg_duration_min"),
        )
    )
    return grouped.orderBy("band").select(
        DISTANCES.label(F.col("band")).alias("distance_category"),
        "route_count",
        "total_trips",
        "avg_fare",
        "avg_duration_min",
    )


def api_top_routes(t: TripTables, limit: int = 50) -> DataFrame:
    rows = _home_routes(t).select(
        F.col("origin_zone").alias("origin"),
        F.col("destination_zone").alias("destination"),
        "trip_count",
        round_half_up(F.col("avg_fare"), 2).alias("avg_fare"),
        round_half_up(F.col("avg_distance"), 2).alias("avg_distance"),
        round_half_up(minutes(F.col("avg_duration_sec")), 1).alias("avg_duration_min"),
    )
    return top(rows, check_limit(limit, API_ROWS), F.col("trip_count").desc())
