"""Every named report, by the name users call it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tripmill import schema
from tripmill.operators import (
    airport,
    anomalies,
    clean,
    demand,
    fares,
    flows,
    patterns,
    profile,
    quality,
    rollups,
    sketches,
    tipping,
    vendors,
    zones,
)
from tripmill.plans.tables import TripTables

Report = Callable[..., DataFrame]


def _rollup(build: Callable[[DataFrame], DataFrame]) -> Report:
    return lambda t: build(t.fact_trip)


ROLLUP_REPORTS: dict[str, Report] = {
    "mv_zone_pickup": lambda t, approx=False: (
        sketches.zone_pickup(t.fact_trip) if approx else rollups.zone_pickup(t.route_fares)
    ),
    "mv_zone_dropoff": lambda t: rollups.zone_dropoff(t.route_fares),
    "mv_hourly_demand": _rollup(rollups.hourly_demand),
    "mv_od_flows": lambda t, approx=False: (
        sketches.od_flows(t.fact_trip, t.settings.min_od_trips)
        if approx
        else rollups.od_flows(t.route_fares, t.settings.min_od_trips)
    ),
    "mv_vendor_performance": _rollup(rollups.vendor_performance),
    "mv_payment_patterns": _rollup(rollups.payment_patterns),
    "summary_statistics": _rollup(rollups.summary_statistics),
}

FEATURE_REPORTS: dict[str, Report] = {
    "zone_top_pickup": zones.top_pickup,
    "zone_top_dropoff": zones.top_dropoff,
    "zone_activity_score": zones.activity_score,
    "zone_activity_by_hour": zones.activity_by_hour,
    "demand_hourly": demand.hourly,
    "demand_day_of_week": demand.day_of_week,
    "demand_heatmap": demand.heatmap,
    "demand_monthly_trend": demand.monthly_trend,
    "demand_weekend_vs_weekday": demand.weekend_vs_weekday,
    "demand_rush_hour": demand.rush_hour,
    "fare_breakdown": fares.breakdown,
    "fare_surcharge_frequency": fares.surcharge_frequency,
    "fare_by_rate_code": fares.by_rate_code,
    "tip_ratio_distribution": fares.tip_ratio_distribution,
    "airport_comparison": airport.comparison,
    "airport_top_origins": airport.top_origins,
    "airport_by_hour": airport.by_hour,
    "airport_revenue": airport.revenue,
    "od_top_routes": flows.top_routes,
    "od_flow_asymmetry": flows.flow_asymmetry,
    "od_zone_centrality": flows.zone_centrality,
    "od_distance_categories": flows.distance_categories,
    "vendor_performance": vendors.performance,
    "vendor_by_hour": vendors.by_hour,
    "vendor_service_quality": vendors.service_quality,
    "vendor_monthly_share": vendors.monthly_share,
    "tipping_by_payment_type": tipping.by_payment_type,
    "tipping_by_hour": tipping.tipping_by_hour,
    "tipper_categories": tipping.tipper_categories,
    "tip_by_trip_bands": tipping.tip_by_trip_bands,
    "anomaly_high_fare_per_mile": anomalies.high_fare_per_mile,
    "anomaly_slow_trips": anomalies.slow_trips,
    "anomaly_no_tip_expensive": anomalies.no_tip_expensive,
    "anomaly_extreme_distance": anomalies.extreme_distance,
    "anomaly_round_fares": anomalies.round_fares,
    "anomaly_summary": anomalies.summary,
    "outlier_percentiles": anomalies.outlier_percentiles,
    "data_quality_report": quality.data_quality_report,
}

API_REPORTS: dict[str, Report] = {
    "api_stats": zones.api_stats,
    "api_top_pickup": zones.api_top_pickup,
    "api_top_dropoff": zones.api_top_dropoff,
    "api_hourly": demand.api_hourly,
    "api_day_of_week": demand.api_day_of_week,
    "api_heatmap": demand.api_heatmap,
    "api_fare_breakdown": fares.api_breakdown,
    "api_surcharges": fares.api_surcharges,
    "api_airport_comparison": airport.api_comparison,
    "api_airport_origins": airport.api_top_origins,
    "api_top_routes": flows.api_top_routes,
    "api_vendor_performance": vendors.api_performance,
    "api_tipping_by_payment": tipping.api_by_payment_type,
    "api_high_fare_per_mile": anomalies.api_high_fare_per_mile,
    "api_anomaly_summary": anomalies.api_summary,
}

PROFILE_REPORTS: dict[str, Report] = {
    "profile_preview": profile.preview,
    "profile_schema": profile.schema,
    "profile_row_count": profile.row_count,
    "profile_date_range": profile.date_range,
    "profile_borough_distribution": profile.borough_distribution,
    "profile_home_zones": profile.home_zones,
    "profile_home_pickup_share": profile.home_pickup_share,
    "profile_home_dropoff_share": profile.home_dropoff_share,
    "profile_home_both_share": profile.home_both_share,
    "profile_home_either_share": profile.home_either_share,
    "profile_raw_top_routes": profile.top_routes,
    "profile_location_cardinality": profile.location_cardinality,
    "profile_vendor_distribution": profile.vendor_distribution,
    "profile_payment_distribution": profile.payment_distribution,
    "profile_rate_distribution": profile.rate_distribution,
    "profile_passenger_distribution": profile.passenger_distribution,
    "profile_fare_stats": profile.fare_stats,
    "profile_raw_hourly": profile.hourly,
    "profile_raw_top_pickups": profile.top_pickups,
    "profile_raw_top_dropoffs": profile.top_dropoffs,
    "profile_raw_quality": profile.quality,
}

PATTERN_REPORTS: dict[str, Report] = {
    "pattern_zone_popularity": patterns.zone_popularity,
    "pattern_hourly_since": patterns.hourly_since,
    "pattern_od_flows": patterns.od_flows,
    "pattern_fare_anomaly": patterns.fare_anomaly,
    "pattern_vendor_share": patterns.vendor_share,
}

LOAD_REPORTS: dict[str, Report] = {
    "fact_trip": lambda t: t.fact_trip.select(*schema.FACT_TRIP.names, "source_file", "source_period"),
    "dim_location": lambda t: t.dim_location,
    "load_audit": lambda t: clean.load_audit(t.raw, t.home_ids),
    "load_totals": lambda t: clean.audit_totals(t.load_audit),
    "load_table_counts": quality.table_counts,
    "load_averages": quality.load_averages,
    "load_contract_violations": quality.contract_violations,
}

REPORTS: dict[str, Report] = {
    **LOAD_REPORTS,
    **ROLLUP_REPORTS,
    **FEATURE_REPORTS,
    **API_REPORTS,
    **PROFILE_REPORTS,
    **PATTERN_REPORTS,
}


def run(name: str, tables: TripTables, **arguments: object) -> DataFrame:
    """Build the named report over the given tables."""
    if name not in REPORTS:
        raise KeyError(f"no report called {name!r}; see tripmill.plans.catalog.REPORTS")
    return REPORTS[name](tables, **arguments)
