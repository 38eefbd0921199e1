"""One checking query per report."""

from __future__ import annotations

import datetime as dt

from oracle.tables import (
    PLAUSIBLE,
    amount_avg,
    amount_sum,
    big,
    hits,
    int_avg,
    quantile,
    ratio_avg,
    share,
    with_tables,
)
from tripmill import Settings

_CHEAP = "fare_amount > 0 AND fare_amount < 500"
_MIN = "60.0::DOUBLE"
_ALL = "OVER ()"


def _load() -> dict[str, str]:
    valid = f"""PULocationID IN (SELECT location_id FROM home) AND DOLocationID IN (SELECT location_id FROM home)
      AND {PLAUSIBLE}"""
    audit = f"""SELECT source_file, COUNT(*) AS original_trips, {big("SUM(CASE WHEN ok THEN 1 ELSE 0 END)")} AS loaded_trips
    FROM (SELECT source_file, COALESCE({valid}, FALSE) AS ok FROM raw_trips) GROUP BY 1"""
    loaded = f"""SELECT * FROM (
        SELECT SUBSTR(source_file, 7, 4) AS source_period, original_trips, loaded_trips,
            original_trips - loaded_trips AS filtered_trips FROM ({audit})
    ) LEFT JOIN (
        SELECT source_period, COUNT(*) AS trips, COUNT(DISTINCT trip_id) AS trip_ids, {amount_sum("fare_amount")} AS fares,
            {amount_sum("trip_distance")} AS miles, {big("SUM(trip_duration_seconds)")} AS seconds
        FROM fact_trip GROUP BY 1
    ) USING (source_period)"""
    parts = [
        "fact_trip",
        "dim_location",
        "dim_vendor",
        "dim_payment_type",
        "dim_rate_code",
        "mv_zone_pickup",
        "mv_zone_dropoff",
        "mv_hourly_demand",
        "mv_od_flows",
        "mv_vendor_performance",
        "mv_payment_patterns",
    ]
    keys = {
        "dim_location": "location_id",
        "dim_vendor": "vendor_id",
        "dim_payment_type": "payment_type_id",
        "dim_rate_code": "rate_code_id",
        "fact_trip": "trip_id",
    }
    required = {
        "dim_location": "location_id borough zone",
        "dim_vendor": "vendor_id vendor_name vendor_short_name",
        "dim_payment_type": "payment_type_id payment_type_name is_card_payment allows_tip",
        "dim_rate_code": "rate_code_id rate_code_name is_airport is_standard",
        "fact_trip": """trip_id vendor_id pu_location_id do_location_id payment_type_id rate_code_id
            pickup_datetime dropoff_datetime pickup_date pickup_hour pickup_day_of_week is_weekend
            trip_distance trip_duration_seconds fare_amount total_amount""",
    }
    checks = []
    for table, key in keys.items():
        absent = " OR ".join(f"{c} IS NULL" for c in required[table].split())
        checks.append(f"SELECT '{table}' AS table_name, 'not null' AS rule, {hits(absent)} AS violations FROM {table}")
        checks.append(f"SELECT '{table}', 'primary key', COUNT(*) - COUNT(DISTINCT {key}) FROM {table}")
    return {
        "fact_trip": "SELECT * FROM fact_trip",
        "dim_location": "SELECT * FROM dim_location",
        "load_audit": f"""SELECT source_file, original_trips, loaded_trips, 'loaded' AS status,
            original_trips - loaded_trips AS filtered_trips,
            {share("(original_trips - loaded_trips)", "original_trips")} AS filtered_pct FROM ({audit})""",
        "load_batch": loaded,
        "incremental_load": loaded,
        "incremental_rollups": _long_rollups(),
        "load_totals": f"""SELECT {big("SUM(loaded_trips)")} AS loaded_trips,
            {big("SUM(original_trips - loaded_trips)")} AS filtered_trips,
            {share("SUM(original_trips - loaded_trips)", "SUM(original_trips)")} AS filter_rate_pct FROM ({audit})""",
        "load_table_counts": " UNION ALL ".join(
            f"SELECT '{p}' AS table_name, COUNT(*) AS row_count FROM {p}" for p in parts
        ),
        "load_averages": f"""SELECT COUNT(*) AS total, {amount_avg("fare_amount")} AS avg_fare,
            {amount_avg("trip_distance")} AS avg_dist,
            {int_avg("trip_duration_seconds")} / {_MIN} AS avg_duration_min FROM fact_trip""",
        "load_contract_violations": " UNION ALL ".join(checks),
    }


def _long_rollups() -> str:
    """All rollups, a row per key and measure."""
    keys = {
        "mv_zone_pickup": ["location_id"],
        "mv_zone_dropoff": ["location_id"],
        "mv_hourly_demand": ["pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend"],
        "mv_od_flows": ["pu_location_id", "do_location_id"],
        "mv_vendor_performance": ["vendor_id"],
        "mv_payment_patterns": ["payment_type_id", "pickup_hour", "is_weekend"],
    }
    parts = []
    for name, own in keys.items():
        key = " || '|' || ".join(f"{k}::VARCHAR" for k in own)
        values = f"SELECT {key} AS key, COLUMNS(* EXCLUDE ({', '.join(own)}))::DOUBLE FROM {name}"
        parts.append(_unpivoted(name, values))
    overall = """SELECT metric_type AS key, COLUMNS(* EXCLUDE (metric_type, first_trip_date, last_trip_date))::DOUBLE,
        epoch_us(first_trip_date)::DOUBLE AS first_trip_date, epoch_us(last_trip_date)::DOUBLE AS last_trip_date
        FROM summary_statistics"""
    return " UNION ALL ".join([*parts, _unpivoted("summary_statistics", overall)])


def _unpivoted(name: str, query: str) -> str:
    return f"""SELECT '{name}' AS rollup, key, measure, value
        FROM ({query}) UNPIVOT INCLUDE NULLS (value FOR measure IN (COLUMNS(* EXCLUDE (key))))"""


def _rollups() -> dict[str, str]:
    names = [
        "mv_zone_pickup",
        "mv_zone_dropoff",
        "mv_hourly_demand",
        "mv_od_flows",
        "mv_vendor_performance",
        "mv_payment_patterns",
        "summary_statistics",
    ]
    return {name: f"SELECT * FROM {name}" for name in names}


def _zones(s: Settings) -> dict[str, str]:
    return {
        "zone_top_pickup": f"""SELECT zone, borough, pickup_count, avg_fare, avg_distance, median_fare,
            avg_duration / {_MIN} AS avg_duration_min, RANK() OVER (ORDER BY pickup_count DESC) AS popularity_rank
            FROM mv_zone_pickup JOIN dim_location USING (location_id) WHERE borough = '{s.home}'
            ORDER BY pickup_count DESC, zone LIMIT 20""",
        "zone_top_dropoff": f"""SELECT zone, borough, dropoff_count, avg_fare, avg_distance,
            RANK() OVER (ORDER BY dropoff_count DESC) AS popularity_rank
            FROM mv_zone_dropoff JOIN dim_location USING (location_id) WHERE borough = '{s.home}'
            ORDER BY dropoff_count DESC, zone LIMIT 20""",
        "zone_activity_score": f"""SELECT zone, ups AS pickup_count, downs AS dropoff_count,
            ups + downs AS total_activity, (f1 + f2) / 2 AS combined_avg_fare,
            CASE WHEN ups > downs * 1.5 THEN 'Origin Zone' WHEN downs > ups * 1.5 THEN 'Destination Zone'
                 ELSE 'Balanced' END AS zone_type
            FROM (SELECT zone, COALESCE(pickup_count, 0) AS ups, COALESCE(dropoff_count, 0) AS downs,
                    COALESCE(p.avg_fare, 0) AS f1, COALESCE(d.avg_fare, 0) AS f2
                  FROM dim_location l LEFT JOIN mv_zone_pickup p ON p.location_id = l.location_id
                  LEFT JOIN mv_zone_dropoff d ON d.location_id = l.location_id WHERE borough = '{s.home}')
            ORDER BY total_activity DESC, zone LIMIT 30""",
        "zone_activity_by_hour": f"""SELECT zone, pickup_hour, COUNT(*) AS trip_count,
            {amount_avg("fare_amount")} AS avg_fare
            FROM fact_trip JOIN dim_location ON location_id = pu_location_id
            WHERE borough = '{s.home}' AND fare_amount > 0
              AND pickup_date >= (SELECT MAX(pickup_date) FROM mv_hourly_demand) - {s.recent_days}
            GROUP BY 1, 2""",
        "api_stats": f"""SELECT total_trips, ROUND(total_revenue, 2) AS total_revenue, ROUND(avg_fare, 2) AS avg_fare,
            ROUND(avg_distance, 2) AS avg_distance, ROUND(avg_duration / {_MIN}, 1) AS avg_duration_min,
            first_trip_date AS date_range_start, last_trip_date AS date_range_end FROM summary_statistics""",
        "api_top_pickup": f"""SELECT zone, borough, pickup_count, ROUND(avg_fare, 2) AS avg_fare,
            ROUND(avg_distance, 2) AS avg_distance, ROUND(median_fare, 2) AS median_fare
            FROM mv_zone_pickup JOIN dim_location USING (location_id) WHERE borough = '{s.home}'
            ORDER BY pickup_count DESC, zone LIMIT 20""",
        "api_top_dropoff": f"""SELECT zone, borough, dropoff_count, ROUND(avg_fare, 2) AS avg_fare,
            ROUND(avg_distance, 2) AS avg_distance
            FROM mv_zone_dropoff JOIN dim_location USING (location_id) WHERE borough = '{s.home}'
            ORDER BY dropoff_count DESC, zone LIMIT 20""",
    }


def _demand() -> dict[str, str]:
    trips = big("SUM(trip_count)")
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    day = "[" + ", ".join(f"'{n}'" for n in names) + "][pickup_day_of_week + 1]"
    return {
        "demand_hourly": f"""SELECT pickup_hour, {trips} AS total_trips, {ratio_avg("avg_fare")} AS avg_fare,
            {amount_sum("total_revenue")} AS total_revenue,
            {share("SUM(trip_count)", f"SUM(SUM(trip_count)) {_ALL}")} AS pct_of_total
            FROM mv_hourly_demand GROUP BY 1""",
        "demand_day_of_week": f"""SELECT pickup_day_of_week, {day} AS day_name, is_weekend, {trips} AS total_trips,
            {ratio_avg("avg_fare")} AS avg_fare, {amount_sum("total_revenue")} AS total_revenue
            FROM mv_hourly_demand GROUP BY 1, 2, 3""",
        "demand_heatmap": f"""SELECT pickup_day_of_week, pickup_hour, {trips} AS trip_count,
            {ratio_avg("avg_fare")} AS avg_fare,
            CAST(SUM(trip_count) AS DOUBLE) / MAX(SUM(trip_count)) {_ALL} AS normalized_demand
            FROM mv_hourly_demand GROUP BY 1, 2""",
        "demand_monthly_trend": f"""SELECT CAST(EXTRACT(YEAR FROM pickup_date) AS INTEGER) AS year,
            CAST(EXTRACT(MONTH FROM pickup_date) AS INTEGER) AS month, {trips} AS total_trips,
            {ratio_avg("avg_fare")} AS avg_fare, {amount_sum("total_revenue")} AS total_revenue,
            CAST(SUM(trip_count) AS DOUBLE) / COUNT(DISTINCT pickup_date) AS avg_trips_per_day
            FROM mv_hourly_demand GROUP BY 1, 2""",
        "demand_weekend_vs_weekday": f"""SELECT is_weekend, pickup_hour, {trips} AS total_trips,
            {ratio_avg("avg_fare")} AS avg_fare, {ratio_avg("avg_distance")} AS avg_distance
            FROM mv_hourly_demand GROUP BY 1, 2""",
        "demand_rush_hour": f"""SELECT pickup_hour, {int_avg("trip_count")} AS avg_hourly_trips,
            CASE WHEN pickup_hour IN (7, 8, 9) THEN 'Morning Rush' WHEN pickup_hour IN (17, 18, 19) THEN 'Evening Rush'
                 WHEN pickup_hour <= 5 THEN 'Late Night' ELSE 'Regular Hours' END AS time_category
            FROM mv_hourly_demand GROUP BY 1""",
        "api_hourly": f"""SELECT pickup_hour AS hour, {trips} AS total_trips, ROUND({ratio_avg("avg_fare")}, 2) AS avg_fare,
            ROUND({amount_sum("total_revenue")}, 2) AS total_revenue FROM mv_hourly_demand GROUP BY 1""",
        "api_day_of_week": f"""SELECT pickup_day_of_week AS day_number, {day} AS day_name, is_weekend,
            {trips} AS total_trips, ROUND({ratio_avg("avg_fare")}, 2) AS avg_fare
            FROM mv_hourly_demand GROUP BY 1, 2, 3""",
        "api_heatmap": f"""SELECT pickup_day_of_week AS day, pickup_hour AS hour, {trips} AS trips
            FROM mv_hourly_demand GROUP BY 1, 2""",
    }


def _fares() -> dict[str, str]:
    def part(column: str) -> str:
        return ratio_avg(f"{column} / NULLIF(total_amount, 0) * 100")

    def pct(test: str) -> str:
        return share(hits(test), "COUNT(*)")

    def applied(column: str) -> str:
        return amount_avg(f"CASE WHEN {column} > 0 THEN {column} END")

    averages = {
        "fare_amount": ("avg_base_fare", "base_fare"),
        "extra": ("avg_extra", "extra"),
        "mta_tax": ("avg_mta_tax", "mta_tax"),
        "tip_amount": ("avg_tip", "tip"),
        "tolls_amount": ("avg_tolls", "tolls"),
        "improvement_surcharge": ("avg_improvement_surcharge", "improvement_surcharge"),
        "congestion_surcharge": ("avg_congestion_surcharge", "congestion_surcharge"),
        "airport_fee": ("avg_airport_fee", "airport_fee"),
        "cbd_congestion_fee": ("avg_cbd_fee", None),
        "total_amount": ("avg_total", "total"),
    }
    long = ", ".join(f"{amount_avg(c)} AS {n}" for c, (n, _) in averages.items())
    short = ", ".join(f"ROUND({amount_avg(c)}, 2) AS {n}" for c, (_, n) in averages.items() if n)
    band = """CASE WHEN tip_amount = 0 THEN '0% (No Tip)' WHEN tip_percentage < 10 THEN '1-9%'
        WHEN tip_percentage < 15 THEN '10-14%' WHEN tip_percentage < 20 THEN '15-19%'
        WHEN tip_percentage < 25 THEN '20-24%' WHEN tip_percentage < 30 THEN '25-29%' ELSE '30%+' END"""
    return {
        "fare_breakdown": f"""SELECT COUNT(*) AS total_trips, {long},
            {amount_sum("fare_amount")} AS total_base_fare, {amount_sum("tip_amount")} AS total_tips,
            {amount_sum("tolls_amount")} AS total_tolls, {amount_sum("congestion_surcharge")} AS total_congestion,
            {amount_sum("total_amount")} AS total_revenue, {part("tip_amount")} AS tip_pct_of_total,
            {part("tolls_amount")} AS tolls_pct_of_total, {part("congestion_surcharge")} AS congestion_pct_of_total
            FROM fact_trip WHERE {_CHEAP} AND total_amount > 0""",
        "fare_surcharge_frequency": f"""SELECT COUNT(*) AS total_trips,
            {hits("congestion_surcharge > 0")} AS trips_with_congestion,
            {hits("airport_fee > 0")} AS trips_with_airport_fee, {hits("cbd_congestion_fee > 0")} AS trips_with_cbd_fee,
            {hits("tolls_amount > 0")} AS trips_with_tolls, {hits("extra > 0")} AS trips_with_extra,
            {pct("congestion_surcharge > 0")} AS congestion_pct, {pct("airport_fee > 0")} AS airport_fee_pct,
            {pct("cbd_congestion_fee > 0")} AS cbd_fee_pct, {pct("tolls_amount > 0")} AS tolls_pct,
            {applied("congestion_surcharge")} AS avg_congestion_when_applied,
            {applied("airport_fee")} AS avg_airport_fee_when_applied, {applied("tolls_amount")} AS avg_tolls_when_applied
            FROM fact_trip WHERE {_CHEAP}""",
        "fare_by_rate_code": f"""SELECT rate_code_name, COUNT(*) AS trip_count, {amount_avg("fare_amount")} AS avg_fare,
            {amount_avg("tip_amount")} AS avg_tip, {amount_avg("tolls_amount")} AS avg_tolls,
            {amount_avg("extra")} AS avg_extra, {amount_avg("total_amount")} AS avg_total,
            {ratio_avg("tip_percentage")} AS avg_tip_percentage
            FROM fact_trip JOIN dim_rate_code USING (rate_code_id) WHERE {_CHEAP} GROUP BY 1""",
        "tip_ratio_distribution": f"""SELECT {band} AS tip_range, COUNT(*) AS trip_count,
            {share("COUNT(*)", f"SUM(COUNT(*)) {_ALL}")} AS pct_of_trips,
            {amount_avg("fare_amount")} AS avg_fare_in_range, {amount_avg("tip_amount")} AS avg_tip_in_range
            FROM fact_trip WHERE {_CHEAP} GROUP BY 1""",
        "api_fare_breakdown": f"""SELECT COUNT(*) AS total_trips, {short},
            ROUND({part("tip_amount")}, 2) AS tip_percentage_of_total FROM fact_trip WHERE {_CHEAP}""",
        "api_surcharges": f"""SELECT COUNT(*) AS total_trips, {hits("congestion_surcharge > 0")} AS congestion_count,
            {hits("airport_fee > 0")} AS airport_fee_count, {hits("tolls_amount > 0")} AS tolls_count,
            ROUND({pct("congestion_surcharge > 0")}, 2) AS congestion_pct,
            ROUND({pct("airport_fee > 0")}, 2) AS airport_fee_pct, ROUND({pct("tolls_amount > 0")}, 2) AS tolls_pct
            FROM fact_trip WHERE {_CHEAP}""",
    }


def _airport(s: Settings) -> dict[str, str]:
    kind = """CASE WHEN rate_code_id = 2 THEN 'JFK Airport' WHEN rate_code_id = 3 THEN 'Newark Airport'
        WHEN airport_fee > 0 THEN 'Other Airport' ELSE 'Regular Trip' END"""
    origin = f"""FROM fact_trip JOIN dim_location ON location_id = pu_location_id
        WHERE borough = '{s.home}' AND fare_amount > 0 AND (rate_code_id IN (2, 3) OR airport_fee > 0)"""
    label = "CASE rate_code_id WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark' ELSE 'Other' END"
    return {
        "airport_comparison": f"""SELECT {kind} AS trip_type, COUNT(*) AS trip_count,
            {amount_avg("fare_amount")} AS avg_fare, {amount_avg("trip_distance")} AS avg_distance,
            {int_avg("trip_duration_seconds")} / {_MIN} AS avg_duration_min, {amount_avg("tip_amount")} AS avg_tip,
            {ratio_avg("tip_percentage")} AS avg_tip_pct, {amount_avg("total_amount")} AS avg_total
            FROM fact_trip WHERE fare_amount > 0 AND fare_amount < 1000 GROUP BY 1""",
        "airport_top_origins": f"""SELECT zone, COUNT(*) AS airport_trip_count, {amount_avg("fare_amount")} AS avg_fare,
            {amount_avg("trip_distance")} AS avg_distance, {ratio_avg("tip_percentage")} AS avg_tip_pct,
            MODE() WITHIN GROUP (ORDER BY {label}) AS most_common_airport {origin}
            GROUP BY 1 HAVING COUNT(*) >= {s.min_airport_trips} ORDER BY airport_trip_count DESC, zone LIMIT 20""",
        "airport_by_hour": f"""SELECT CASE WHEN rate_code_id IN (2, 3) THEN 'Airport' ELSE 'Regular' END AS trip_type,
            pickup_hour, COUNT(*) AS trip_count, {amount_avg("fare_amount")} AS avg_fare
            FROM fact_trip WHERE fare_amount > 0 GROUP BY 1, 2""",
        "airport_revenue": f"""SELECT *, {share("total_revenue", f"SUM(total_revenue) {_ALL}")} AS pct_of_total_revenue
            FROM (SELECT rate_code_name, COUNT(*) AS trip_count, {amount_sum("total_amount")} AS total_revenue,
                    {amount_avg("total_amount")} AS avg_revenue_per_trip
                  FROM fact_trip JOIN dim_rate_code USING (rate_code_id)
                  WHERE fare_amount > 0 AND is_airport GROUP BY 1)""",
        "api_airport_comparison": f"""SELECT {kind} AS trip_type, COUNT(*) AS trip_count,
            ROUND({amount_avg("fare_amount")}, 2) AS avg_fare, ROUND({amount_avg("trip_distance")}, 2) AS avg_distance,
            ROUND({int_avg("trip_duration_seconds")} / {_MIN}, 1) AS avg_duration_min,
            ROUND({amount_avg("tip_amount")}, 2) AS avg_tip
            FROM fact_trip WHERE fare_amount > 0 AND fare_amount < 1000 GROUP BY 1""",
        "api_airport_origins": f"""SELECT zone, COUNT(*) AS trip_count, ROUND({amount_avg("fare_amount")}, 2) AS avg_fare,
            ROUND({amount_avg("trip_distance")}, 2) AS avg_distance {origin}
            GROUP BY 1 HAVING COUNT(*) >= 10 ORDER BY trip_count DESC, zone LIMIT 20""",
    }


def _flows(s: Settings) -> dict[str, str]:
    ends = f"""JOIN dim_location a ON a.location_id = pu_location_id
        JOIN dim_location b ON b.location_id = do_location_id
        WHERE a.borough = '{s.home}' AND b.borough = '{s.home}'"""
    return {
        "od_top_routes": f"""SELECT a.zone AS origin_zone, b.zone AS destination_zone, trip_count, avg_fare,
            avg_distance, avg_duration_sec / {_MIN} AS avg_duration_min, median_fare, p90_fare,
            avg_fare / NULLIF(avg_distance, 0) AS fare_per_mile,
            avg_distance / NULLIF(avg_duration_sec / 3600.0::DOUBLE, 0) AS avg_speed_mph,
            RANK() OVER (ORDER BY trip_count DESC) AS route_rank
            FROM mv_od_flows {ends} ORDER BY trip_count DESC, origin_zone, destination_zone LIMIT 50""",
        "od_flow_asymmetry": f"""SELECT a.zone AS zone_1, b.zone AS zone_2, forward_count, reverse_count, total_count,
            ABS(forward_count - reverse_count) AS flow_imbalance,
            {share("ABS(forward_count - reverse_count)", "total_count")} AS imbalance_pct,
            CASE WHEN forward_count > 2 * reverse_count THEN a.zone || ' → ' || b.zone || ' dominant'
                 WHEN reverse_count > 2 * forward_count THEN b.zone || ' → ' || a.zone || ' dominant'
                 ELSE 'Balanced' END AS flow_pattern
            FROM (SELECT LEAST(pu_location_id, do_location_id) AS one, GREATEST(pu_location_id, do_location_id) AS two,
                    {big("SUM(CASE WHEN pu_location_id < do_location_id THEN trip_count ELSE 0 END)")} AS forward_count,
                    {big("SUM(CASE WHEN pu_location_id > do_location_id THEN trip_count ELSE 0 END)")} AS reverse_count,
                    {big("SUM(trip_count)")} AS total_count
                  FROM mv_od_flows GROUP BY 1, 2 HAVING SUM(trip_count) >= {s.min_pair_trips})
            JOIN dim_location a ON a.location_id = one JOIN dim_location b ON b.location_id = two
            WHERE a.borough = '{s.home}' AND b.borough = '{s.home}'
            ORDER BY total_count DESC, zone_1, zone_2 LIMIT 30""",
        "od_zone_centrality": f"""SELECT zone AS origin_zone, COUNT(DISTINCT do_location_id) AS unique_destinations,
            {big("SUM(trip_count)")} AS total_trips, {ratio_avg("avg_fare")} AS avg_fare,
            {ratio_avg("avg_distance")} AS avg_distance
            FROM mv_od_flows JOIN dim_location ON location_id = pu_location_id WHERE borough = '{s.home}'
            GROUP BY 1 ORDER BY unique_destinations DESC, total_trips DESC, origin_zone LIMIT 20""",
        "od_distance_categories": f"""SELECT CASE WHEN avg_distance < 1 THEN 'Very Short (<1 mi)'
              WHEN avg_distance < 2 THEN 'Short (1-2 mi)' WHEN avg_distance < 5 THEN 'Medium (2-5 mi)'
              WHEN avg_distance < 10 THEN 'Long (5-10 mi)' ELSE 'Very Long (10+ mi)' END AS distance_category,
            COUNT(*) AS route_count, {big("SUM(trip_count)")} AS total_trips, {ratio_avg("avg_fare")} AS avg_fare,
            {ratio_avg(f"avg_duration_sec / {_MIN}")} AS avg_duration_min FROM mv_od_flows {ends} GROUP BY 1""",
        "api_top_routes": f"""SELECT a.zone AS origin, b.zone AS destination, trip_count, ROUND(avg_fare, 2) AS avg_fare,
            ROUND(avg_distance, 2) AS avg_distance, ROUND(avg_duration_sec / {_MIN}, 1) AS avg_duration_min
            FROM mv_od_flows {ends} ORDER BY trip_count DESC, origin, destination LIMIT 50""",
    }


def _vendors() -> dict[str, str]:
    pair = "FROM fact_trip JOIN dim_vendor USING (vendor_id)"
    of_all = share("trip_count", f"SUM(trip_count) {_ALL}")
    return {
        "vendor_performance": f"""SELECT vendor_name, vendor_short_name, trip_count, {of_all} AS market_share_pct,
            avg_fare, avg_tip, avg_distance, avg_duration_sec / {_MIN} AS avg_duration_min, avg_passengers,
            store_fwd_count, {share("store_fwd_count", "trip_count")} AS store_fwd_pct,
            avg_fare / NULLIF(avg_distance, 0) AS fare_per_mile,
            avg_distance / NULLIF(avg_duration_sec / 3600.0::DOUBLE, 0) AS avg_speed_mph
            FROM mv_vendor_performance JOIN dim_vendor USING (vendor_id)""",
        "vendor_by_hour": f"""SELECT vendor_name, pickup_hour, COUNT(*) AS trip_count,
            {amount_avg("fare_amount")} AS avg_fare, {amount_avg("trip_distance")} AS avg_distance,
            {amount_avg("tip_amount")} AS avg_tip {pair} WHERE fare_amount > 0 GROUP BY 1, 2""",
        "vendor_service_quality": f"""SELECT vendor_name, COUNT(*) AS total_trips,
            {hits("store_and_fwd_flag = 'Y'")} AS connection_issues,
            {share(hits("store_and_fwd_flag = 'Y'"), "COUNT(*)")} AS issue_rate_pct,
            {ratio_avg("avg_speed_mph")} AS avg_speed_mph, {ratio_avg("tip_percentage")} AS avg_tip_pct,
            {share(hits("tip_amount > 0"), "COUNT(*)")} AS tipping_frequency_pct {pair} WHERE {_CHEAP} GROUP BY 1""",
        "vendor_monthly_share": f"""SELECT *, {share("trip_count", "SUM(trip_count) OVER (PARTITION BY year, month)")}
              AS market_share_pct
            FROM (SELECT CAST(EXTRACT(YEAR FROM pickup_date) AS INTEGER) AS year,
                    CAST(EXTRACT(MONTH FROM pickup_date) AS INTEGER) AS month, vendor_name, COUNT(*) AS trip_count
                  {pair} WHERE fare_amount > 0 GROUP BY 1, 2, 3)""",
        "api_vendor_performance": f"""SELECT vendor_name, vendor_short_name AS vendor_short, trip_count,
            ROUND({of_all}, 2) AS market_share_pct, ROUND(avg_fare, 2) AS avg_fare, ROUND(avg_tip, 2) AS avg_tip,
            ROUND(avg_distance, 2) AS avg_distance, ROUND(avg_duration_sec / {_MIN}, 1) AS avg_duration_min
            FROM mv_vendor_performance JOIN dim_vendor USING (vendor_id)""",
    }


def _tipping() -> dict[str, str]:
    paid = f"FROM fact_trip JOIN dim_payment_type USING (payment_type_id) WHERE {_CHEAP}"
    often = share(hits("tip_amount > 0"), "COUNT(*)")
    of_all = share("COUNT(*)", f"SUM(COUNT(*)) {_ALL}")
    return {
        "tipping_by_payment_type": f"""SELECT payment_type_name, is_card_payment, allows_tip, COUNT(*) AS trip_count,
            {of_all} AS pct_of_trips, {amount_avg("tip_amount")} AS avg_tip, {amount_avg("fare_amount")} AS avg_fare,
            {ratio_avg("tip_percentage")} AS avg_tip_pct, {hits("tip_amount > 0")} AS trips_with_tip,
            {often} AS tipping_frequency_pct, {quantile(0.25, "tip_percentage")} AS tip_pct_q25,
            {quantile(0.5, "tip_percentage")} AS tip_pct_median, {quantile(0.75, "tip_percentage")} AS tip_pct_q75
            {paid} GROUP BY 1, 2, 3""",
        "tipping_by_hour": f"""SELECT payment_type_name, pickup_hour, is_weekend, trip_count, avg_tip, avg_fare,
            avg_tip_pct, {share("trips_with_tip", "trip_count")} AS tipping_frequency_pct
            FROM mv_payment_patterns JOIN dim_payment_type USING (payment_type_id)""",
        "tipper_categories": f"""SELECT CASE WHEN tip_percentage = 0 THEN 'No Tip'
              WHEN tip_percentage < 10 THEN 'Low (1-9%)'
              WHEN tip_percentage >= 10 AND tip_percentage <= 14.9::DOUBLE THEN 'Standard (10-15%)'
              WHEN tip_percentage >= 15 AND tip_percentage <= 19.9::DOUBLE THEN 'Good (15-20%)'
              WHEN tip_percentage >= 20 AND tip_percentage <= 29.9::DOUBLE THEN 'Generous (20-30%)'
              ELSE 'Very Generous (30%+)' END AS tipper_category, COUNT(*) AS trip_count, {of_all} AS pct_of_trips,
            {amount_avg("fare_amount")} AS avg_fare, {amount_avg("trip_distance")} AS avg_distance,
            {int_avg("trip_duration_seconds")} / {_MIN} AS avg_duration_min {paid} AND allows_tip GROUP BY 1""",
        "tip_by_trip_bands": f"""SELECT CASE WHEN trip_distance < 1 THEN '<1 mi' WHEN trip_distance < 2 THEN '1-2 mi'
              WHEN trip_distance < 5 THEN '2-5 mi' WHEN trip_distance < 10 THEN '5-10 mi' ELSE '10+ mi' END
              AS distance_range,
            CASE WHEN fare_amount < 10 THEN '<$10' WHEN fare_amount < 20 THEN '$10-20'
              WHEN fare_amount < 30 THEN '$20-30' WHEN fare_amount < 50 THEN '$30-50' ELSE '$50+' END AS fare_range,
            COUNT(*) AS trip_count, {ratio_avg("tip_percentage")} AS avg_tip_pct, {often} AS tipping_frequency_pct
            {paid} AND allows_tip GROUP BY 1, 2""",
        "api_tipping_by_payment": f"""SELECT payment_type_name AS payment_type, is_card_payment AS is_card, allows_tip,
            COUNT(*) AS trip_count, ROUND({of_all}, 2) AS pct_of_trips, ROUND({amount_avg("tip_amount")}, 2) AS avg_tip,
            ROUND({amount_avg("fare_amount")}, 2) AS avg_fare, ROUND({ratio_avg("tip_percentage")}, 2) AS avg_tip_pct,
            ROUND({often}, 2) AS tipping_frequency_pct {paid} GROUP BY 1, 2, 3""",
    }


def _anomalies() -> dict[str, str]:
    ends = """JOIN dim_location a ON a.location_id = pu_location_id
        JOIN dim_location b ON b.location_id = do_location_id"""
    id_zones = "trip_id, pickup_datetime, a.zone AS pickup_zone, b.zone AS dropoff_zone"
    mins = f"trip_duration_seconds / {_MIN} AS duration_min"
    dear = "trip_distance > 0 AND fare_per_mile > 50"
    stuck = "trip_distance > 0 AND trip_distance < 1 AND trip_duration_seconds > 1800 AND avg_speed_mph < 2"
    rounds = "fare_amount IN (10, 20, 30, 40, 50, 75, 100, 150, 200)"
    far = f"""trip_distance > (SELECT {quantile(0.99, "trip_distance")} FROM fact_trip
        WHERE trip_distance > 0 AND trip_distance < 200)"""
    pays = "JOIN dim_payment_type USING (payment_type_id)"
    rates = "JOIN dim_rate_code USING (rate_code_id)"
    untipped = "fare_amount > 50 AND tip_amount = 0 AND allows_tip"

    def limits(column: str) -> str:
        return f"{quantile(0.01, column)} AS lo_{column}, {quantile(0.99, column)} AS hi_{column}"

    def mark(column: str, low: str, high: str) -> str:
        return f"CASE WHEN {column} < lo_{column} THEN '{low}' WHEN {column} > hi_{column} THEN '{high}' END"

    def kind(name: str, source: str) -> str:
        return f"""SELECT '{name}' AS anomaly_type, COUNT(*) AS anomaly_count,
            {share("COUNT(*)", "(SELECT COUNT(*) FROM fact_trip)")} AS pct_of_total FROM fact_trip {source}"""

    return {
        "anomaly_high_fare_per_mile": f"""SELECT {id_zones}, fare_amount, trip_distance, fare_per_mile, {mins},
            avg_speed_mph, rate_code_name, 'High fare per mile' AS anomaly_type FROM fact_trip {ends} {rates}
            WHERE {dear} AND trip_distance < 100 AND fare_amount < 1000
            ORDER BY fare_per_mile DESC, trip_id LIMIT 100""",
        "anomaly_slow_trips": f"""SELECT {id_zones}, trip_distance, {mins}, avg_speed_mph, fare_amount,
            'Severe traffic/waiting' AS anomaly_type FROM fact_trip {ends} WHERE {stuck}
            ORDER BY duration_min DESC, trip_id LIMIT 100""",
        "anomaly_no_tip_expensive": f"""SELECT {id_zones}, fare_amount, tip_amount, trip_distance, {mins},
            payment_type_name, 'No tip on expensive trip' AS anomaly_type FROM fact_trip {ends} {pays}
            WHERE {untipped} ORDER BY fare_amount DESC, trip_id LIMIT 100""",
        "anomaly_extreme_distance": f"""SELECT {id_zones}, trip_distance, {mins}, fare_amount, avg_speed_mph,
            'Extreme distance' AS anomaly_type FROM fact_trip {ends} WHERE {far}
            ORDER BY trip_distance DESC, trip_id LIMIT 100""",
        "anomaly_round_fares": f"""SELECT {id_zones}, fare_amount, total_amount, trip_distance, rate_code_name,
            'Suspicious round fare' AS anomaly_type FROM fact_trip {ends} {rates} WHERE {rounds} AND is_standard
            ORDER BY fare_amount DESC, pickup_datetime DESC, trip_id LIMIT 100""",
        "anomaly_summary": " UNION ALL ".join(
            [
                kind("High fare per mile (>$50/mi)", f"WHERE {dear}"),
                kind("Severe traffic (<2 mph, >30 min)", f"WHERE {stuck}"),
                kind("No tip on expensive trip (>$50)", f"{pays} WHERE {untipped}"),
                kind("Extreme distance (>99th percentile)", f"WHERE {far}"),
                kind("Round negotiated fares", f"{rates} WHERE {rounds} AND is_standard"),
            ]
        ),
        "outlier_percentiles": f"""SELECT trip_id, pickup_datetime, fare_amount, trip_distance, {mins},
            {mark("fare_amount", "Low fare outlier", "High fare outlier")} AS fare_outlier,
            {mark("trip_distance", "Very short trip", "Very long trip")} AS distance_outlier,
            {mark("trip_duration_seconds", "Very fast trip", "Very slow trip")} AS duration_outlier
            FROM fact_trip CROSS JOIN (SELECT {limits("fare_amount")}, {limits("trip_distance")},
              {limits("trip_duration_seconds")} FROM fact_trip WHERE fare_amount > 0 AND trip_distance > 0)
            WHERE fare_amount > 0 AND trip_distance > 0
              AND (fare_amount NOT BETWEEN lo_fare_amount AND hi_fare_amount
                OR trip_distance NOT BETWEEN lo_trip_distance AND hi_trip_distance
                OR trip_duration_seconds NOT BETWEEN lo_trip_duration_seconds AND hi_trip_duration_seconds)
            ORDER BY pickup_datetime DESC, trip_id LIMIT 200""",
        "data_quality_report": f"""SELECT COUNT(*) AS total_records, {hits(_CHEAP)} AS valid_fares,
            {hits("trip_distance > 0")} AS valid_distances, {hits("trip_duration_seconds > 0")} AS valid_durations,
            {hits("passenger_count BETWEEN 1 AND 6")} AS valid_passengers, {amount_avg("fare_amount")} AS avg_fare,
            {amount_avg("trip_distance")} AS avg_distance,
            {int_avg("trip_duration_seconds")} / {_MIN} AS avg_duration_min,
            MIN(pickup_datetime) AS earliest_trip, MAX(pickup_datetime) AS latest_trip FROM fact_trip""",
        "api_high_fare_per_mile": f"""SELECT {id_zones}, ROUND(fare_amount, 2) AS fare_amount,
            ROUND(trip_distance, 2) AS trip_distance, ROUND(f.fare_per_mile, 2) AS fare_per_mile,
            ROUND(trip_duration_seconds / {_MIN}, 1) AS duration_min FROM fact_trip f {ends}
            WHERE {dear} AND trip_distance < 100 AND fare_amount < 1000
            ORDER BY ROUND(f.fare_per_mile, 2) DESC, trip_id LIMIT 100""",
        "api_anomaly_summary": f"""SELECT *,
            ROUND({share("high_fare_per_mile_count", "total_trips")}, 2) AS high_fare_per_mile_percentage,
            ROUND({share("no_tip_expensive_count", "total_trips")}, 2) AS no_tip_expensive_percentage
            FROM (SELECT COUNT(*) AS total_trips, {hits(f"{dear} AND fare_amount < 1000")} AS high_fare_per_mile_count,
                    {hits("fare_amount > 50 AND tip_amount = 0 AND payment_type_id = 1")} AS no_tip_expensive_count
                  FROM fact_trip)""",
    }


def _profiles(s: Settings) -> dict[str, str]:
    start = "PULocationID IN (SELECT location_id FROM home)"
    end = "DOLocationID IN (SELECT location_id FROM home)"

    def share_of(test: str, name: str, percentage: str, total: bool) -> str:
        lead = "COUNT(*) AS total_trips, " if total else ""
        return f"""SELECT {lead}{big("SUM(CASE WHEN hit THEN 1 ELSE 0 END)")} AS {name},
            ROUND({share("SUM(CASE WHEN hit THEN 1 ELSE 0 END)", "COUNT(*)")}, 2) AS {percentage}
            FROM (SELECT {test} AS hit FROM raw_trips)"""

    def spread(column: str) -> str:
        return f"""SELECT {column}, COUNT(*) AS trip_count,
            ROUND({share("COUNT(*)", f"SUM(COUNT(*)) {_ALL}")}, 2) AS percentage FROM raw_trips GROUP BY 1"""

    def top_ids(columns: str, where: str = "") -> str:
        return f"""SELECT {columns}, COUNT(*) AS trip_count FROM raw_trips {where}
            GROUP BY ALL ORDER BY trip_count DESC, {columns} LIMIT 10"""

    return {
        "profile_preview": """SELECT * FROM raw_trips ORDER BY tpep_pickup_datetime NULLS FIRST,
            COLUMNS(lambda c: c <> 'tpep_pickup_datetime') NULLS FIRST LIMIT 10""",
        "profile_row_count": "SELECT COUNT(*) AS total_trips FROM raw_trips",
        "profile_date_range": """SELECT MIN(tpep_pickup_datetime) AS first_trip,
            MAX(tpep_pickup_datetime) AS last_trip FROM raw_trips""",
        "profile_borough_distribution": """SELECT borough, COUNT(*) AS "count" FROM dim_location
            WHERE borough IS NOT NULL GROUP BY 1""",
        "profile_home_zones": f"SELECT location_id, borough, zone FROM dim_location WHERE borough = '{s.home}'",
        "profile_home_pickup_share": share_of(start, "home_pickup", "pickup_percentage", True),
        "profile_home_dropoff_share": share_of(end, "home_dropoff", "dropoff_percentage", True),
        "profile_home_both_share": share_of(f"{start} AND {end}", "both_home", "percentage", False),
        "profile_home_either_share": share_of(f"{start} OR {end}", "either_home", "percentage", False),
        "profile_raw_top_routes": top_ids("PULocationID, DOLocationID", f"WHERE {start} AND {end}"),
        "profile_location_cardinality": """SELECT COUNT(*) AS total_trips,
            COUNT(DISTINCT PULocationID) AS unique_pickup_zones, COUNT(DISTINCT DOLocationID) AS unique_dropoff_zones
            FROM raw_trips""",
        "profile_vendor_distribution": spread("VendorID"),
        "profile_payment_distribution": spread("payment_type"),
        "profile_rate_distribution": spread("RatecodeID"),
        "profile_passenger_distribution": spread("passenger_count"),
        "profile_fare_stats": f"""SELECT ROUND({amount_avg("fare_amount")}, 2) AS avg_fare,
            ROUND(MIN(fare_amount), 2) AS min_fare, ROUND(MAX(fare_amount), 2) AS max_fare,
            ROUND({amount_avg("tip_amount")}, 2) AS avg_tip, ROUND({amount_avg("trip_distance")}, 2) AS avg_distance
            FROM raw_trips WHERE {_CHEAP}""",
        "profile_raw_hourly": """SELECT CAST(EXTRACT(HOUR FROM tpep_pickup_datetime) AS INTEGER) AS hour,
            COUNT(*) AS trip_count FROM raw_trips GROUP BY 1""",
        "profile_raw_top_pickups": top_ids("PULocationID"),
        "profile_raw_top_dropoffs": top_ids("DOLocationID"),
        "profile_raw_quality": f"""SELECT COUNT(*) AS total_trips, {hits("fare_amount <= 0")} AS invalid_fares,
            {hits("trip_distance <= 0")} AS invalid_distance,
            {hits("passenger_count <= 0 OR passenger_count > 6")} AS invalid_passengers,
            {hits("PULocationID IS NULL OR DOLocationID IS NULL")} AS null_locations FROM raw_trips""",
    }


def _patterns(s: Settings, since: dt.date) -> dict[str, str]:
    start = "JOIN dim_location ON location_id = pu_location_id"
    return {
        "pattern_zone_popularity": f"""SELECT zone, COUNT(*) AS trip_count, {amount_avg("fare_amount")} AS avg_fare
            FROM fact_trip {start} WHERE borough = '{s.home}' GROUP BY 1 ORDER BY trip_count DESC, zone LIMIT 10""",
        "pattern_hourly_since": f"""SELECT pickup_hour, COUNT(*) AS trip_count,
            {amount_avg("trip_distance")} AS avg_distance
            FROM fact_trip WHERE pickup_date >= DATE '{since}' GROUP BY 1""",
        "pattern_od_flows": f"""SELECT a.zone AS origin, b.zone AS destination, COUNT(*) AS trip_count,
            {amount_avg("trip_distance")} AS avg_distance,
            {int_avg("trip_duration_seconds")} / {_MIN} AS avg_duration_min FROM fact_trip
            JOIN dim_location a ON a.location_id = pu_location_id JOIN dim_location b ON b.location_id = do_location_id
            WHERE a.borough = '{s.home}' AND b.borough = '{s.home}'
            GROUP BY 1, 2 ORDER BY trip_count DESC, origin, destination LIMIT 100""",
        "pattern_fare_anomaly": f"""SELECT trip_id, zone, fare_amount, trip_distance, fare_per_mile
            FROM fact_trip {start} WHERE trip_distance > 0.5 AND fare_amount > 0 AND fare_per_mile > 50
            ORDER BY fare_per_mile DESC, trip_id LIMIT 100""",
        "pattern_vendor_share": f"""SELECT vendor_name, COUNT(*) AS trip_count,
            {share("COUNT(*)", f"SUM(COUNT(*)) {_ALL}")} AS market_share_pct
            FROM fact_trip JOIN dim_vendor USING (vendor_id) GROUP BY 1""",
    }


def _comparisons(s: Settings, first: str, second: str) -> dict[str, str]:
    def compare(metrics: dict[str, str], source: str) -> str:
        rows = []
        for name, formula in metrics.items():

            def one(zone: str, formula: str = formula) -> str:
                return f"(SELECT CAST({formula} AS DOUBLE) FROM z WHERE zone = '{zone}' HAVING COUNT(*) > 0)"

            rows.append(f"SELECT '{name}' AS metric, {one(first)} AS zone_a, {one(second)} AS zone_b")
        union = " UNION ALL ".join(rows)
        return f"""SELECT *, zone_a - zone_b AS difference FROM (
            WITH z AS (SELECT * FROM {source} WHERE borough = '{s.home}') {union}
          ) WHERE zone_a IS NOT NULL OR zone_b IS NOT NULL"""

    at = "JOIN dim_location ON location_id = pu_location_id"
    return {
        "compare_zones_popularity": compare(
            {
                "pickup_count": "SUM(pickup_count)",
                "avg_fare": ratio_avg("avg_fare"),
                "avg_distance": ratio_avg("avg_distance"),
                "median_fare": ratio_avg("median_fare"),
            },
            "mv_zone_pickup JOIN dim_location USING (location_id)",
        ),
        "compare_zones_airport": compare(
            {
                "airport_trip_count": "COUNT(*)",
                "avg_fare": amount_avg("fare_amount"),
                "avg_distance": amount_avg("trip_distance"),
            },
            f"(SELECT * FROM fact_trip {at} WHERE fare_amount > 0 AND (rate_code_id IN (2, 3) OR airport_fee > 0))",
        ),
        "compare_zones_od": compare(
            {
                "route_count": "COUNT(*)",
                "total_trips": "SUM(trip_count)",
                "avg_fare": ratio_avg("avg_fare"),
                "avg_distance": ratio_avg("avg_distance"),
                "avg_duration_min": ratio_avg(f"avg_duration_sec / {_MIN}"),
                "fare_per_mile": ratio_avg("avg_fare / NULLIF(avg_distance, 0)"),
            },
            f"mv_od_flows {at}",
        ),
    }


def build(settings: Settings, since: dt.date, first_zone: str, second_zone: str) -> dict[str, str]:
    bodies = {
        **_load(),
        **_rollups(),
        **_zones(settings),
        **_demand(),
        **_fares(),
        **_airport(settings),
        **_flows(settings),
        **_vendors(),
        **_tipping(),
        **_anomalies(),
        **_profiles(settings),
        **_patterns(settings, since),
        **_comparisons(settings, first_zone, second_zone),
    }
    return {name: with_tables(settings, body) for name, body in bodies.items()}
