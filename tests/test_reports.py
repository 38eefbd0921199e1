from __future__ import annotations

import datetime as dt

import pytest
from conftest import PLAIN, dicts

from tripmill.operators import airport, anomalies, compare, demand, fares, flows, patterns, profile, quality
from tripmill.operators import tipping, vendors, zones
from tripmill.plans import catalog

START = PLAIN["tpep_pickup_datetime"]


def ride(origin: int, destination: int, **rest) -> dict:
    return {"PULocationID": origin, "DOLocationID": destination, **rest}


def tip(percent: float, fare: float = 100.0, **rest) -> dict:
    return {"fare_amount": fare, "tip_amount": percent * fare / 100, **rest}


def by(rows, key):
    return {r[key]: r for r in rows}


def test_tip_ranges(tables):
    ratios = [0.0, 9.99, 10.0, 14.99, 15.0, 20.0, 25.0, 29.99, 30.0, -5.0]
    t = tables(*[tip(x) for x in ratios], {"tip_amount": None})
    rows = dicts(fares.tip_ratio_distribution(t))
    assert [(r["tip_range"], r["trip_count"]) for r in rows] == [
        ("0% (No Tip)", 1),
        ("1-9%", 2),
        ("10-14%", 2),
        ("15-19%", 1),
        ("20-24%", 1),
        ("25-29%", 2),
        ("30%+", 2),
    ]
    assert sum(r["pct_of_trips"] for r in rows) == pytest.approx(100)


def test_gaps_between_tipper_classes(tables):
    t = tables(*[tip(x) for x in (0.0, 5.0, 14.9, 14.95, 19.95, 29.95, 22.0)], tip(50.0, payment_type=2))
    rows = [(r["tipper_category"], r["trip_count"]) for r in dicts(tipping.tipper_categories(t))]
    assert rows == [
        ("No Tip", 1),
        ("Low (1-9%)", 1),
        ("Standard (10-15%)", 1),
        ("Generous (20-30%)", 1),
        ("Very Generous (30%+)", 3),
    ]


def test_trip_and_fare_bands(tables):
    t = tables(
        {"trip_distance": 0.99, "fare_amount": 9.99},
        {"trip_distance": 1.0, "fare_amount": 10.0, "tip_amount": 1.0},
        {"trip_distance": 10.0, "fare_amount": 50.0},
        {"trip_distance": 10.0, "fare_amount": 50.0, "payment_type": 2},
    )
    rows = [(r["distance_range"], r["fare_range"], r["trip_count"]) for r in dicts(tipping.tip_by_trip_bands(t))]
    assert sorted(rows) == [("1-2 mi", "$10-20", 1), ("10+ mi", "$50+", 1), ("<1 mi", "<$10", 1)]


def test_payment_types_of_one_name_are_one_row(tables):
    t = tables({"payment_type": 0}, {"payment_type": 5}, tip(10), tip(30), {"payment_type": 8})
    rows = by(dicts(tipping.by_payment_type(t)), "payment_type_name")
    assert rows["Unknown"]["trip_count"] == 2
    assert rows["Credit card"]["tip_pct_median"] == pytest.approx(20)
    assert rows["Credit card"]["tip_pct_q25"] == pytest.approx(15)
    assert sum(r["pct_of_trips"] for r in rows.values()) == pytest.approx(100)
    assert set(rows) == {"Unknown", "Credit card"}


def test_trip_type_priority(tables):
    t = tables(
        {"RatecodeID": 2, "airport_fee": 1.75, **tip(20)},
        {"RatecodeID": 3},
        {"airport_fee": 1.75},
        {"airport_fee": None},
        {"airport_fee": 0.0},
    )
    rows = by(dicts(airport.comparison(t)), "trip_type")
    counts = {k: r["trip_count"] for k, r in rows.items()}
    assert counts == {"JFK Airport": 1, "Newark Airport": 1, "Other Airport": 1, "Regular Trip": 2}
    assert rows["JFK Airport"]["avg_tip_pct"] == 20.0
    hours = {r["trip_type"]: r["trip_count"] for r in dicts(airport.by_hour(t))}
    assert hours == {"Airport": 2, "Regular": 3}
    shares = [r["pct_of_total_revenue"] for r in dicts(airport.revenue(t))]
    assert shares == [50.0, 50.0]


@pytest.mark.parametrize(
    ("codes", "label"),
    [([2, 2, 3, 3], "JFK"), ([3, 3, 2], "Newark"), ([1, 1, 2], "Other"), ([1, 3], "Newark"), ([1, 2], "JFK")],
)
def test_commonest_airport(tables, codes, label):
    t = tables(*[{"RatecodeID": c, "airport_fee": 1.0} for c in codes])
    assert airport.top_origins(t).first()["most_common_airport"] == label


def test_airport_origin_threshold(tables):
    rows = [ride(1, 2, RatecodeID=2)] * 3 + [ride(2, 1, RatecodeID=2)] * 2
    t = tables(*rows, min_airport_trips=3)
    assert [r["zone"] for r in dicts(airport.top_origins(t))] == ["A"]
    assert dicts(airport.api_top_origins(t)) == []
    assert [r["zone"] for r in dicts(airport.api_top_origins(t, min_trips=2))] == ["A", "B"]


def test_vendor_names(tables):
    t = tables({"VendorID": 6}, {"VendorID": 7}, {"VendorID": 7}, {"VendorID": 1}, {"VendorID": 9})
    rows = dicts(vendors.performance(t))
    assert [(r["vendor_short_name"], r["trip_count"]) for r in rows] == [("Other", 2), ("CMT", 1), ("Other", 1)]
    assert sum(r["market_share_pct"] for r in rows) == pytest.approx(100)
    assert {r["vendor_name"]: r["trip_count"] for r in dicts(vendors.by_hour(t))} == {
        "Other": 3,
        "Creative Mobile Technologies": 1,
    }
    assert {r["vendor_name"]: r["market_share_pct"] for r in dicts(vendors.monthly_share(t))} == {
        "Other": 75.0,
        "Creative Mobile Technologies": 25.0,
    }


def test_vendor_quality(tables):
    t = tables({"store_and_fwd_flag": "Y"}, {"store_and_fwd_flag": None}, tip(10), tip(30))
    row = vendors.service_quality(t).first()
    assert (row["connection_issues"], row["issue_rate_pct"], row["tipping_frequency_pct"]) == (1, 25.0, 50.0)
    assert row["avg_tip_pct"] == 10.0
    assert row["avg_speed_mph"] == pytest.approx(12)


def test_zones_of_one_name(tables):
    t = tables(ride(3, 1), ride(4, 1), ride(4, 2), min_od_trips=1)
    assert sorted(r["pickup_count"] for r in dicts(zones.top_pickup(t)) if r["zone"] == "C") == [1, 2]
    rows = by(dicts(patterns.zone_popularity(t)), "zone")
    assert rows["C"]["trip_count"] == 3
    central = by(dicts(flows.zone_centrality(t)), "origin_zone")
    assert (central["C"]["unique_destinations"], central["C"]["total_trips"]) == (2, 3)


def test_idle_zone_is_balanced(tables):
    rows = by(dicts(zones.activity_score(tables(ride(1, 2), ride(1, 2)))), "zone")
    assert rows["Idle"]["total_activity"] == 0
    assert rows["Idle"]["combined_avg_fare"] == 0.0
    assert rows["Idle"]["zone_type"] == "Balanced"
    assert rows["A"]["zone_type"] == "Origin Zone"
    assert rows["B"]["zone_type"] == "Destination Zone"
    assert rows["A"]["combined_avg_fare"] == 5.0


def test_ranks_with_ties(tables):
    t = tables(ride(1, 2), ride(2, 1), ride(3, 3), ride(3, 3))
    assert [(r["zone"], r["popularity_rank"]) for r in dicts(zones.top_pickup(t))] == [("C", 1), ("A", 2), ("B", 2)]
    assert [r["popularity_rank"] for r in dicts(zones.top_dropoff(t, 2))] == [1, 2]


def test_flow_asymmetry(tables):
    t = tables(
        *[ride(1, 2)] * 4,
        *[ride(2, 1)] * 2,
        *[ride(1, 3)] * 5,
        *[ride(3, 1)] * 2,
        *[ride(2, 2)] * 3,
        *[ride(4, 2)] * 5,
        *[ride(2, 4)] * 1,
    )
    rows = {(r["zone_1"], r["zone_2"]): r for r in dicts(flows.flow_asymmetry(t))}
    assert rows["A", "B"]["flow_pattern"] == "Balanced"
    assert rows["A", "B"]["imbalance_pct"] == pytest.approx(100 * 2 / 6)
    assert rows["A", "C"]["flow_pattern"] == "A → C dominant"
    assert rows["B", "C"]["flow_pattern"] == "C → B dominant"
    loop = rows["B", "B"]
    assert (loop["forward_count"], loop["reverse_count"], loop["total_count"]) == (0, 0, 3)
    assert loop["flow_pattern"] == "Balanced"
    total = sum(r["forward_count"] + r["reverse_count"] for r in rows.values())
    assert total + 3 == t.fact_trip.count()


def test_route_thresholds(tables):
    rows = [ride(1, 2)] * 4 + [ride(2, 1)] * 3
    t = tables(*rows, min_od_trips=4, min_pair_trips=5)
    assert [r["trip_count"] for r in dicts(flows.top_routes(t))] == [4]
    assert dicts(flows.flow_asymmetry(t)) == []


def test_route_percentiles(tables):
    t = tables(*[ride(1, 2, fare_amount=f) for f in (1.0, 2.0, 4.0)])
    row = flows.top_routes(t).first()
    assert (row["median_fare"], row["p90_fare"]) == (2.0, pytest.approx(3.6))
    assert row["route_rank"] == 1


def test_distance_categories(tables):
    miles = {(1, 2): 0.5, (2, 1): 1.0, (1, 3): 4.99, (3, 1): 5.0, (2, 3): 10.0}
    t = tables(*[ride(*ends, trip_distance=d) for ends, d in miles.items()])
    assert [r["route_count"] for r in dicts(flows.distance_categories(t))] == [1] * 5


def at(day: int, hour: int, **rest) -> dict:
    start = dt.datetime(2025, 1, day, hour)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=10), **rest}


def test_demand(tables):
    t = tables(at(4, 8), at(4, 8, fare_amount=30.0), at(11, 8, fare_amount=10.0), at(6, 18), at(7, 2), at(7, 12))
    hours = by(dicts(demand.hourly(t)), "pickup_hour")
    assert hours[8]["total_trips"] == 3
    assert hours[8]["avg_fare"] == 15.0  # mean of the dates' means 20 and 10
    assert sum(r["pct_of_total"] for r in hours.values()) == pytest.approx(100)
    rush = by(dicts(demand.rush_hour(t)), "pickup_hour")
    assert rush[8]["avg_hourly_trips"] == 1.5
    assert {h: r["time_category"] for h, r in rush.items()} == {
        8: "Morning Rush",
        18: "Evening Rush",
        2: "Late Night",
        12: "Regular Hours",
    }
    assert max(r["normalized_demand"] for r in dicts(demand.heatmap(t))) == 1.0
    month = demand.monthly_trend(t).first()
    assert (month["total_trips"], month["avg_trips_per_day"]) == (6, 1.5)
    days = [(r["day_name"], r["is_weekend"]) for r in dicts(demand.day_of_week(t))]
    assert days == [("Monday", False), ("Tuesday", False), ("Saturday", True)]
    assert len(dicts(demand.weekend_vs_weekday(t))) == 4


def test_recent_activity(tables):
    rows = [at(1, 8), at(2, 8), at(31, 9)]
    late = dt.datetime(2025, 2, 1, 10)
    rows.append({"tpep_pickup_datetime": late, "tpep_dropoff_datetime": late + dt.timedelta(minutes=5)})
    assert [r["pickup_hour"] for r in dicts(zones.activity_by_hour(tables(*rows)))] == [8, 9, 10]
    t = tables(*rows, as_of=dt.date(2025, 3, 2), recent_days=30)
    assert [r["pickup_hour"] for r in dicts(zones.activity_by_hour(t))] == [9, 10]
    first = zones.activity_by_hour(tables(*rows)).first()
    assert first["trip_count"] == 1  # 1 January is 31 days before 1 February


def test_surcharges(tables):
    t = tables({"congestion_surcharge": 2.5}, {"tolls_amount": 6.0, "extra": 0.0}, {"airport_fee": None}, {})
    row = fares.surcharge_frequency(t).first()
    assert (row["trips_with_congestion"], row["trips_with_tolls"], row["trips_with_airport_fee"]) == (1, 1, 0)
    assert (row["congestion_pct"], row["cbd_fee_pct"]) == (25.0, 0.0)
    assert row["avg_congestion_when_applied"] == 2.5
    assert row["avg_airport_fee_when_applied"] is None


def test_breakdown_needs_a_total(tables):
    t = tables({"total_amount": 0.0}, {"total_amount": -3.0}, {"total_amount": 20.0, "tip_amount": 4.0})
    row = fares.breakdown(t).first()
    assert (row["total_trips"], row["tip_pct_of_total"], row["total_revenue"]) == (1, 20.0, 20.0)
    assert fares.api_breakdown(t).first()["total_trips"] == 3


def test_anomalies(tables):
    slow = {"trip_distance": 0.5, "tpep_dropoff_datetime": START + dt.timedelta(minutes=40)}
    t = tables(
        {"fare_amount": 101.0, "trip_distance": 2.0},
        {"fare_amount": 100.0, "trip_distance": 2.0, "payment_type": 2},
        {"fare_amount": 20.0, "RatecodeID": 5, "trip_distance": 3.0},
        {"fare_amount": 11.0, **slow},
        {"fare_amount": 12.0, "trip_distance": 150.0},
    )
    assert [r["fare_amount"] for r in dicts(anomalies.high_fare_per_mile(t))] == [101.0]
    assert [r["fare_amount"] for r in dicts(anomalies.slow_trips(t))] == [11.0]
    assert [r["fare_amount"] for r in dicts(anomalies.no_tip_expensive(t))] == [101.0]
    assert [r["fare_amount"] for r in dicts(anomalies.round_fares(t))] == [100.0]
    assert [r["trip_distance"] for r in dicts(anomalies.extreme_distance(t))] == [150.0]
    rows = by(dicts(anomalies.summary(t)), "anomaly_type")
    assert {k: r["anomaly_count"] for k, r in rows.items()} == dict.fromkeys(rows, 1)
    assert {r["pct_of_total"] for r in rows.values()} == {20.0}
    short = anomalies.api_summary(t).first()
    assert (short["total_trips"], short["high_fare_per_mile_count"], short["no_tip_expensive_percentage"]) == (5, 1, 20.0)


def test_outlier_labels(tables):
    t = tables({"fare_amount": 1.0}, *[{"fare_amount": 10.0}] * 98, {"fare_amount": 90.0, "trip_distance": 50.0})
    rows = sorted((r["fare_outlier"], r["distance_outlier"]) for r in dicts(anomalies.outlier_percentiles(t)))
    assert rows == [("High fare outlier", "Very long trip"), ("Low fare outlier", None)]


def test_comparison_of_two_zones(tables):
    t = tables(ride(1, 2), ride(1, 3, fare_amount=20.0), ride(2, 1, RatecodeID=2, fare_amount=5.0))
    rows = by(dicts(compare.popularity(t, "A", "B")), "metric")
    assert (rows["pickup_count"]["zone_a"], rows["pickup_count"]["difference"]) == (2.0, 1.0)
    assert (rows["avg_fare"]["zone_a"], rows["avg_fare"]["difference"]) == (15.0, 10.0)
    routes = by(dicts(compare.flows(t, "A", "B")), "metric")
    assert routes["route_count"]["difference"] == 1.0
    trips = by(dicts(compare.airport(t, "A", "B")), "metric")
    assert (trips["airport_trip_count"]["zone_a"], trips["airport_trip_count"]["zone_b"]) == (None, 1.0)


def test_profiles_of_raw_trips(tables):
    t = tables(
        ride(1, 9, fare_amount=-1.0, passenger_count=None),
        ride(9, 9, trip_distance=0.0, passenger_count=9.0),
        ride(1, 2, VendorID=None),
        ride(None, 2),
    )
    assert dict(profile.quality(t).first().asDict()) == {
        "total_trips": 4,
        "invalid_fares": 1,
        "invalid_distance": 1,
        "invalid_passengers": 1,
        "null_locations": 1,
    }
    vendors_found = {r["VendorID"]: r["percentage"] for r in dicts(profile.vendor_distribution(t))}
    assert vendors_found == {1: 75.0, None: 25.0}
    assert [r["passenger_count"] for r in dicts(profile.passenger_distribution(t))] == [1.0, 9.0, None]
    assert profile.home_pickup_share(t).first()["pickup_percentage"] == 50.0
    assert profile.home_dropoff_share(t).first()["home_dropoff"] == 2
    assert profile.home_both_share(t).first()["both_home"] == 1
    assert profile.home_either_share(t).first()["either_home"] == 3
    row = profile.location_cardinality(t).first()
    assert (row["total_trips"], row["unique_pickup_zones"], row["unique_dropoff_zones"]) == (4, 2, 2)
    assert {r["borough"]: r["count"] for r in dicts(profile.borough_distribution(t))} == {"Home": 5, "Away": 1}
    assert [r["zone"] for r in dicts(profile.home_zones(t))] == ["A", "B", "C", "C", "Idle"]
    assert profile.preview(t, 3).count() == 3
    names = [r["column_name"] for r in dicts(profile.schema(t))]
    assert names == t.raw.columns


def test_api_values_are_the_rounded_reports(tables):
    t = tables(*[{"fare_amount": 10.0 + i / 7, "tip_amount": i / 3} for i in range(9)])
    full, short = fares.breakdown(t).first(), fares.api_breakdown(t).first()
    assert short["base_fare"] == round(full["avg_base_fare"], 2)
    assert short["tip"] == round(full["avg_tip"], 2)
    full, short = tipping.by_payment_type(t).first(), tipping.api_by_payment_type(t).first()
    assert short["avg_tip_pct"] == round(full["avg_tip_pct"], 2)
    assert zones.api_top_pickup(t).first()["avg_fare"] == round(zones.top_pickup(t).first()["avg_fare"], 2)


LIMITED = [
    zones.top_pickup,
    zones.api_top_pickup,
    zones.api_top_dropoff,
    airport.api_top_origins,
    flows.api_top_routes,
    anomalies.api_high_fare_per_mile,
]


@pytest.mark.parametrize("report", LIMITED)
def test_limits(tables, report):
    t = tables({})
    short = report.__name__.startswith("api_")
    for bad in (0, -1, 2.5, "5", *([1001] if short else [])):
        with pytest.raises(ValueError):
            report(t, limit=bad)
    for good in (1, 1000, *([] if short else [5000])):
        assert report(t, limit=good).columns


def test_every_report_survives_an_empty_load(tables):
    t = tables({"fare_amount": 0.0})
    empty = []
    for name in catalog.REPORTS:
        rows = catalog.run(name, t).collect()
        empty.append(len(rows) == 0)
    assert t.summary_statistics.first()["total_trips"] == 0
    assert t.summary_statistics.first()["avg_fare"] is None
    assert quality.data_quality_report(t).first()["valid_fares"] == 0
    assert sum(empty) > 30


def test_unknown_report(tables):
    with pytest.raises(KeyError):
        catalog.run("no_such_report", tables({}))
