from __future__ import annotations

import datetime as dt

import pytest
from conftest import PLAIN, dicts

from tripmill import schema
from tripmill.operators import clean, quality
from tripmill.sources import dimensions, trips

START = PLAIN["tpep_pickup_datetime"]


def after(**span) -> dict:
    return {"tpep_dropoff_datetime": START + dt.timedelta(**span)}


@pytest.mark.parametrize(
    ("column", "kept", "dropped"),
    [
        ("fare_amount", [0.01, 499.99], [0.0, -1.0, 500.0, None]),
        ("trip_distance", [0.01, 199.99], [0.0, 200.0, None]),
        ("passenger_count", [1.0, 6.0], [0.0, 7.0, None]),
    ],
)
def test_filter_bounds(tables, column, kept, dropped):
    t = tables(*[{column: v} for v in kept + dropped])
    assert sorted(r[column] for r in dicts(t.fact_trip)) == kept


def test_elapsed_time_bounds(tables):
    t = tables(after(seconds=7199), after(seconds=7200), after(seconds=0), after(seconds=-5), after(seconds=1))
    assert sorted(r["trip_duration_seconds"] for r in dicts(t.fact_trip)) == [1, 7199]


def test_only_trips_within_home(tables):
    t = tables({}, {"PULocationID": 9}, {"DOLocationID": 9}, {"PULocationID": None}, {"DOLocationID": 777})
    assert t.fact_trip.count() == 1


def test_duration_rounds_half_to_even(tables):
    t = tables(after(milliseconds=500), after(milliseconds=1500), after(milliseconds=2500), after(milliseconds=2700))
    found = {r["dropoff_datetime"]: r["trip_duration_seconds"] for r in dicts(t.fact_trip)}
    assert [found[k] for k in sorted(found)] == [0, 2, 2, 3]
    stopped = t.fact_trip.filter("trip_duration_seconds = 0").first()
    assert stopped["avg_speed_mph"] is None


def test_duration_ignores_clock_changes(tables):
    night = {
        "tpep_pickup_datetime": dt.datetime(2025, 3, 9, 1, 30),
        "tpep_dropoff_datetime": dt.datetime(2025, 3, 9, 3, 0),
    }
    assert tables(night).fact_trip.first()["trip_duration_seconds"] == 5400


def test_calendar_columns(tables):
    days = [dt.datetime(2025, 1, 4, 23, 5), dt.datetime(2025, 1, 5, 0, 0), dt.datetime(2025, 1, 6, 12, 0)]
    rows = [
        {"tpep_pickup_datetime": d, "tpep_dropoff_datetime": d + dt.timedelta(minutes=9)} for d in days
    ]
    found = sorted(dicts(tables(*rows).fact_trip), key=lambda r: r["pickup_datetime"])
    assert [r["pickup_day_of_week"] for r in found] == [6, 0, 1]
    assert [r["is_weekend"] for r in found] == [True, True, False]
    assert [r["pickup_hour"] for r in found] == [23, 0, 12]
    assert [r["pickup_date"] for r in found] == [d.date() for d in days]


def test_derived_ratios(tables):
    row = tables({"tip_amount": 2.5, **after(minutes=15)}).fact_trip.first()
    assert row["tip_percentage"] == 25.0
    assert row["fare_per_mile"] == 5.0
    assert row["avg_speed_mph"] == 8.0
    assert row["cbd_congestion_fee"] == 0.0


def test_fact_columns_and_period(tables):
    fact = tables({}).fact_trip
    assert fact.columns[:26] == schema.FACT_TRIP.names[:26]
    assert [f.dataType for f in fact.schema][: len(schema.FACT_TRIP)] == [f.dataType for f in schema.FACT_TRIP]
    assert fact.first()["source_period"] == "2025-01"


@pytest.mark.parametrize(
    ("path", "period"),
    [
        ("yellow_tripdata_2025-03.parquet", "2025-03"),
        ("/in/2024-backup/yellow_2025-03.parquet", "2025-03"),
        ("/in/trip_year=1997/part-00000-ab.parquet", "1997"),
        ("/in/part-00000.parquet", "unknown"),
    ],
)
def test_period_from_path(tables, path, period):
    assert tables({"source_file": path}).fact_trip.first()["source_period"] == period


def test_incomplete_trip_rejects_its_whole_file(tables):
    t = tables(
        {"source_file": "good"},
        {"source_file": "good", "RatecodeID": None, "fare_amount": 0.0},
        {"source_file": "bad"},
        {"source_file": "bad", "RatecodeID": None},
        {"source_file": "none", "passenger_count": None},
    )
    audit = {r["source_file"]: r for r in dicts(t.load_audit)}
    assert (audit["good"]["original_trips"], audit["good"]["loaded_trips"]) == (2, 1)
    assert audit["good"]["filtered_pct"] == 50.0
    assert (audit["bad"]["status"], audit["bad"]["loaded_trips"]) == ("rejected", 0)
    assert audit["bad"]["filtered_trips"] is None
    assert audit["none"]["filtered_trips"] == 1
    assert {r["source_file"] for r in dicts(t.fact_trip)} == {"good"}
    totals = clean.audit_totals(t.load_audit).first()
    assert (totals["loaded_trips"], totals["filtered_trips"]) == (1, 2)
    assert totals["filter_rate_pct"] == pytest.approx(200 / 3)


def test_trip_ids_are_unique_and_repeatable(tables):
    rows = [{"source_file": f"f{i % 3}"} for i in range(30)]
    first = sorted(r["trip_id"] for r in dicts(tables(*rows).fact_trip))
    again = sorted(r["trip_id"] for r in dicts(tables(*rows).fact_trip.repartition(7)))
    assert len(set(first)) == 30
    assert first == again


def test_contract_violations(tables):
    t = tables({}, {})
    found = {(r["table_name"], r["rule"]): r["violations"] for r in dicts(quality.contract_violations(t))}
    assert set(found.values()) == {0}
    assert len(found) == 10


def test_contract_violations_are_found(tables, spark, locations):
    t = tables({})
    t.dim_location = locations.union(locations.limit(2))
    found = {(r["table_name"], r["rule"]): r["violations"] for r in dicts(quality.contract_violations(t))}
    assert found["dim_location", "primary key"] == 2


def test_zone_lookup(spark, tmp_path):
    lookup = tmp_path / "zones.csv"
    lookup.write_text(
        '"LocationID","Borough","Zone","service_zone"\n'
        '1,"EWR","Some Airport","EWR"\n'
        '2,"Queens","Quiet, Corner",""\n'
        '264,"Unknown","N/A","N/A"\n'
        '265,"N/A","Outside","N/A"\n'
        '7,"Bronx","Far End","N/A"\n'
    )
    found = {r["location_id"]: r for r in dicts(dimensions.read_locations(spark, str(lookup)))}
    assert sorted(found) == [1, 2, 7]
    assert found[2]["zone"] == "Quiet, Corner"
    assert found[2]["service_zone"] == found[7]["service_zone"] == "Unknown"


def test_inline_dimensions(spark):
    assert dimensions.vendors(spark).count() == 4
    assert dimensions.payment_types(spark).filter("allows_tip").count() == 1
    codes = {r["rate_code_id"]: r for r in dicts(dimensions.rate_codes(spark))}
    assert [c for c in codes if codes[c]["is_airport"]] == [2, 3]
    assert [c for c in codes if codes[c]["is_standard"]] == [1]


def test_conform_brings_file_variants_together(spark):
    old = spark.sql(
        "SELECT 1L AS vendorid, 7L AS pulocationid, CAST(2.5 AS DOUBLE) AS ratecodeid, "
        "3L AS passenger_count, CAST(1.25 AS DOUBLE) AS Airport_fee"
    )
    new = trips.conform(old)
    assert new.schema.simpleString() == schema.RAW_TRIPS.simpleString()
    row = new.first()
    assert (row["VendorID"], row["PULocationID"], row["RatecodeID"]) == (1, 7, 2)
    assert (row["passenger_count"], row["airport_fee"], row["tip_amount"]) == (3.0, 1.25, None)
