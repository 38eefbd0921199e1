from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill import Settings, TripTables  # noqa: E402
from tripmill import schema  # noqa: E402
from tripmill.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"

# Zones for small fixtures: A, B and C are at home, two ids share the name "C".
ZONES = [
    (1, "Home", "A", "Yellow"),
    (2, "Home", "B", "Yellow"),
    (3, "Home", "C", "Yellow"),
    (4, "Home", "C", "Yellow"),
    (5, "Home", "Idle", "Yellow"),
    (9, "Away", "Z", "Boro"),
]

PLAIN = {
    "VendorID": 1,
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "RatecodeID": 1,
    "tpep_pickup_datetime": dt.datetime(2025, 1, 6, 8, 0),
    "tpep_dropoff_datetime": dt.datetime(2025, 1, 6, 8, 10),
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 12.0,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
    "store_and_fwd_flag": "N",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.sql.debug.maxToStringFields": "200",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def locations(spark):
    return spark.createDataFrame(ZONES, "location_id int, borough string, zone string, service_zone string")


@pytest.fixture(scope="session")
def raw_trips(spark):
    """Raw trips from overrides of a plain one, all in one source file unless given."""

    def make(*rows: dict, file: str = "trips_2025-01.parquet"):
        names = schema.RAW_TRIPS.names
        values = [
            (*[{**PLAIN, **row}[n] for n in names], row.get("source_file", file), i) for i, row in enumerate(rows)
        ]
        layout = schema.RAW_TRIPS
        for field in schema.RAW_ORIGIN:
            layout = type(layout)([*layout.fields, field])
        return spark.createDataFrame(values, layout)

    return make


@pytest.fixture(scope="session")
def tables(spark, locations, raw_trips):
    def make(*rows: dict, **settings) -> TripTables:
        options = {"home": "Home", "min_od_trips": 1, "min_pair_trips": 1, "min_airport_trips": 1, **settings}
        return TripTables(spark, locations, raw_trips(*rows), settings=Settings(**options))

    return make


def dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]
