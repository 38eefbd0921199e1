"""Column types of the raw trips, the dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(fields: dict[str, object], required: set[str] = frozenset()) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in fields.items()])


# Column names of the published trip files.
RAW_TRIPS = _struct(
    {
        "VendorID": IntegerType(),
        "PULocationID": IntegerType(),
        "DOLocationID": IntegerType(),
        "payment_type": IntegerType(),
        "RatecodeID": IntegerType(),
        "tpep_pickup_datetime": TimestampNTZType(),
        "tpep_dropoff_datetime": TimestampNTZType(),
        "passenger_count": DoubleType(),
        "trip_distance": DoubleType(),
        "fare_amount": DoubleType(),
        "extra": DoubleType(),
        "mta_tax": DoubleType(),
        "tip_amount": DoubleType(),
        "tolls_amount": DoubleType(),
        "improvement_surcharge": DoubleType(),
        "total_amount": DoubleType(),
        "congestion_surcharge": DoubleType(),
        "airport_fee": DoubleType(),
        "store_and_fwd_flag": StringType(),
    }
)

# Columns that identify a raw row: the file it came from and its place there.
RAW_ORIGIN = _struct({"source_file": StringType(), "source_row": LongType()})

# One row per source file of a load; ``file_no`` is null for a file of which nothing was loaded.
LOAD_AUDIT = _struct(
    {
        "source_file": StringType(),
        "original_trips": LongType(),
        "loaded_trips": LongType(),
        "status": StringType(),
        "filtered_trips": LongType(),
        "filtered_pct": DoubleType(),
        "file_no": LongType(),
        "source_period": StringType(),
        "load_batch": StringType(),
    }
)

ZONE_LOOKUP = _struct(
    {
        "LocationID": IntegerType(),
        "Borough": StringType(),
        "Zone": StringType(),
        "service_zone": StringType(),
    }
)

DIM_LOCATION = _struct(
    {
        "location_id": IntegerType(),
        "borough": StringType(),
        "zone": StringType(),
        "service_zone": StringType(),
    },
    {"location_id", "borough", "zone"},
)
DIM_VENDOR = _struct(
    {"vendor_id": IntegerType(), "vendor_name": StringType(), "vendor_short_name": StringType()},
    {"vendor_id", "vendor_name", "vendor_short_name"},
)
DIM_PAYMENT_TYPE = _struct(
    {
        "payment_type_id": IntegerType(),
        "payment_type_name": StringType(),
        "is_card_payment": BooleanType(),
        "allows_tip": BooleanType(),
    },
    {"payment_type_id", "payment_type_name", "is_card_payment", "allows_tip"},
)
DIM_RATE_CODE = _struct(
    {
        "rate_code_id": IntegerType(),
        "rate_code_name": StringType(),
        "is_airport": BooleanType(),
        "is_standard": BooleanType(),
    },
    {"rate_code_id", "rate_code_name", "is_airport", "is_standard"},
)

# Fact columns in table order, then the three derived ratios used by the reports.
FACT_TRIP = _struct(
    {
        "trip_id": LongType(),
        "vendor_id": IntegerType(),
        "pu_location_id": IntegerType(),
        "do_location_id": IntegerType(),
        "payment_type_id": IntegerType(),
        "rate_code_id": IntegerType(),
        "pickup_datetime": TimestampNTZType(),
        "dropoff_datetime": TimestampNTZType(),
        "pickup_date": DateType(),
        "pickup_hour": IntegerType(),
        "pickup_day_of_week": IntegerType(),
        "is_weekend": BooleanType(),
        "passenger_count": IntegerType(),
        "trip_distance": DoubleType(),
        "trip_duration_seconds": IntegerType(),
        "fare_amount": DoubleType(),
        "extra": DoubleType(),
        "mta_tax": DoubleType(),
        "tip_amount": DoubleType(),
        "tolls_amount": DoubleType(),
        "improvement_surcharge": DoubleType(),
        "total_amount": DoubleType(),
        "congestion_surcharge": DoubleType(),
        "airport_fee": DoubleType(),
        "cbd_congestion_fee": DoubleType(),
        "store_and_fwd_flag": StringType(),
        "tip_percentage": DoubleType(),
        "fare_per_mile": DoubleType(),
        "avg_speed_mph": DoubleType(),
    },
    {
        "trip_id",
        "vendor_id",
        "pu_location_id",
        "do_location_id",
        "payment_type_id",
        "rate_code_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_date",
        "pickup_hour",
        "pickup_day_of_week",
        "is_weekend",
        "trip_distance",
        "trip_duration_seconds",
        "fare_amount",
        "total_amount",
    },
)

# Columns of the fact table that may not be null, and the keys that must be unique.
REQUIRED = {
    "dim_location": [f.name for f in DIM_LOCATION if not f.nullable],
    "dim_vendor": [f.name for f in DIM_VENDOR if not f.nullable],
    "dim_payment_type": [f.name for f in DIM_PAYMENT_TYPE if not f.nullable],
    "dim_rate_code": [f.name for f in DIM_RATE_CODE if not f.nullable],
    "fact_trip": [f.name for f in FACT_TRIP if not f.nullable],
}
PRIMARY_KEY = {
    "dim_location": "location_id",
    "dim_vendor": "vendor_id",
    "dim_payment_type": "payment_type_id",
    "dim_rate_code": "rate_code_id",
    "fact_trip": "trip_id",
}
