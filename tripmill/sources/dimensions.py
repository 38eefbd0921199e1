"""The three dimensions with fixed content, and the zone dimension read from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill import schema

# The rows of the inline dimensions.
VENDORS = [
    (1, "Creative Mobile Technologies", "CMT"),
    (2, "VeriFone Inc.", "VTS"),
    (6, "Other", "Other"),
    (7, "Other", "Other"),
]
PAYMENT_TYPES = [
    (0, "Unknown", False, False),
    (1, "Credit card", True, True),
    (2, "Cash", False, False),
    (3, "No charge", False, False),
    (4, "Dispute", False, False),
    (5, "Unknown", False, False),
]
RATE_CODES = [
    (1, "Standard rate", False, True),
    (2, "JFK", True, False),
    (3, "Newark", True, False),
    (4, "Nassau or Westchester", False, False),
    (5, "Negotiated fare", False, False),
    (6, "Group ride", False, False),
    (99, "Other", False, False),
]
# Fields a CSV reader in pandas takes as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _inline(spark: SparkSession, rows: list[tuple], struct: StructType) -> DataFrame:
    """Rows written as VALUES, which Catalyst keeps as a local relation of known size."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(struct.names)
    return spark.sql(f"SELECT * FROM VALUES {values} AS dim({names})")


def vendors(spark: SparkSession) -> DataFrame:
    return _inline(spark, VENDORS, schema.DIM_VENDOR)


def payment_types(spark: SparkSession) -> DataFrame:
    return _inline(spark, PAYMENT_TYPES, schema.DIM_PAYMENT_TYPE)


def rate_codes(spark: SparkSession) -> DataFrame:
    return _inline(spark, RATE_CODES, schema.DIM_RATE_CODE)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The zone CSV as published; ``N/A``, empty and similar fields are NULL."""
    csv = spark.read.csv(path, header=True, schema=schema.ZONE_LOOKUP, nullValue="N/A")
    text = [f.name for f in schema.ZONE_LOOKUP if f.dataType.simpleString() == "string"]
    return csv.withColumns({c: F.when(~F.col(c).isin(MISSING), F.col(c)) for c in text})


def clean_zones(lookup: DataFrame) -> DataFrame:
    """Lower-case names, drop zones without id, borough or name, fill the service zone."""
    named = lookup.toDF(*[c.lower() for c in lookup.columns])
    if "locationid" in named.columns:
        named = named.withColumnRenamed("locationid", "location_id")
    return (
        named.na.drop(subset=["location_id", "borough", "zone"])
        .na.fill("Unknown", subset=["service_zone"])
        .select(*schema.DIM_LOCATION.names)
    )


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return clean_zones(read_zone_lookup(spark, path))
