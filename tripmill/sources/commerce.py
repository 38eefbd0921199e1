"""Trips projected from order tables, for running the reports on commerce data.

A line item becomes a trip from the supplier's nation to the customer's nation. Nations
are the zones and regions the boroughs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Region used as the home borough when reporting on these tables.
HOME_REGION = "AMERICA"


@dataclass(frozen=True)
class CommerceTables:
    region: DataFrame
    nation: DataFrame
    supplier: DataFrame
    customer: DataFrame
    orders: DataFrame
    lineitem: DataFrame

    # Names of the tables read, in the order of the fields above.
    NAMES = ("region", "nation", "supplier", "customer", "orders", "lineitem")

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> CommerceTables:
        return cls(*[spark.read.parquet(f"{folder}/{name}.parquet") for name in cls.NAMES])


def locations(t: CommerceTables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("Unknown").alias("service_zone"),
    )


def year_of_file() -> Column:
    """The year in ``trips-1998.parquet``."""
    return F.substring("source_file", 7, 4)


def _span(count: Column, unit: str) -> Column:
    """So many hours, minutes or seconds, in whole numbers; ``make_dt_interval`` goes by decimals."""
    return count * F.expr(f"INTERVAL '1' {unit}")


def raw_trips(t: CommerceTables, scope: DataFrame | None = None) -> DataFrame:
    """Raw trips, one per line item.

    ``scope`` keeps only trips between the given locations (a ``location_id`` column). It
    is applied to suppliers and customers, before the large join: lines and orders are
    narrowed on their own side first, and only what is left of both meets on the order key.
    Catalyst broadcasts suppliers or customers while they are small enough and otherwise
    sorts and merges, where AQE splits a hot key.
    """
    supplier = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("PULocationID"))
    customer = t.customer.select("c_custkey", F.col("c_nationkey").alias("DOLocationID"))
    if scope is not None:
        ids = scope.select("location_id")
        supplier = supplier.join(ids, F.col("PULocationID") == F.col("location_id"), "left_semi")
        customer = customer.join(ids, F.col("DOLocationID") == F.col("location_id"), "left_semi")

    lines = t.lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    price = F.col("l_extendedprice")
    cents = F.floor(price / 2) / F.lit(100.0)
    pickup = F.col("o_orderdate") + _span(part % 24, "HOUR") + _span(supp % 60, "MINUTE")
    timed = joined.withColumn("tpep_pickup_datetime", pickup)
    priced = timed.select(
        # Lines may share order and line number, hence the low bits from part and supplier.
        # Fits a bigint up to order keys of 10^12.
        (
            (F.col("l_orderkey") * 8 + line) * F.lit(1_048_576)
            + (part * 7919 + supp * 104_729) % F.lit(1_048_576)
        ).alias("trip_id"),
        F.when(supp % 10 == 0, 6)
        .when(supp % 10 == 1, 7)
        .when(supp % 10 < 5, 1)
        .otherwise(2)
        .alias("VendorID"),
        "PULocationID",
        "DOLocationID",
        (part % 6).cast("int").alias("payment_type"),
        F.when(part % 20 < 5, (part % 20 + 2).cast("int"))
        .when(part % 20 == 5, 99)
        .otherwise(1)
        .alias("RatecodeID"),
        "tpep_pickup_datetime",
        (F.col("tpep_pickup_datetime") + _span((part * 37 + line * 211) % 7500 - 100, "SECOND")).alias(
            "tpep_dropoff_datetime"
        ),
        F.when(part % 97 != 0, (line - 1).cast("double")).alias("passenger_count"),
        F.when(part % 211 == 0, F.lit(250.0))
        .otherwise((F.col("l_quantity") - 1) * F.lit(0.25) + (part % 100) * F.lit(0.01))
        .alias("trip_distance"),
        F.when(part % 53 == 0, -cents)
        .when(part % 31 == 0, F.lit(10.0) * (1 + line % 5))
        .otherwise(cents)
        .alias("fare_amount"),
        ((line % 3) * F.lit(0.5)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.when(part % 6 == 1, F.floor(price * F.col("l_discount") * 2) / F.lit(100.0))
        .otherwise(F.lit(0.0))
        .alias("tip_amount"),
        F.when(F.col("l_tax") >= 0.07, F.lit(6.94)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when(F.col("l_returnflag") == "N", F.lit(2.5)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        F.when((part % 20).isin(0, 6), F.lit(1.75)).otherwise(F.lit(0.0)).alias("airport_fee"),
        F.when((F.col("l_linestatus") == "F") & (part % 50 == 0), "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.concat(F.lit("trips-"), F.year("o_orderdate").cast("string"), F.lit(".parquet")).alias("source_file"),
    )
    charges = [
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "airport_fee",
    ]
    total = F.col(charges[0])
    for charge in charges[1:]:
        total = total + F.col(charge)
    return priced.withColumn("total_amount", total)
