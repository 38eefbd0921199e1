"""From raw trips to the fact table: scope, quality filter, derived columns, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill import schema
from tripmill.functions.exact import count_where, percent

# Raw columns that must be present in every trip that passes the filters. The filters
# themselves already rule out a missing location, time, fare or distance.
_REQUIRED_RAW = ["VendorID", "payment_type", "RatecodeID", "total_amount"]
# Amounts that are no numbers would spoil every sum they enter.
_AMOUNTS = [
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]
_FINITE = " AND ".join(f"coalesce(abs({name}) < double('infinity'), true)" for name in _AMOUNTS)
# A trip id is the file's number followed by the row's position in the file.
_ROW_BITS = 40
# Files up to this many are broadcast, by hashes of their paths: 40 MB at most.
MOST_FILES = 1_000_000
# Year or year-month standing by itself in a file or folder name.
_PERIOD = r"(?<![0-9A-Za-z])((?:19|20)\d{2}(?:-(?:0[1-9]|1[0-2]))?)(?![0-9A-Za-z])"


def home_ids(locations: DataFrame, home: str) -> DataFrame:
    return locations.filter(F.col("borough") == home).select("location_id")


def is_plausible() -> Column:
    """The quality filter; NULL counts as failed.

    Comparisons with literals are pushed into the Parquet scan; the elapsed time, which
    compares two columns, is checked after it.
    """
    elapsed = F.col("tpep_dropoff_datetime") - F.col("tpep_pickup_datetime")
    return (
        (F.col("fare_amount") > 0.0)
        & (F.col("fare_amount") < 500.0)
        & (F.col("trip_distance") > 0.0)
        & (F.col("trip_distance") < 200.0)
        & F.col("passenger_count").between(1.0, 6.0)
        & (F.col("tpep_pickup_datetime") < F.col("tpep_dropoff_datetime"))
        & (elapsed < F.expr("INTERVAL '7200' SECOND"))
        & F.expr(_FINITE)
    )


def is_incomplete() -> Column:
    """A required column is missing."""
    test = F.col(_REQUIRED_RAW[0]).isNull()
    for name in _REQUIRED_RAW[1:]:
        test = test | F.col(name).isNull()
    return test


def in_scope(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Trips that start and end in the given locations."""
    for end in ("PULocationID", "DOLocationID"):
        raw = raw.join(ids, F.col(end) == F.col("location_id"), "left_semi")
    return raw


def clean_trips(raw: DataFrame, ids: DataFrame) -> DataFrame:
    return in_scope(raw.filter(is_plausible()), ids)


def with_home_ends(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Flags ``home_pickup`` and ``home_dropoff``, keeping every raw trip."""
    for end, flag in (("PULocationID", "home_pickup"), ("DOLocationID", "home_dropoff")):
        marked = ids.distinct().select(F.col("location_id").alias("_id"), F.lit(True).alias("_hit"))
        raw = (
            raw.join(marked, F.col(end) == F.col("_id"), "left")
            .withColumn(flag, F.coalesce("_hit", F.lit(False)))
            .drop("_id", "_hit")
        )
    return raw


def load_audit(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Per source file: trips found, loaded and filtered, in one pass over the raw data.

    A file is rejected as a whole when a trip that passes the filters lacks a required
    value; nothing of it is loaded and it takes no part in the totals.
    """
    valid = is_plausible() & F.col("home_pickup") & F.col("home_dropoff")
    counted = (
        with_home_ends(raw, ids)
        .groupBy("source_file")
        .agg(
            F.count("*").alias("original_trips"),
            count_where(valid).alias("_valid"),
            count_where(valid & is_incomplete()).alias("_incomplete"),
        )
    )
    return _audit(counted, F.col("_incomplete") == 0)


def with_file_ends(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Trips of the listed files, flagged ``is_file_end`` where a trip is the last one of a row group.

    The list has a row of a few dozen bytes per file and is broadcast up to ``MOST_FILES`` files and ten times as many
    row groups. Beyond, the join is a shuffle by path.
    """
    known = files.select(path_key().alias("_path"), "ends")
    size = files.agg(F.count("*"), F.sum(F.size("ends"))).first()
    if size[0] <= MOST_FILES and (size[1] or 0) <= 10 * MOST_FILES:
        known = F.broadcast(known)
    marked = raw.join(known, path_key() == F.col("_path")).drop("_path")
    return marked.withColumn("is_file_end", F.array_contains("ends", F.col("source_row"))).drop("ends")


def candidates(raw: DataFrame, files: DataFrame, ids: DataFrame) -> DataFrame:
    """Raw columns and ``is_valid`` of the trips that pass the filters and of the last trip of every row group."""
    marked = with_home_ends(with_file_ends(raw, files), ids)
    valid = F.coalesce(is_plausible() & F.col("home_pickup") & F.col("home_dropoff"), F.lit(False))
    kept = marked.withColumn("is_valid", valid).filter(F.col("is_valid") | F.col("is_file_end"))
    return kept.drop("home_pickup", "home_dropoff")


def audit_candidates(files: DataFrame, found: DataFrame) -> DataFrame:
    """The load audit from listed files and the staged candidates of one scan over them.

    A file is rejected as a whole when a trip that passes the filters lacks a required value, or when the
    last trip of one of its row groups was not seen, as then the file is torn.
    """
    counted = found.groupBy("source_file").agg(
        count_where(F.col("is_valid")).alias("_valid"),
        count_where(F.col("is_valid") & is_incomplete()).alias("_incomplete"),
        count_where(F.col("is_file_end")).alias("_ends"),
    )
    seen = files.join(counted, "source_file", "left").na.fill(0, ["_valid", "_incomplete", "_ends"])
    sound = (F.col("_incomplete") == 0) & (F.col("_ends") == F.size("ends"))
    return _audit(seen.withColumnRenamed("rows", "original_trips"), sound)


def _audit(counted: DataFrame, sound: Column) -> DataFrame:
    result = counted.select(
        "source_file",
        "original_trips",
        F.when(sound, F.col("_valid")).otherwise(F.lit(0)).alias("loaded_trips"),
        F.when(sound, F.lit("loaded")).otherwise(F.lit("rejected")).alias("status"),
    )
    filtered = F.when(F.col("status") == "loaded", F.col("original_trips") - F.col("loaded_trips"))
    return result.withColumn("filtered_trips", filtered).withColumn(
        "filtered_pct", percent(F.col("filtered_trips"), F.col("original_trips"))
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """Trips loaded and filtered over all loaded files, and the overall filter rate."""
    sums = audit.filter(F.col("status") == "loaded").agg(
        F.coalesce(F.sum("loaded_trips"), F.lit(0)).alias("loaded_trips"),
        F.coalesce(F.sum("filtered_trips"), F.lit(0)).alias("filtered_trips"),
    )
    whole = F.col("loaded_trips") + F.col("filtered_trips")
    return sums.withColumn("filter_rate_pct", percent(F.col("filtered_trips"), whole))


def number_files(audit: DataFrame, first: int = 0) -> DataFrame:
    """Number the loaded files in name order and read the period off their names.

    The audit has one small row per file, so this costs nothing per trip.
    """
    order = Window.orderBy("source_file")
    name = F.substring_index("source_file", "/", -1)
    found = [F.nullif(F.regexp_extract(text, _PERIOD, 1), F.lit("")) for text in (name, "source_file")]
    return audit.filter(F.col("status") == "loaded").select(
        "source_file",
        (F.row_number().over(order) + F.lit(first - 1)).cast("bigint").alias("file_no"),
        F.coalesce(*found, F.lit("unknown")).alias("source_period"),
    )


def path_key(name: str = "source_file") -> Column:
    return F.xxhash64(name)


def accepted(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the numbered files with their period; rows of rejected files drop out.

    Trips without an id of their own get the number of their file and their row in it. Files are
    looked up by the hash of their path: a row of some 40 bytes each, which is broadcast up to
    ``MOST_FILES``, so that trips are not shuffled by their path. The audit has made sure that no
    two paths share a hash.
    """
    known = files.select(path_key().alias("_path"), "file_no", "source_period")
    if files.count() <= MOST_FILES:
        known = F.broadcast(known)
    trips = raw.join(known, path_key() == F.col("_path")).drop("_path")
    if "trip_id" not in raw.columns:
        trips = trips.withColumn("trip_id", F.shiftleft("file_no", _ROW_BITS) + F.col("source_row"))
    return trips


def without_files(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files other than those of ``files``, by the hash of their path."""
    known = files.select(path_key().alias("_path")).distinct()
    if files.count() <= MOST_FILES:
        known = F.broadcast(known)
    return raw.join(known, path_key() == F.col("_path"), "left_anti")


def month_of(day: Column) -> Column:
    """``2025-01``; months compare as text like the days in them."""
    return F.substring(day.cast("string"), 1, 7)


def elapsed_seconds() -> Column:
    """Whole seconds between pickup and dropoff, halves to even, free of any time zone."""
    span = F.col("tpep_dropoff_datetime") - F.col("tpep_pickup_datetime")
    seconds = span.cast("interval second").cast("decimal(18,6)").cast("double")
    return F.rint(seconds).cast("int")


def build_fact(trips: DataFrame) -> DataFrame:
    """Project clean trips, with ``trip_id`` and ``source_period``, onto the fact columns.

    The month of the pickup is carried along as the partition column of the stored table, the period
    (year or year-month, from the file's name or else its folder) for the record.
    """
    pickup = F.col("tpep_pickup_datetime")
    weekday = F.dayofweek(pickup) - 1  # Sunday is 0
    fare, miles, tip = F.col("fare_amount"), F.col("trip_distance"), F.col("tip_amount")
    hours = F.col("trip_duration_seconds") / F.lit(3600.0)
    # 0 unless the raw trips were opened with the fee, and in files that have none.
    known = "cbd_congestion_fee" in trips.columns
    cbd_fee = F.coalesce("cbd_congestion_fee", F.lit(0.0)) if known else F.lit(0.0)
    plain = trips.select(
        "trip_id",
        F.col("VendorID").alias("vendor_id"),
        F.col("PULocationID").alias("pu_location_id"),
        F.col("DOLocationID").alias("do_location_id"),
        F.col("payment_type").alias("payment_type_id"),
        F.col("RatecodeID").alias("rate_code_id"),
        pickup.alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.to_date(pickup).alias("pickup_date"),
        F.hour(pickup).alias("pickup_hour"),
        weekday.alias("pickup_day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.rint("passenger_count").cast("int").alias("passenger_count"),
        "trip_distance",
        elapsed_seconds().alias("trip_duration_seconds"),
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        "airport_fee",
        cbd_fee.alias("cbd_congestion_fee"),
        "store_and_fwd_flag",
        "source_file",
        "source_period",
    )
    moving = (miles > 0) & (F.col("trip_duration_seconds") > 0)
    derived = plain.withColumns(
        {
            "tip_percentage": F.try_divide(tip, fare) * F.lit(100.0),
            "fare_per_mile": F.try_divide(fare, miles),
            "avg_speed_mph": F.when(moving, miles / hours),
        }
    )
    month = month_of(F.col("pickup_date")).alias("pickup_month")
    return derived.select(*schema.FACT_TRIP.names, "source_file", "source_period", month)
