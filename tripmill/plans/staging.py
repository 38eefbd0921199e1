"""One shared set of derived tables per session and input folder."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import threading
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tripmill.config import Settings
from tripmill.functions.exact import total
from tripmill.operators import clean
from tripmill.plans import load
from tripmill.plans.tables import SavedTables, StagedTables, TripTables
from tripmill.sources import commerce, store
from tripmill.sources.trips import list_files, open_trips
from tripmill.streaming.incremental import load_new_files

# Key columns of each rollup; all others are measures.
ROLLUP_KEYS = {
    "mv_zone_pickup": ["location_id"],
    "mv_zone_dropoff": ["location_id"],
    "mv_hourly_demand": ["pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend"],
    "mv_od_flows": ["pu_location_id", "do_location_id"],
    "mv_vendor_performance": ["vendor_id"],
    "mv_payment_patterns": ["payment_type_id", "pickup_hour", "is_weekend"],
    "summary_statistics": ["metric_type"],
}

_lock = threading.RLock()
_known: dict[tuple, TripTables] = {}


def shared_folder(spark: SparkSession) -> str | None:
    """Folder for intermediate tables that every executor reaches.

    The cluster names it in ``spark.checkpoint.dir``. In local mode, where driver and
    executors are one process, a temporary folder does when nothing is named. None means
    that there is no such folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="run-trips-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        return folder
    return None


def _mark(spark: SparkSession, folder: str) -> str:
    """Changes when an input file is replaced: the tables' file lists, from Spark's file index.

    A table whose files are rewritten under the same names within one session is not noticed.
    """
    names = [f"{folder}/{name}.parquet" for name in commerce.CommerceTables.NAMES]
    return hashlib.md5("\n".join(list_files(spark, *names)).encode()).hexdigest()


def commerce_plans(
    spark: SparkSession, folder: str, settings: Settings
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Locations, raw trips and fact table over order tables, as plans."""
    source = commerce.CommerceTables.read(spark, folder)
    locations = commerce.locations(source)
    scoped = commerce.raw_trips(source, clean.home_ids(locations, settings.home))
    trips = scoped.filter(clean.is_plausible()).withColumn("source_period", commerce.year_of_file())
    fact = clean.build_fact(trips)
    return locations, commerce.raw_trips(source), fact


def commerce_tables(spark: SparkSession, folder: str, settings: Settings) -> TripTables:
    """Tables over order data, cleaned once per session and shared by all reports.

    The fact table keeps the few percent of lines that are trips within the home region.
    It is written on first use, each rollup likewise, so that reports after the first read
    those files instead of joining the four order tables again. Reports on raw trips keep
    working on the order tables themselves.
    """
    with _lock:
        key = (spark.sparkContext.applicationId, folder, settings, _mark(spark, folder))
        if key not in _known:
            locations, raw, fact = commerce_plans(spark, folder, settings)
            shared = shared_folder(spark)
            if shared is None:
                _known[key] = TripTables(spark, locations, raw, fact, settings)
            else:
                target = f"{shared}/trip-tables-{uuid.uuid4().hex}"
                _known[key] = StagedTables(spark, target, locations, raw, fact, settings)
        return _known[key]


def write_trip_files(raw: DataFrame, folder: str, *lots: str) -> None:
    """Raw trips as files, one folder per year, within one folder per value of the columns named.

    A task writes a file of every year it has trips of. Dealing the trips out by year first would send all of them, at
    their full width, through a second shuffle.
    """
    (
        raw.withColumn("trip_year", commerce.year_of_file())
        .drop("trip_id", "source_file")
        .write.partitionBy(*lots, "trip_year")
        .parquet(folder)
    )


def _work_folder(spark: SparkSession) -> str:
    shared = shared_folder(spark)
    if shared is None:
        raise ValueError("a load keeps its tables under spark.checkpoint.dir, which is not set")
    return f"{shared}/trip-load-{uuid.uuid4().hex}"


def _loaded(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    """What a load has stored, per period: trips, distinct ids and sums of the fact table, and the audit's counts."""
    tables = SavedTables(spark, path, settings=settings)
    fact = tables.fact_trip.groupBy("source_period").agg(
        F.count("*").alias("trips"),
        F.count_distinct("trip_id").alias("trip_ids"),
        total("fare_amount").alias("fares"),
        total("trip_distance").alias("miles"),
        F.sum("trip_duration_seconds").alias("seconds"),
    )
    year = F.regexp_extract("source_file", r"trip_year=(\d{4})", 1)
    audit = tables.load_audit.groupBy(year.alias("source_period")).agg(
        *[F.sum(c).alias(c) for c in ("original_trips", "loaded_trips", "filtered_trips")]
    )
    return audit.join(fact, "source_period", "left").orderBy("source_period")


def load_batch(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """Raw trip files written out and loaded from scratch; gives what the stored tables hold."""
    work = _work_folder(spark)
    source = commerce.CommerceTables.read(spark, folder)
    locations = store.stage(commerce.locations(source), work, "locations")
    write_trip_files(commerce.raw_trips(source), f"{work}/raw")
    load.load(spark, open_trips(spark, f"{work}/raw"), locations, f"{work}/tables", settings)
    return _loaded(spark, f"{work}/tables", settings)


def _two_lots(spark: SparkSession, folder: str, settings: Settings) -> str:
    """Trip files arriving in two lots, each picked up by the incremental load, the second by a new stream.

    The order tables are joined once, for both lots. The first stream sees the folder of the first lot, the second one
    both folders. Gives the folder of the tables.
    """
    work = _work_folder(spark)
    source = commerce.CommerceTables.read(spark, folder)
    locations = store.stage(commerce.locations(source), work, "locations")
    late = F.coalesce(F.col("source_file") >= "trips-1998", F.lit(False))
    write_trip_files(commerce.raw_trips(source).withColumn("lot", late.cast("int")), f"{work}/raw", "lot")
    for turn, seen in enumerate((f"{work}/raw/lot=0", f"{work}/raw")):
        query = load_new_files(spark, seen, locations, f"{work}/tables", f"{work}/checkpoint-{turn}", settings)
        query.awaitTermination()
    return f"{work}/tables"


def incremental_load(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """What the stored tables hold after two lots of trip files have arrived."""
    return _loaded(spark, _two_lots(spark, folder, settings), settings)


def incremental_rollups(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """All rollups merged from the states of two lots of trip files, a row per key and measure."""
    path = _two_lots(spark, folder, settings)
    load.merge_rollups(spark, path, settings)
    tables = SavedTables(spark, path, settings=settings)
    parts = []
    for name, keys in ROLLUP_KEYS.items():
        rollup = getattr(tables, name)
        values = [
            F.struct(F.lit(field.name).alias("measure"), _number(field).alias("value"))
            for field in rollup.schema
            if field.name not in keys
        ]
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        parts.append(rollup.select(F.lit(name).alias("rollup"), key.alias("key"), F.explode(F.array(*values)).alias("of")))
    return reduce(DataFrame.unionByName, parts).select("rollup", "key", "of.measure", "of.value")


def _number(field: StructField) -> Column:
    if field.dataType.typeName() == "timestamp_ntz":
        return F.unix_micros(F.col(field.name).cast("timestamp")).cast("double")
    return F.col(field.name).cast("double")
