"""The star tables and rollups a query may use."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.config import Settings
from tripmill.operators import clean, quantiles, rollups, sketches
from tripmill.sources import dimensions, store

DIMENSIONS = ["dim_location", "dim_vendor", "dim_payment_type", "dim_rate_code"]
ROLLUPS = [
    "mv_zone_pickup",
    "mv_zone_dropoff",
    "mv_hourly_demand",
    "mv_od_flows",
    "mv_vendor_performance",
    "mv_payment_patterns",
]
SKETCHES = ["value_sketches", "payment_sketches"]
# Order in which the load reports its tables.
REPORTED = ["fact_trip", *DIMENSIONS, *ROLLUPS]


class TripTables:
    """Tables derived from raw trips and zones; every attribute is a lazy plan.

    ``fact`` may be given when it is already built or stored.
    """

    def __init__(
        self,
        spark: SparkSession,
        locations: DataFrame,
        raw: DataFrame | None = None,
        fact: DataFrame | None = None,
        settings: Settings | None = None,
    ) -> None:
        if raw is None and fact is None:
            raise ValueError("raw trips or a fact table are needed")
        self.spark = spark
        self.settings = settings or Settings()
        self.dim_location = locations
        # The zone lookup as it is, incomplete zones included, where it is at hand.
        self.zone_lookup = locations
        self._raw = raw
        self._fact = fact

    @property
    def raw(self) -> DataFrame:
        if self._raw is None:
            raise ValueError("these tables were opened without raw trips")
        return self._raw

    @cached_property
    def home_ids(self) -> DataFrame:
        return clean.home_ids(self.dim_location, self.settings.home)

    def _provide(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Where a named table comes from; here it is simply the plan that builds it."""
        return build()

    @cached_property
    def load_audit(self) -> DataFrame:
        return self._provide("load_audit", lambda: clean.load_audit(self.raw, self.home_ids))

    @cached_property
    def fact_trip(self) -> DataFrame:
        return self._provide("fact_trip", self._build_fact)

    def _build_fact(self) -> DataFrame:
        if self._fact is not None:
            return self._fact
        files = clean.number_files(self.load_audit)
        return clean.build_fact(clean.accepted(clean.clean_trips(self.raw, self.home_ids), files))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return dimensions.vendors(self.spark)

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return dimensions.payment_types(self.spark)

    @cached_property
    def dim_rate_code(self) -> DataFrame:
        return dimensions.rate_codes(self.spark)

    @cached_property
    def route_fares(self) -> DataFrame:
        return self._provide("route_fares", lambda: rollups.route_fares(self.fact_trip))

    @cached_property
    def value_counts(self) -> DataFrame:
        return self._provide("value_counts", lambda: quantiles.value_counts(self.fact_trip))

    @cached_property
    def value_sketches(self) -> DataFrame:
        return self._provide("value_sketches", lambda: sketches.value_sketches(self.fact_trip))

    @cached_property
    def payment_sketches(self) -> DataFrame:
        return self._provide("payment_sketches", lambda: sketches.payment_sketches(self.fact_trip))

    @cached_property
    def mv_zone_pickup(self) -> DataFrame:
        return self._provide("mv_zone_pickup", lambda: rollups.zone_pickup(self.route_fares))

    @cached_property
    def mv_zone_dropoff(self) -> DataFrame:
        return self._provide("mv_zone_dropoff", lambda: rollups.zone_dropoff(self.route_fares))

    @cached_property
    def mv_hourly_demand(self) -> DataFrame:
        return self._provide("mv_hourly_demand", lambda: rollups.hourly_demand(self.fact_trip))

    @cached_property
    def mv_od_flows(self) -> DataFrame:
        return self._provide(
            "mv_od_flows", lambda: rollups.od_flows(self.route_fares, self.settings.min_od_trips)
        )

    @cached_property
    def mv_vendor_performance(self) -> DataFrame:
        return self._provide("mv_vendor_performance", lambda: rollups.vendor_performance(self.fact_trip))

    @cached_property
    def mv_payment_patterns(self) -> DataFrame:
        return self._provide("mv_payment_patterns", lambda: rollups.payment_patterns(self.fact_trip))

    @cached_property
    def summary_statistics(self) -> DataFrame:
        return self._provide("summary_statistics", lambda: rollups.summary_statistics(self.fact_trip))


class SavedTables(TripTables):
    """Tables written by a load; each is read from its own folder."""

    def __init__(
        self, spark: SparkSession, path: str, raw: DataFrame | None = None, settings: Settings | None = None
    ) -> None:
        # Rows of a load that broke off are in no batch that the audit lists.
        fact = store.read_table(spark, path, "fact_trip")
        fact = fact.filter(F.col("load_batch").isin(store.visible_batches(spark, path))).drop("load_batch")
        super().__init__(spark, store.read_table(spark, path, "dim_location"), raw, fact, settings)
        self.path = path

    def _provide(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        # Sketches are stored only where the load was asked for them.
        planned = name == "fact_trip" or name in SKETCHES and not self.settings.sketches
        return build() if planned else store.read_table(self.spark, self.path, name)


class StagedTables(TripTables):
    """Tables computed on first use and kept as Parquet under ``folder`` from then on.

    Many queries in one session then share one cleaning of the raw trips and one build of
    each rollup. The folder must be one all executors reach; a lost executor costs only a
    second read of files.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        locations: DataFrame,
        raw: DataFrame | None = None,
        fact: DataFrame | None = None,
        settings: Settings | None = None,
    ) -> None:
        self.folder = folder
        super().__init__(spark, store.stage(locations, folder, "dim_location"), raw, fact, settings)

    def _provide(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name == "fact_trip":
            return store.stage_fact(build(), self.folder)
        return store.stage(build(), self.folder, name)
