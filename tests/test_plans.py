"""What the plans must look like for the reports to hold up on large tables."""

from __future__ import annotations

import re

import pytest
from conftest import TESTDATA

import __spark_entry__ as entries
from tripmill import TripTables
from tripmill.operators import anomalies, flows, profile, tipping, vendors
from tripmill.plans import catalog, staging


@pytest.fixture(scope="module")
def staged(spark):
    return staging.commerce_tables(spark, f"{TESTDATA}/sf0.001", entries.SETTINGS)


@pytest.fixture(scope="module")
def lazy(spark):
    locations, raw, fact = staging.commerce_plans(spark, f"{TESTDATA}/sf0.001", entries.SETTINGS)
    return TripTables(spark, locations, raw, fact, entries.SETTINGS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_report_pairs_all_rows(lazy):
    for name in catalog.REPORTS:
        plan = plan_of(catalog.run(name, lazy, **entries.ARGUMENTS.get(name, {})))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_no_window_over_unaggregated_trips(staged):
    """Every window without partition keys sits above an aggregation, a limit or a rollup."""
    for name in catalog.REPORTS:
        plan = plan_of(catalog.run(name, staged, **entries.ARGUMENTS.get(name, {})))
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Window [" in line and "SinglePartition" in "".join(lines[i : i + 3]):
                below = "".join(lines[i + 1 :])
                assert re.search(r"HashAggregate|TakeOrderedAndProject|mv_|VendorID", below), name


def test_raw_reports_read_few_columns(lazy):
    plan = plan_of(profile.vendor_distribution(lazy))
    read = re.search(r"lineitem.parquet.*?ReadSchema: struct<([^>]*)>", plan).group(1)
    assert read == "l_orderkey:bigint,l_suppkey:bigint"


def test_scope_is_applied_before_the_large_join(lazy):
    plan = plan_of(lazy.fact_trip.select("trip_id"))
    big = re.search(r"(\w+Join) \[l_orderkey", plan).start()
    assert plan.count("LeftSemi", big) == 2
    assert plan.count("LeftSemi") == 2


def test_dimensions_are_broadcast(staged):
    for df in (vendors.by_hour(staged), anomalies.high_fare_per_mile(staged), flows.top_routes(staged)):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan


def test_locations_are_not_broadcast_when_too_large(spark, staged):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = plan_of(staged_copy(spark, staged))
    finally:
        spark.conf.set(key, old)
    assert "SortMergeJoin" in plan


def staged_copy(spark, staged):
    return anomalies.high_fare_per_mile(
        TripTables(spark, staged.dim_location, fact=staged.fact_trip, settings=staged.settings)
    )


def test_summary_reads_trips_once(staged):
    """The percentile comes from counted values, which four reports share."""
    scans = re.findall(r"FileScan parquet \[[^\]]*\]", plan_of(anomalies.summary(staged)))
    assert len({s for s in scans if "rate_code_id" in s}) == 1
    others = [set(re.findall(r"(\w+)#", s)) for s in scans if "rate_code_id" not in s]
    assert others and all(columns <= {"measure", "value", "n"} for columns in others)


def test_reports_on_quantiles_share_one_scan_of_trips(staged):
    for report in (anomalies.extreme_distance, anomalies.outlier_percentiles, tipping.by_payment_type):
        plan = plan_of(report(staged))
        locations = re.findall(r"Location: InMemoryFileIndex[^,]*?/(\w+)\]", plan)
        assert locations.count("fact_trip") <= 1, locations
        assert "value_counts" in locations


def test_top_k_is_not_a_full_sort(staged):
    plan = plan_of(anomalies.high_fare_per_mile(staged))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_fact_filters_reach_the_scan(staged):
    plan = plan_of(anomalies.high_fare_per_mile(staged))
    assert "GreaterThan(fare_per_mile,50.0)" in plan


def test_staged_tables_are_shared_and_noticed_when_inputs_change(spark, staged, tmp_path):
    again = staging.commerce_tables(spark, f"{TESTDATA}/sf0.001", entries.SETTINGS)
    assert again is staged
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        spark.read.parquet(f"{TESTDATA}/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    full = staging.commerce_tables(spark, str(folder), entries.SETTINGS).fact_trip.count()
    half = spark.read.parquet(f"{TESTDATA}/sf0.001/lineitem.parquet").filter("l_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    less = staging.commerce_tables(spark, str(folder), entries.SETTINGS).fact_trip.count()
    assert 0 < less < full


class FakeSession:
    """A session as far as the choice of a folder goes."""

    def __init__(self, master: str, folder: str | None) -> None:
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder():
    assert staging.shared_folder(FakeSession("yarn", "hdfs://data/tmp/")) == "hdfs://data/tmp"
    assert staging.shared_folder(FakeSession("local[8]", "/shared")) == "/shared"
    assert staging.shared_folder(FakeSession("yarn", None)) is None
    assert staging.shared_folder(FakeSession("local[8]", None))
