"""Quantiles from sketches against exact ones: error in rank, merging, one scan."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entries
from tripmill.operators import sketches
from tripmill.operators.quantiles import MEASURES
from tripmill.plans import catalog, staging


@pytest.fixture(scope="module")
def tables(spark):
    return staging.commerce_tables(spark, f"{TESTDATA}/sf0.1", entries.SETTINGS)


def ranks(fact, test: str, column: str, value: float) -> tuple[float, float]:
    """Shares of trips below a value, and up to it."""
    known = fact.filter(test).filter(f"{column} IS NOT NULL")
    below, upto, n = known.agg(F.count_if(F.col(column) < value), F.count_if(F.col(column) <= value), F.count("*")).first()
    return below / n, upto / n


def test_error_in_rank(tables):
    fact = tables.fact_trip
    # As many sketches as a load of many batches keeps, merged.
    parts = [sketches.value_sketches(fact.filter(F.col("trip_id") % 5 == k)) for k in range(5)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.union(part)
    merged = sketches.merged_values(merged)
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    for name in merged.columns:
        found = merged.select(*[sketches.quantile(F.col(name), s) for s in shares]).first()
        for share, value in zip(shares, found):
            low, high = ranks(fact, MEASURES[name][0], MEASURES[name][1], value)
            assert low - sketches.RANK_ERROR <= share <= high + sketches.RANK_ERROR, (name, share)


def test_reports_with_sketches(tables):
    for name in ("mv_zone_pickup", "mv_od_flows", "tipping_by_payment_type", "anomaly_extreme_distance", "outlier_percentiles"):
        exact, near = catalog.run(name, tables), catalog.run(name, tables, approx=True)
        assert exact.schema.simpleString() == near.schema.simpleString(), name
        assert near.count() == exact.count() or name == "anomaly_extreme_distance"
    keys = ["payment_type_name"]
    exact = {r[0]: r for r in catalog.run("tipping_by_payment_type", tables).select(*keys, "tip_pct_median", "trip_count").collect()}
    for row in catalog.run("tipping_by_payment_type", tables, approx=True).select(*keys, "tip_pct_median", "trip_count").collect():
        assert row["trip_count"] == exact[row[0]]["trip_count"]
        assert row["tip_pct_median"] == pytest.approx(exact[row[0]]["tip_pct_median"], abs=0.5)


def test_rollups_with_sketches_shuffle_no_values(tables):
    for name in ("mv_zone_pickup", "mv_od_flows"):
        plan = catalog.run(name, tables, approx=True)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1, plan


def test_empty_sketches(tables):
    nothing = sketches.value_sketches(tables.fact_trip.limit(0))
    assert set(nothing.select(*[sketches.quantile(F.col(c), 0.5) for c in nothing.columns]).first()) == {None}
