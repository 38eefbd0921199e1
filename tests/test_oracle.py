"""Every report against its SQL, bit for bit, and a few sums that must come out."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entries
from oracle import check
from tripmill.plans import staging

FOLDER = f"{TESTDATA}/sf0.01"
# The training-data queries have tests of their own.
APART = {"pipeline", *(entries.training_data.queries() if entries.training_data else {})}
SQL = {k: v for k, v in entries.oracle_sql().items() if k not in APART}
QUERIES = {k: v for k, v in entries.queries().items() if k not in APART}


@pytest.fixture(scope="module")
def duck():
    con = check.connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert check.differences(spark, duck, QUERIES[name], FOLDER, SQL[name]) == ""


def test_sql_covers_all_but_free_choices():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entries.entry(spark).collect()
    assert rows
    assert rows[0]["popularity_rank"] == 1


def test_invariants(spark):
    t = staging.commerce_tables(spark, FOLDER, entries.SETTINGS)
    trips = t.fact_trip.count()
    for rollup, column in (
        (t.mv_zone_pickup, "pickup_count"),
        (t.mv_zone_dropoff, "dropoff_count"),
        (t.mv_hourly_demand, "trip_count"),
        (t.mv_vendor_performance, "trip_count"),
        (t.mv_payment_patterns, "trip_count"),
    ):
        assert rollup.agg(F.sum(column)).first()[0] == trips
    for name, share in (
        ("demand_hourly", "pct_of_total"),
        ("tip_ratio_distribution", "pct_of_trips"),
        ("vendor_performance", "market_share_pct"),
        ("airport_revenue", "pct_of_total_revenue"),
        ("tipping_by_payment_type", "pct_of_trips"),
    ):
        assert QUERIES[name](spark, FOLDER).agg(F.sum(share)).first()[0] == pytest.approx(100)
    monthly = QUERIES["vendor_monthly_share"](spark, FOLDER).groupBy("year", "month").agg(F.sum("market_share_pct"))
    assert all(r[2] == pytest.approx(100) for r in monthly.collect())


def test_quantiles_agree_with_percentile_cont(spark, duck):
    """The SQL interpolates step by step; the built-in differs at most in the last digits."""
    sql = SQL["tipping_by_payment_type"]
    head = sql[: sql.rindex("SELECT payment_type_name")]
    con = duck.execute(
        head + """SELECT payment_type_name, PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY tip_percentage),
        PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY tip_percentage),
        PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY tip_percentage)
        FROM fact_trip JOIN dim_payment_type USING (payment_type_id) GROUP BY 1"""
    )
    want = {r[0]: r[1:] for r in con.fetchall()}
    for r in QUERIES["tipping_by_payment_type"](spark, FOLDER).collect():
        got = (r["tip_pct_q25"], r["tip_pct_median"], r["tip_pct_q75"])
        assert got == pytest.approx(want[r["payment_type_name"]], rel=1e-12)
