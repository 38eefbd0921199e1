"""Views and table functions against the DataFrame form of the reports."""

from __future__ import annotations

import pytest
from conftest import TESTDATA

import __spark_entry__ as entries
from tripmill.plans import catalog, sql, staging


@pytest.fixture(scope="module")
def tables(spark):
    return staging.commerce_tables(spark, f"{TESTDATA}/sf0.001", entries.SETTINGS)


@pytest.fixture(scope="module")
def names(tables):
    return sql.register(tables)


def test_every_report_is_a_function(spark, tables, names):
    assert set(names) == set(catalog.REPORTS) - set(sql.TABLES)
    for name in names:
        expected = list(map(repr, catalog.run(name, tables).collect()))
        assert sorted(map(repr, spark.sql(f"SELECT * FROM {name}()").collect())) == sorted(expected), name
        assert sorted(map(repr, spark.sql(f"SELECT * FROM {name}").collect())) == sorted(expected), name


def test_functions_take_a_limit(spark, tables, names):
    for name in ("zone_top_pickup", "anomaly_slow_trips", "api_top_routes", "outlier_percentiles", "profile_raw_top_routes"):
        found = spark.sql(f"SELECT * FROM {name}(7)")
        assert list(map(repr, found.collect())) == list(map(repr, catalog.run(name, tables, limit=7).collect())), name
        # Ranks over all zones or routes come first in reports that show them.
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "GlobalLimit 7" in plan or name == "zone_top_pickup", name
    named = spark.sql("SELECT count(*) AS n FROM profile_raw_top_routes(`limit` => 3)").first()
    assert named["n"] == 3
    for wrong in ("zone_top_pickup(0)", "api_top_pickup(1001)"):
        with pytest.raises(Exception, match="limit must be between"):
            spark.sql(f"SELECT * FROM {wrong}").collect()


def test_functions_join_with_tables(spark, tables, names):
    joined = spark.sql("""
        SELECT t.zone, t.pickup_count, count(*) AS trips FROM zone_top_pickup(5) t
        JOIN dim_location l ON t.zone = l.zone JOIN fact_trip f ON f.pu_location_id = l.location_id
        WHERE f.fare_amount > 0 AND f.fare_amount < 500 AND f.trip_distance > 0 GROUP BY 1, 2""").collect()
    assert len(joined) == catalog.run("zone_top_pickup", tables, limit=5).count() > 0
    assert all(r["pickup_count"] == r["trips"] for r in joined)
