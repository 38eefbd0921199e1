"""Outliers and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.arguments import API_ROWS, check_limit
from tripmill.functions.exact import count_where, minutes, percent, round_half_up
from tripmill.functions.ranking import top
from tripmill.operators import sketches
from tripmill.operators.quantiles import grouped_quantiles
from tripmill.operators.star import with_both_zones, with_payment_type, with_rate_code
from tripmill.plans.tables import TripTables

# Fares taken for negotiated or estimated ones.
ROUND_FARES = [10.0, 20.0, 30.0, 40.0, 50.0, 75.0, 100.0, 150.0, 200.0]



def _fare() -> Column:
    return F.col("fare_amount")


def _miles() -> Column:
    return F.col("trip_distance")


def _seconds() -> Column:
    return F.col("trip_duration_seconds")


def _duration() -> Column:
    return minutes(_seconds()).alias("duration_min")


def _dear_per_mile() -> Column:
    return F.col("fare_per_mile") > 50


def _stuck() -> Column:
    return (_miles() > 0) & (_miles() < 1) & (_seconds() > 1800) & (F.col("avg_speed_mph") < 2)


def _dear_untipped() -> Column:
    return (_fare() > 50) & (F.col("tip_amount") == 0)


def _zoned(t: TripTables, trips: DataFrame) -> DataFrame:
    return with_both_zones(trips, t, "pickup_zone", "dropoff_zone")


def high_fare_per_mile(t: TripTables, limit: int = 100) -> DataFrame:
    trips = t.fact_trip.filter((_miles() > 0) & (_miles() < 100) & _dear_per_mile() & (_fare() < 1000))
    rows = with_rate_code(_zoned(t, trips), t).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "fare_amount",
        "trip_distance",
        "fare_per_mile",
        _duration(),
        "avg_speed_mph",
        "rate_code_name",
        F.lit("High fare per mile").alias("anomaly_type"),
    )
    return top(rows, check_limit(limit), F.col("fare_per_mile").desc())


def slow_trips(t: TripTables, limit: int = 100) -> DataFrame:
    rows = _zoned(t, t.fact_trip.filter(_stuck())).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "trip_distance",
        _duration(),
        "avg_speed_mph",
        "fare_amount",
        F.lit("Severe traffic/waiting").alias("anomaly_type"),
    )
    return top(rows, check_limit(limit), F.col("duration_min").desc())


def no_tip_expensive(t: TripTables, limit: int = 100) -> DataFrame:
    trips = with_payment_type(t.fact_trip.filter(_dear_untipped()), t).filter("allows_tip")
    rows = _zoned(t, trips).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "fare_amount",
        "tip_amount",
        "trip_distance",
        _duration(),
        "payment_type_name",
        F.lit("No tip on expensive trip").alias("anomaly_type"),
    )
    return top(rows, check_limit(limit), F.col("fare_amount").desc())


def quantiles_of(t: TripTables, measures: list[str], shares: list[float], approx: bool = False) -> Column:
    """Quantiles of measures, exact from counts or about right from sketches: a struct with an array per measure.

    As a scalar subquery the result needs no join and
    is computed once. Where several values of it are used, attach it as a column first:
    every mention of the expression itself would be planned anew.
    """
    if approx:
        arrays = [F.array(*[sketches.quantile(F.col(m), s) for s in shares]).alias(m) for m in measures]
        return t.value_sketches.select(F.struct(*arrays).alias("result")).scalar()
    counts = t.value_counts.filter(F.col("measure").isin(measures)).select("measure", "value", "n")
    names = [f"q{i}" for i in range(len(shares))]
    found = grouped_quantiles(counts, ["measure"], "value", "n", dict(zip(names, shares)))
    fields = [F.max(F.when(F.col("measure") == m, F.array(*names))).alias(m) for m in measures]
    return found.agg(F.struct(*fields).alias("result")).scalar()


def _far(t: TripTables, approx: bool = False) -> Column:
    return _miles() > quantiles_of(t, ["usual_distance"], [0.99], approx)["usual_distance"][0]


def extreme_distance(t: TripTables, limit: int = 100, approx: bool = False) -> DataFrame:
    rows = _zoned(t, t.fact_trip.filter(_far(t, approx))).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "trip_distance",
        _duration(),
        "fare_amount",
        "avg_speed_mph",
        F.lit("Extreme distance").alias("anomaly_type"),
    )
    return top(rows, check_limit(limit), F.col("trip_distance").desc())


def round_fares(t: TripTables, limit: int = 100) -> DataFrame:
    trips = with_rate_code(t.fact_trip.filter(_fare().isin(ROUND_FARES)), t).filter("is_standard")
    rows = _zoned(t, trips).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        "fare_amount",
        "total_amount",
        "trip_distance",
        "rate_code_name",
        F.lit("Suspicious round fare").alias("anomaly_type"),
    )
    return top(rows, check_limit(limit), F.col("fare_amount").desc(), F.col("pickup_datetime").desc())


def _tip_possible(t: TripTables) -> DataFrame:
    """Trips with the flags of their payment type and rate code, none dropped."""
    payment = F.broadcast(t.dim_payment_type.select("payment_type_id", "allows_tip"))
    rate = F.broadcast(t.dim_rate_code.select("rate_code_id", "is_standard"))
    return t.fact_trip.join(payment, "payment_type_id", "left").join(rate, "rate_code_id", "left")


def summary(t: TripTables, approx: bool = False) -> DataFrame:
    """Five kinds of anomaly counted in one pass, one row per kind."""
    # Names of the kinds.
    kinds = {
        "High fare per mile (>$50/mi)": (_miles() > 0) & _dear_per_mile(),
        "Severe traffic (<2 mph, >30 min)": _stuck(),
        "No tip on expensive trip (>$50)": _dear_untipped() & F.col("allows_tip"),
        "Extreme distance (>99th percentile)": _far(t, approx),
        "Round negotiated fares": _fare().isin(ROUND_FARES) & F.col("is_standard"),
    }
    counted = _tip_possible(t).agg(
        F.count("*").alias("trips"), *[count_where(test).alias(f"k{i}") for i, test in enumerate(kinds.values())]
    )
    pairs = [x for i, kind in enumerate(kinds) for x in (F.lit(kind), F.col(f"k{i}"))]
    long = counted.select("trips", F.stack(F.lit(len(kinds)), *pairs).alias("anomaly_type", "anomaly_count"))
    return long.select(
        "anomaly_type", "anomaly_count", percent(F.col("anomaly_count"), F.col("trips")).alias("pct_of_total")
    ).orderBy(F.col("anomaly_count").desc(), "anomaly_type")


def outlier_percentiles(t: TripTables, limit: int = 200, approx: bool = False) -> DataFrame:
    """Newest trips outside the 1st to 99th percentile of fare, distance or duration."""
    trips = t.fact_trip.filter((_fare() > 0) & (_miles() > 0))
    # Labels for values below the first and above the last percentile.
    labels = {
        "fare": ("fare_amount", "Low fare outlier", "High fare outlier"),
        "distance": ("trip_distance", "Very short trip", "Very long trip"),
        "duration": ("trip_duration_seconds", "Very fast trip", "Very slow trip"),
    }
    ends = quantiles_of(t, list(labels), [0.01, 0.99], approx)
    marks = {}
    for name, (column, low, high) in labels.items():
        value, (first, last) = F.col(column), (F.col("ends")[name][i] for i in (0, 1))
        marks[f"{name}_outlier"] = F.when(value < first, low).when(value > last, high)
    marked = trips.withColumn("ends", ends).withColumns(marks).filter(F.coalesce(*marks).isNotNull())
    rows = marked.select("trip_id", "pickup_datetime", "fare_amount", "trip_distance", _duration(), *marks)
    return top(rows, check_limit(limit), F.col("pickup_datetime").desc())


def api_high_fare_per_mile(t: TripTables, limit: int = 100) -> DataFrame:
    """Ordered by the rounded fare per mile, as shown."""
    trips = t.fact_trip.filter((_miles() > 0) & (_miles() < 100) & _dear_per_mile() & (_fare() < 1000))
    rows = _zoned(t, trips).select(
        "trip_id",
        "pickup_datetime",
        "pickup_zone",
        "dropoff_zone",
        round_half_up(_fare(), 2).alias("fare_amount"),
        round_half_up(_miles(), 2).alias("trip_distance"),
        round_half_up(F.col("fare_per_mile"), 2).alias("fare_per_mile"),
        round_half_up(minutes(_seconds()), 1).alias("duration_min"),
    )
    return top(rows, check_limit(limit, API_ROWS), F.col("fare_per_mile").desc())


def api_summary(t: TripTables) -> DataFrame:
    counted = _tip_possible(t).agg(
        F.count("*").alias("total_trips"),
        count_where((_miles() > 0) & _dear_per_mile() & (_fare() < 1000)).alias("high_fare_per_mile_count"),
        count_where(_dear_untipped() & F.col("allows_tip")).alias("no_tip_expensive_count"),
    )
    shares = {
        f"{kind}_percentage": round_half_up(percent(F.col(f"{kind}_count"), F.col("total_trips")), 2)
        for kind in ("high_fare_per_mile", "no_tip_expensive")
    }
    return counted.withColumns(shares)
