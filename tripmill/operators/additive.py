"""The rollups as additive state: sums and counts of a batch of trips, which are merged into the rollups.

A state has whole numbers only, so that merged states give the same rollups, to the last bit, as one aggregation of
all trips. Medians come from counted fares. What is kept per batch:

- ``route_fares``: trips, miles and seconds per route and fare, for the zone and route rollups;
- ``value_counts``: trips per value of each measure that reports take quantiles of;
- one table of sums for each of the others, by the rollup's own keys;
- if wanted, sketches of the values of each measure, which are mergeable as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.exact import AMOUNT_STEP, RATIO_STEP, units
from tripmill.operators import quantiles, rollups, sketches

ROUTES, VALUES = "route_fares", "value_counts"
# Low bits of a ratio's units; the high and the low ones are summed apart, as either sum fits a bigint.
_LOW_BITS = 20
_LOW = 1 << _LOW_BITS


@dataclass(frozen=True)
class Measure:
    """A column of a rollup: what is summed of each trip, and what is made of the sums."""

    name: str
    kind: str
    value: str = "1"

    def parts(self) -> dict[str, str]:
        """SQL of the aggregates that the state keeps."""
        n = f"count({self.value})"
        if self.kind == "count":
            return {f"{self.name}_n": n}
        if self.kind in ("min", "max"):
            return {f"{self.name}_most": f"{self.kind}({self.value})"}
        if self.kind == "int_mean":
            return {f"{self.name}_sum": f"sum(CAST({self.value} AS BIGINT))", f"{self.name}_n": n}
        if self.kind == "ratio_mean":
            fine = units(self.value, RATIO_STEP)
            high = f"sum(shiftright({fine}, {_LOW_BITS}))"
            return {f"{self.name}_high": high, f"{self.name}_low": f"sum({fine} & {_LOW - 1}L)", f"{self.name}_n": n}
        whole = {f"{self.name}_sum": f"sum({units(self.value)})"}
        return whole if self.kind == "total" else whole | {f"{self.name}_n": n}

    def merged(self) -> Column:
        """The rollup's column from states, as an aggregate over them."""
        name = self.name
        if self.kind == "count":
            text = f"coalesce(sum({name}_n), 0L)"
        elif self.kind in ("min", "max"):
            text = f"{self.kind}({name}_most)"
        elif self.kind == "int_mean":
            text = f"CAST(sum({name}_sum) AS DOUBLE) / sum({name}_n)"
        elif self.kind == "ratio_mean":
            high = f"CAST(sum({name}_high) AS DECIMAL(38,0))"
            text = f"CAST({high} * {_LOW} + sum({name}_low) AS DOUBLE) / {RATIO_STEP}D / sum({name}_n)"
        else:
            text = f"CAST(sum({name}_sum) AS DOUBLE) / {AMOUNT_STEP}D"
            text += f" / sum({name}_n)" if self.kind == "mean" else ""
        return F.expr(text).alias(name)


@dataclass(frozen=True)
class Rollup:
    """A rollup that is a sum of states: which trips, by which keys, which measures."""

    test: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]

    def state(self, fact: DataFrame) -> DataFrame:
        parts = {name: text for m in self.measures for name, text in m.parts().items()}
        return fact.filter(self.test).groupBy(*self.keys).agg(*[F.expr(t).alias(n) for n, t in parts.items()])

    def merge(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*self.keys).agg(*[m.merged() for m in self.measures])


SUMS = {
    "mv_hourly_demand": Rollup(
        "fare_amount > 0",
        ("pickup_date", "pickup_hour", "pickup_day_of_week", "is_weekend"),
        (
            Measure("trip_count", "count"),
            Measure("avg_fare", "mean", "fare_amount"),
            Measure("total_revenue", "total", "total_amount"),
            Measure("avg_distance", "mean", "trip_distance"),
            Measure("avg_passengers", "int_mean", "passenger_count"),
        ),
    ),
    "mv_vendor_performance": Rollup(
        "fare_amount > 0",
        ("vendor_id",),
        (
            Measure("trip_count", "count"),
            Measure("avg_fare", "mean", "fare_amount"),
            Measure("avg_tip", "mean", "tip_amount"),
            Measure("avg_distance", "mean", "trip_distance"),
            Measure("avg_duration_sec", "int_mean", "trip_duration_seconds"),
            Measure("store_fwd_count", "count", "CASE WHEN store_and_fwd_flag = 'Y' THEN 1 END"),
            Measure("avg_passengers", "int_mean", "passenger_count"),
        ),
    ),
    "mv_payment_patterns": Rollup(
        "fare_amount > 0 AND fare_amount < 500",
        ("payment_type_id", "pickup_hour", "is_weekend"),
        (
            Measure("trip_count", "count"),
            Measure("avg_tip", "mean", "tip_amount"),
            Measure("avg_fare", "mean", "fare_amount"),
            Measure("avg_tip_pct", "ratio_mean", "try_divide(tip_amount, fare_amount) * 100.0D"),
            Measure("trips_with_tip", "count", "CASE WHEN tip_amount > 0 THEN 1 END"),
            Measure("trips_no_tip", "count", "CASE WHEN tip_amount > 0 THEN NULL ELSE 1 END"),
        ),
    ),
    "summary_statistics": Rollup(
        "fare_amount > 0",
        (),
        (
            Measure("total_trips", "count"),
            Measure("total_fare_amount", "total", "fare_amount"),
            Measure("total_tips", "total", "tip_amount"),
            Measure("total_revenue", "total", "total_amount"),
            Measure("avg_fare", "mean", "fare_amount"),
            Measure("avg_distance", "mean", "trip_distance"),
            Measure("avg_duration", "int_mean", "trip_duration_seconds"),
            Measure("avg_passengers", "int_mean", "passenger_count"),
            Measure("first_trip_date", "min", "pickup_datetime"),
            Measure("last_trip_date", "max", "pickup_datetime"),
        ),
    ),
}
STATES = [ROUTES, VALUES, *SUMS]


# How sketches of batches become those of all trips.
SKETCHES = {"value_sketches": sketches.merged_values, "payment_sketches": sketches.merged_payments}


def states(fact: DataFrame, with_sketches: bool = False) -> dict[str, DataFrame]:
    """The state of a batch of trips."""
    counted = {ROUTES: rollups.route_fares(fact), VALUES: quantiles.value_counts(fact)}
    if with_sketches:
        counted |= {name: getattr(sketches, name)(fact) for name in SKETCHES}
    return counted | {name: rollup.state(fact) for name, rollup in SUMS.items()}


def merged_routes(routes: DataFrame) -> DataFrame:
    """``route_fares`` of all batches together."""
    keys = ["pu_location_id", "do_location_id", "fare"]
    return routes.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "miles", "seconds")])


def merged_values(counts: DataFrame) -> DataFrame:
    """``value_counts`` of all batches together."""
    return counts.groupBy("measure", "payment_type_id", "value").agg(F.sum("n").alias("n"))


def merge(routes: DataFrame, sums: dict[str, DataFrame], min_od_trips: int) -> dict[str, DataFrame]:
    """All rollups from states; ``routes`` holds each route and fare once."""
    found = {name: SUMS[name].merge(state) for name, state in sums.items()}
    overall = found["summary_statistics"]
    found["summary_statistics"] = overall.select(F.lit("overall").alias("metric_type"), *overall.columns)
    return found | {
        "mv_zone_pickup": rollups.zone_pickup(routes),
        "mv_zone_dropoff": rollups.zone_dropoff(routes),
        "mv_od_flows": rollups.od_flows(routes, min_od_trips),
    }
