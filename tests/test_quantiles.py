from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.functions import exact
from tripmill.operators.quantiles import grouped_quantiles, quantile, with_ranks

SHARES = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}


def counted(spark, values, keys=("x",)):
    rows = [(k, v) for k in keys for v in values]
    return spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))


def brute(values, share):
    ordered = sorted(values)
    place = (len(ordered) - 1) * share
    low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: x + 0.0), min_size=1, max_size=60))
def test_against_brute_force(spark, values):
    row = grouped_quantiles(counted(spark, values), ["k"], "v", "n", SHARES).first()
    for name, share in SHARES.items():
        assert row[name] == brute(values, share)
        assert row[name] == pytest.approx(np.quantile(values, share), rel=1e-9, abs=1e-9)


def test_many_groups_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.zeros(3000), rng.normal(0, 50, 5000), np.full(2000, 20.0)]).tolist()
    found = grouped_quantiles(counted(spark, values, ["p", "q"]), ["k"], "v", "n", SHARES).collect()
    assert {r["k"] for r in found} == {"p", "q"}
    for row in found:
        assert [row[n] for n in SHARES] == [brute(values, s) for s in SHARES.values()]


def test_nulls_are_left_out_and_keys_may_be_null(spark):
    rows = [(None, 1.0), (None, 2.0), (None, None), ("z", None)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    found = grouped_quantiles(df, ["k"], "v", "n", {"m": 0.5}).collect()
    assert [(r["k"], r["m"]) for r in found] == [(None, 1.5)]


def test_interpolation(spark):
    df = counted(spark, [1.0, 2.0, 4.0])
    ranked = with_ranks(df, ["k"], "v", "n").groupBy("k").agg(quantile(0.9, "v", "n").alias("p90"))
    assert ranked.first()["p90"] == pytest.approx(3.6)


def test_same_as_spark_percentile(spark):
    rng = np.random.default_rng(2)
    values = (rng.integers(1, 50_000, 4000) / 100).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = df.agg(F.percentile("v", F.array(*map(F.lit, SHARES.values()))).alias("q")).first()["q"]
    counts = df.groupBy("v").agg(F.count("*").alias("n"))
    row = grouped_quantiles(counts, [], "v", "n", SHARES).first()
    assert [row[n] for n in SHARES] == pytest.approx(want)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=40))
def test_exact_sums_do_not_depend_on_order(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    measures = [exact.total("v").alias("s"), exact.mean("v").alias("m"), exact.ratio_mean("v").alias("r")]
    one = df.agg(*measures).first()
    other = df.repartition(5).agg(*measures).first()
    assert one == other
    assert one["s"] == sum(cents) / 100
    assert one["m"] == sum(cents) / 100 / len(cents)
    assert one["r"] == pytest.approx(one["m"], rel=1e-12, abs=1e-12)


def test_exact_means_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "v double, i int")
    row = empty.agg(exact.mean("v"), exact.ratio_mean("v"), exact.int_mean("i"), exact.total("v")).first()
    assert list(row) == [None] * 4


def test_ratio_mean_beyond_one_bigint(spark):
    # 40 values of 9e11 come to 3.6e19 millionths, past the largest bigint.
    df = spark.range(40).select(F.lit(9.0e11).alias("v"))
    assert df.agg(exact.ratio_mean("v").alias("m")).first()["m"] == 9.0e11


@pytest.mark.parametrize(("value", "want"), [(1.005, 1.0), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.13), (2.5, 2.5)])
def test_round_half_up(spark, value, want):
    got = spark.range(1).select(exact.round_half_up(F.lit(value), 2).alias("r")).first()["r"]
    assert got == want
