import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pricelens.operators import joins, market


def bounds_of(spark, rows, **options):
    frame = spark.createDataFrame(rows, "type_of_product string, x double")
    result = market.percentile_bounds(frame, "x", **options).collect()
    return {r.type_of_product: (r.lower_bound, r.upper_bound) for r in result}


def expected(rows):
    groups = {}
    for key, value in rows:
        if key is not None and value is not None:
            groups.setdefault(key, []).append(value)
    return {k: tuple(np.quantile(v, [0.1, 0.9])) for k, v in groups.items()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("sort_limit", [1_000_000, 3])
def test_bounds_of_a_hot_type(spark, sort_limit):
    rng = random.Random(5)
    rows = [("hot", round(rng.lognormvariate(3, 2), 2)) for _ in range(6000)]
    rows += [("tied", 4.5)] * 3000 + [("tied", 1e6), ("tied", -1e6)]
    rows += [(f"t{i % 300}", rng.uniform(-5, 5)) for i in range(3000)]
    rows += [("one", 7.0), (None, 1.0), ("gone", None)]
    assert_same(bounds_of(spark, rows, sort_limit=sort_limit), expected(rows))


@pytest.mark.parametrize("sort_limit", [1_000_000, 1])
def test_bounds_of_crowded_and_far_apart_prices(spark, sort_limit):
    crowd = [("crowd", 100 + i * 1e-12) for i in range(500)]
    apart = [("apart", 10.0 ** e) for e in range(-300, 300, 7)]
    rows = crowd + apart + [("zero", 0.0), ("zero", 0.0), ("two", 1.0), ("two", 2.0)]
    assert_same(bounds_of(spark, rows, sort_limit=sort_limit), expected(rows))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.tuples(st.sampled_from("ab"), st.floats(-1e9, 1e9, allow_subnormal=False)),
    min_size=1, max_size=60,
))
def test_bounds_of_any_values(spark, rows):
    assert_same(bounds_of(spark, rows, sort_limit=4), expected(rows))


def test_trim_keeps_the_middle(spark):
    rows = [("a", float(i)) for i in range(11)] + [("b", 3.0)]
    frame = spark.createDataFrame(rows, "type_of_product string, x double")
    kept = sorted((r.type_of_product, r.x) for r in market.trim_outliers(frame, "x").collect())
    assert kept == [("a", float(i)) for i in range(1, 10)] + [("b", 3.0)]


def test_market_stats(spark):
    frame = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), (None, 9.0)], "type_of_product string, x double"
    )
    assert [tuple(r) for r in market.market_stats(frame, "x").collect()] == [("a", 1.0, 3.0, 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast_bytes", [1 << 40, 0])
def test_lookup_join_on_a_hot_key(spark, how, broadcast_bytes):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(300)]
    left = spark.createDataFrame(rows, "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("k3", 4)], "k string, w int")
    got = joins.lookup_join(left, right, ["k"], how, broadcast_bytes=broadcast_bytes)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
