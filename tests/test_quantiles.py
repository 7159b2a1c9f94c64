"""Exact quantiles per group against sorting, and the exact revenue mart."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import marts
from mercato.operators.quantiles import exact_group_quantiles

SHARES = {"low": 0.0, "median": 0.5, "p90": 0.9, "top": 1.0}


def plain(rows, shares=SHARES):
    groups = {}
    for *key, value in rows:
        groups.setdefault(tuple(key), []).append(value)
    out = {}
    for key, values in groups.items():
        own = sorted(v for v in values if v is not None)
        out[key] = tuple(own[max(1, math.ceil(q * len(own))) - 1] if own else None for q in shares.values())
    return out


def got(df, groups, value, shares=SHARES, **options):
    found = exact_group_quantiles(df, groups, value, shares, **options)
    assert found.columns == [*groups, *shares]
    return {tuple(r[:len(groups)]): tuple(r[len(groups):]) for r in found.collect()}


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_equals_sorting(spark, buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]),
             None if rng.random() < 0.1 else Decimal(rng.randrange(-50_000, 5_000_000)).scaleb(-2)) for _ in range(2000)]
    rows += [("one", 1, Decimal("3.30")), ("none", 1, None), ("tie", 1, Decimal("1.00")), ("tie", 1, Decimal("1.00"))]
    df = spark.createDataFrame(rows, "g string, h int, v decimal(18,2)")
    assert got(df, ["g", "h"], "v", buckets=buckets) == plain(rows)


def test_whole_64_bit_range_and_no_groups(spark):
    rows = [(v,) for v in (-(1 << 63), -5, 0, 7, (1 << 63) - 1)]
    df = spark.createDataFrame(rows, "v long")
    assert got(df, [], "v") == plain(rows)
    assert got(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v") == {}


def test_wide_decimals_and_refused_types(spark):
    rows = [("g", Decimal(v).scaleb(-4)) for v in (10**15, -3, 5, 10**14 + 1, 7)]
    df = spark.createDataFrame(rows, "g string, v decimal(28,4)")
    assert got(df, ["g"], "v") == plain(rows)
    with pytest.raises(TypeError):
        exact_group_quantiles(df.select("g", F.col("v").cast("double").alias("v")), ["g"], "v", SHARES)
    with pytest.raises(ValueError):
        exact_group_quantiles(df, ["g"], "v", SHARES, buckets=1)


def test_revenue_mart_with_a_hundred_thousand_orders_in_a_month(spark):
    n = 100_000
    orders = spark.range(n + 500).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 50 == 0, "canceled").otherwise("delivered").alias("order_status"),
        F.when(F.col("id") < n, F.to_timestamp(F.lit("2017-03-05"))).otherwise(
            F.to_timestamp(F.lit("2017-05-06"))).alias("order_purchase_timestamp"),
        F.when(F.col("id") % 97 == 0, None).otherwise(
            (F.pmod(F.xxhash64("id"), F.lit(9_000_000)) / 100).cast("decimal(28,4)")).alias("total_payment"))
    want = {}
    for r in orders.where("order_status <> 'canceled'").select(
            F.month("order_purchase_timestamp").alias("m"), "total_payment").collect():
        want.setdefault(r.m, []).append((r.total_payment,))
    exact = marts.metrics_revenue_exact(orders)
    sketch = marts.metrics_revenue(orders)
    assert exact.columns == sketch.columns
    rows = {r.month: r for r in exact.collect()}
    assert sorted(rows) == [3, 5]
    for m, values in want.items():
        median, p90 = plain(values, {"m": 0.5, "p": 0.9})[()]
        assert (rows[m].median_order_value, rows[m].p90_order_value) == (median, p90)
    for r in sketch.collect():
        assert r.total_revenue == rows[r.month].total_revenue and r.total_orders == rows[r.month].total_orders


def test_hot_group_is_combined_before_the_shuffle(spark):
    """Counts per part are partial sums, and no sort sees the values."""
    from mercato.operators import quantiles
    keys = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("__key"))
    state = spark.createDataFrame([(0, "m", 0, 999, 10)], "g long, __name string, __low long, __high long, __rank long")
    plan = quantiles._narrowed(keys, state, ["g"], 16)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
