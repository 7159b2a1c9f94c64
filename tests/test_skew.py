"""Hot keys: one key holding a third of the rows must not land in one task."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import conform, marts
from mercato.operators.joins import hot_key_salts, hot_key_table, salted_join

N = 30_000

# Low thresholds so AQE's skew handling triggers on test-sized data.
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _orders(spark):
    """A third of all orders belong to customer ``hot``."""
    return spark.range(N).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.timestamp_add("DAY", (F.col("id") % 700).cast("int"),
                        F.lit(dt.datetime(2017, 1, 1))).alias("order_purchase_timestamp"),
        F.lit(Decimal("1.00")).cast("decimal(28,4)").alias("total_payment"),
    )


def _same(a, b):
    cols = sorted(a.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, a.select(cols).collect()), key=key) == \
        sorted(map(tuple, b.select(cols).collect()), key=key)


def test_hot_key_detection(spark):
    salts = hot_key_salts(_orders(spark), ["customer_id"], rows_per_salt=1000,
                          sample_fraction=0.2)["customer_id"]
    assert list(salts) == ["hot"]  # ~10,000 rows; every other customer has ~20
    assert 8 <= salts["hot"] <= 12
    assert hot_key_salts(_orders(spark), ["customer_id"])["customer_id"] == {}


def test_first_purchase_salts_a_hot_customer(spark, monkeypatch):
    from mercato.operators import joins
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 500)
    monkeypatch.setattr(joins, "HOT_SAMPLE_FRACTION", 0.2)
    fo = _orders(spark)
    got = marts.first_purchase(fo)
    assert "__salt" in got._jdf.queryExecution().optimizedPlan().toString()
    firsts = fo.groupBy("customer_id").agg(F.min("order_purchase_timestamp")
                                           .alias("first_purchase_date"))
    want = fo.select("order_id", "customer_id", "order_purchase_timestamp") \
        .join(firsts, "customer_id", "left")
    assert _same(got, want)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    orders = _orders(spark)
    lookup = spark.range(1000).select(
        F.col("id").cast("string").alias("customer_id"), F.col("id").alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 9)],
                                                      "customer_id string, v bigint"))
    salted = salted_join(orders, lookup, "customer_id", how, salts={"hot": 7, "5": 3})
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan
    assert _same(salted, orders.join(lookup, "customer_id", how))


def test_first_purchase_with_hot_customer(spark):
    fo = _orders(spark)
    got = marts.first_purchase(fo)
    firsts = fo.groupBy("customer_id").agg(F.min("order_purchase_timestamp")
                                           .alias("first_purchase_date"))
    want = fo.select("order_id", "customer_id", "order_purchase_timestamp") \
        .join(firsts, "customer_id", "left")
    assert _same(got, want)


def test_aqe_splits_the_hot_customer_lookup(skew_conf):
    spark = skew_conf
    customers = spark.range(1000).select(F.col("id").cast("string").alias("customer_id"),
                                         F.lit("S").alias("customer_state"))
    joined = _orders(spark).join(customers, "customer_id", "left")
    joined.collect()  # run it, then read the final adaptive plan
    final = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in final


def test_keyed_dedup_cuts_hot_keys_before_the_shuffle(spark):
    rows = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("order_id"),
        F.lit(1).alias("order_item_id"), F.col("id").alias("product_id"),
        F.lit(1).alias("seller_id"), F.lit(None).cast("timestamp").alias("shipping_limit_date"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("price"),
        F.lit(Decimal("0")).cast("decimal(18,4)").alias("freight_value"))
    deduped = conform.dedup_items(rows)
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    partial = plan.find("WindowGroupLimit")
    assert "Partial" in plan and partial >= 0
    lines = plan.splitlines()
    exchange_at = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("Partial" in l and "WindowGroupLimit" in l for l in lines[exchange_at:])
    got = {r["order_id"]: r["product_id"] for r in deduped.where("order_id = 'hot'").collect()}
    assert got == {"hot": 0}
    assert deduped.count() == 1 + (N - N // 3 - (1 if N % 3 else 0))


def test_cohort_with_hot_customer(spark):
    fo = _orders(spark)
    got = marts.metrics_cohort(fo)
    first = fo.groupBy("customer_id").agg(F.min("order_purchase_timestamp").alias("f"))
    want = (fo.join(first, "customer_id", "left")
            .where(F.col("customer_id").isNotNull())
            .groupBy(F.date_format("f", "yyyy-MM").alias("cohort_month"),
                     F.months_between(F.trunc("order_purchase_timestamp", "MM"), F.trunc("f", "MM"))
                     .cast("int").alias("months_since_first"))
            .agg(F.count_distinct("customer_id").alias("customers")))
    assert _same(got.where(F.col("cohort_month").isNotNull()), want)


def test_two_hundred_hot_keys_are_all_spread(skew_conf):
    spark = skew_conf
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        big = spark.range(120_000).select(
            F.when(F.col("id") % 10 < 8, F.concat(F.lit("hot"), (F.col("id") % 200).cast("string")))
            .when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
        lookup = spark.range(200).select(F.concat(F.lit("hot"), F.col("id").cast("string")).alias("k"),
                                         F.col("id").alias("w"))
        hot = hot_key_table(big, ["k"], rows_per_salt=50, sample_fraction=0.5)
        keys = {r["val"]: r["salts"] for r in hot.collect()}
        assert len(keys) == big.where("k like 'hot%'").select("k").distinct().count() >= 160
        joined = salted_join(big, lookup, "k", "left", salts=hot)
        assert "hot17" not in joined._jdf.queryExecution().optimizedPlan().toString()  # no literal per key
        assert _same(joined, big.join(lookup, "k", "left"))
        per_task = (joined.where("k like 'hot%'").groupBy("k", F.spark_partition_id().alias("p")).count()
                    .groupBy("k").agg(F.count("*").alias("tasks"), F.max("count").alias("most"), F.sum("count").alias("n")))
        for r in per_task.collect():
            assert r["tasks"] > 1 and r["most"] < r["n"], r
        assert salted_join(big, lookup, "k", "inner", salts=hot).count() == big.join(lookup, "k").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_hot_key_gives_the_plain_join(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    joined = salted_join(big, big.withColumn("w", F.lit(1)), "k")
    assert "__salt" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 100
