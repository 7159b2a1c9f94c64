"""Global rank and running sum with parts whose size is bounded by a parameter."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import ranking
from mercato.operators.ranking import global_rank_running_sum

KEYS = [("v", False), ("id", True)]


def frame(spark, n=6000, seed=1):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.02 else Decimal(rng.choice([1, 5, rng.randrange(900)])).scaleb(-1)) for i in range(n)]
    rows += [(None, Decimal("5.0")), (None, None)]
    return spark.createDataFrame(rows, "id int, v decimal(18,2)").repartition(7)


def order():
    return [F.col("v").desc_nulls_last(), F.col("id").asc_nulls_first()]


def literal(df):
    w = Window.orderBy(*order())
    return df.withColumn("rank", F.row_number().over(w)).withColumn(
        "running_sum", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def rows(df):
    return sorted(map(repr, map(tuple, df.select("id", "v", "rank", F.coalesce("running_sum", F.lit(0)).cast("decimal(28,2)"))
                                .collect())))


@pytest.mark.parametrize("buckets,rows_per_range", [(3, 100_000), (2, 400), (1, 90), (4, 40)])
def test_equals_the_global_window(spark, monkeypatch, buckets, rows_per_range):
    monkeypatch.setattr(ranking, "MAX_PARTS", 8)  # several levels
    df = frame(spark)
    got = global_rank_running_sum(df, order(), "v", n_buckets=buckets, keys=KEYS, rows_per_range=rows_per_range,
                                  total_col="total")
    assert rows(got) == rows(literal(df))
    total = df.agg(F.sum("v")).first()[0]
    assert {r[0] for r in got.select("total").distinct().collect()} == {total}


def test_no_part_is_larger_than_asked(spark, monkeypatch):
    seen = []
    real = ranking._offsets

    def watch(counts, levels, total_col):
        seen.append((levels, counts.agg(F.max("__n"), F.count(F.lit(1))).first()))
        return real(counts, levels, total_col)

    monkeypatch.setattr(ranking, "_offsets", watch)
    df = frame(spark, 30_000, 2)
    got = global_rank_running_sum(df, order(), "v", n_buckets=2, keys=KEYS, rows_per_range=500)
    assert got.agg(F.max("rank")).first()[0] == 30_002
    (levels, (largest, parts)), = seen
    assert levels >= 1 and largest <= 500 and parts >= 60


def test_a_hot_value_is_cut_by_its_tie_break(spark):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") % 3 > 0, 7).otherwise(
        F.col("id") % 50).cast("decimal(18,2)").alias("v"))
    got = global_rank_running_sum(df, order(), "v", n_buckets=2, keys=KEYS, rows_per_range=700)
    assert rows(got) == rows(literal(df))


def test_equal_rows_end_the_cutting(spark):
    df = spark.range(3000).select(F.lit(1).alias("id"), F.lit(2).cast("decimal(18,2)").alias("v"))
    got = global_rank_running_sum(df, order(), "v", n_buckets=2, keys=KEYS, rows_per_range=100)
    assert sorted(r.rank for r in got.collect()) == list(range(1, 3001))


def test_empty_table(spark):
    df = frame(spark, 5).limit(0)
    assert global_rank_running_sum(df, order(), "v", keys=KEYS, rows_per_range=2).count() == 0
