"""Read-side semantics on small fixtures, and the CSV -> bronze -> silver flow."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from mercato.operators import serving
from mercato.plans import pipeline
from mercato.sources import files


def _monthly(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, total_revenue decimal(28,4), "
                                       "total_orders bigint, median_order_value decimal(28,4), "
                                       "p90_order_value decimal(28,4), monthly_growth_pct double")


def test_period_filter_is_inclusive(spark):
    m = _monthly(spark, [(2017, 12, Decimal(1), 1, Decimal(1), Decimal(1), None),
                         (2018, 1, Decimal(2), 2, Decimal(1), Decimal(1), 100.0),
                         (2018, 6, Decimal(3), 3, Decimal(1), Decimal(1), 50.0),
                         (2018, 7, Decimal(4), 4, Decimal(1), Decimal(1), -25.0)])
    got = sorted((r["year"], r["month"]) for r in serving.period_filter(m, (2018, 1), (2018, 6))
                 .collect())
    assert got == [(2018, 1), (2018, 6)]
    kpi = serving.revenue_period_kpis(m, (2018, 1), (2018, 6)).first()
    assert kpi["total_orders"] == 5 and float(kpi["total_revenue"]) == 5.0
    assert kpi["avg_ticket"] == 1.0


def test_growth_sign_and_labels(spark):
    m = _monthly(spark, [(2017, 9, Decimal(1), 1, None, None, None),
                         (2017, 10, Decimal(2), 1, None, None, 100.0),
                         (2017, 11, Decimal(1), 1, None, None, -50.0),
                         (2017, 12, Decimal(1), 1, None, None, 0.0)])
    got = {r["period"]: r["growth_sign"] for r in serving.revenue_growth_sign(m).collect()}
    assert got == {"2017-09": "negative", "2017-10": "positive", "2017-11": "negative",
                   "2017-12": "positive"}


def test_top_k_breaks_ties_deterministically(spark):
    states = spark.createDataFrame([(s, Decimal(10), 1, 1.0) for s in "DCBAEFGHIJKL"],
                                   "customer_state string, total_revenue decimal(28,4), "
                                   "total_orders bigint, avg_order_value double")
    top = [r["customer_state"] for r in serving.overview_top_states(states, k=3).collect()]
    assert top == ["A", "B", "C"]


def test_recurrent_customers_rate(spark):
    fo = spark.createDataFrame([("o1", "a"), ("o2", "a"), ("o3", "b"), ("o4", "c")],
                               "order_id string, customer_id string")
    r = serving.recurrent_customers(fo).first()
    assert (r["recurrent"], r["total"], r["rate_pct"]) == (1, 3, 33.3)


def test_flag_percentages_long_form(spark):
    fo = spark.createDataFrame(
        [(True, False, False, False, False), (False, True, False, False, False),
         (False, False, False, False, False), (True, True, False, False, False)],
        "flag_financial_inconsistency boolean, flag_delayed boolean, "
        "flag_delivered_before_purchase boolean, flag_estimated_before_purchase boolean, "
        "flag_future_purchase boolean")
    got = {r["flag"]: (r["occurrences"], r["pct"]) for r in serving.flag_percentages(fo).collect()}
    assert got["financial_inconsistency"] == (2, 50.0) and got["future_purchase"] == (0, 0.0)


def test_csv_to_bronze_to_silver_with_misspelt_headers(spark, fixture_path, scratch):
    bronze = scratch("bronze_products")
    rep = pipeline.bronze(spark, fixture_path("products_typo.csv"), bronze, fmt="csv")
    assert rep.rows["bronze"] == 2
    silver = scratch("silver_products")
    rep = pipeline.silver(spark, bronze, "products", silver, bronze_format="csv")
    assert rep.rows["silver"] == 2
    df = files.read_parquet(spark, silver)
    types = dict(df.dtypes)
    assert types["product_name_length"] == "int" and types["product_id"] == "string"
    assert "product_name_lenght" not in df.columns
    null_cols = [r["column_name"] for r in rep.notes["optional_nulls"]]
    assert null_cols == ["product_category_name"]
    assert df.where(F.col("product_id") == "p1").first()["product_weight_g"] == 225


def test_broadcast_probe_is_bounded(spark):
    from mercato.operators.joins import broadcast_if_small, row_count_at_most
    df = spark.range(50)
    assert row_count_at_most(df, 50) and not row_count_at_most(df, 49)
    hinted = broadcast_if_small(df, 100)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert broadcast_if_small(df, 10) is df


def test_period_label_is_null_safe(spark):
    from mercato.functions.scalars import period_label
    df = spark.createDataFrame([(2018, 3), (None, None), (2018, 12)], "year int, month int")
    assert [r[0] for r in df.select(period_label()).collect()] == ["2018-03", None, "2018-12"]
