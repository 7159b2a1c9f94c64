"""Hand-made fixtures for the semantics that are easy to get wrong."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F


from mercato.operators import conform, marts, quality, serving
from mercato.operators.ranking import global_rank_running_sum
from mercato.sources import files

TS = dt.datetime


def _orders(spark, rows):
    schema = ("order_id string, customer_id string, order_status string, "
              "order_purchase_timestamp timestamp, order_approved_at timestamp, "
              "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
              "order_estimated_delivery_date timestamp")
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ T2 / T4 / S1 / Q8 / Q9
def test_csv_multiline_quotes_and_bad_values(spark, fixture_path):
    raw = files.read_csv_raw(spark, fixture_path("reviews_multiline.csv"))
    rows = {r["review_id"]: r for r in raw.collect()}
    assert len(rows) == 3
    assert rows["r1"]["review_comment_message"] == "Arrived early,\nwell packed"
    assert rows["r2"]["review_comment_title"] == 'So "so", ok'
    assert rows["r2"]["review_comment_message"] == 'He said "fine", then left'
    typed = quality.cast_to_contract(raw, "order_reviews")
    assert dict(typed.dtypes)["review_score"] == "int"
    scores = {r["review_id"]: r["review_score"] for r in typed.collect()}
    assert scores == {"r1": 5, "r2": 3, "r3": None}  # ANSI on, but no exception
    kept = quality.drop_strict_nulls(typed, "order_reviews")
    assert sorted(r["review_id"] for r in kept.collect()) == ["r1", "r2"]


def test_raw_reader_rejects_other_formats(spark, fixture_path):
    with pytest.raises(files.UnsupportedFormatError):
        files.read_csv_raw(spark, fixture_path("wrong_format.json"))
    with pytest.raises(files.UnsupportedFormatError):
        files.read_csv_raw(spark, "/some/where/orders.parquet")


# ------------------------------------------------------------------ Q5 / T22
def test_blank_and_header_only_inputs_are_refused(spark, fixture_path):
    blank = files.read_csv_raw(spark, fixture_path("blank_rows.csv"))
    flags = quality.emptiness_flags(blank).first()
    assert flags["has_rows"] and not flags["has_non_blank_row"]
    with pytest.raises(quality.EmptyDataError):
        quality.assert_non_empty(blank)
    # always-filled ingestion columns do not hide blank rows
    with pytest.raises(quality.EmptyDataError):
        quality.assert_non_empty(quality.add_ingestion_metadata(blank))
    header_only = files.read_csv_raw(spark, fixture_path("header_only.csv"))
    with pytest.raises(quality.EmptyDataError):
        quality.assert_non_empty(header_only)
    ok = files.read_csv_raw(spark, fixture_path("messy_headers.csv"))
    assert quality.assert_non_empty(ok) is ok


# ------------------------------------------------------------------ Q1 / Q6 / Q7
def test_normalize_columns(spark, fixture_path):
    df = quality.normalize_columns(files.read_csv_raw(spark, fixture_path("messy_headers.csv")))
    assert df.columns == ["order_id", "price_r", "x_y"]


def test_rename_typos_and_contract(spark, fixture_path):
    raw = files.read_csv_raw(spark, fixture_path("products_typo.csv"))
    fixed = quality.rename_typos(raw, "products")
    assert "product_name_length" in fixed.columns and "product_name_lenght" not in fixed.columns
    assert quality.schema_contract(fixed, "products") == []
    with pytest.raises(quality.SchemaContractError):
        quality.schema_contract(raw, "products")
    extra = fixed.withColumn("surprise", F.lit(1))
    assert quality.schema_contract(quality.add_ingestion_metadata(extra), "products") == ["surprise"]
    typed = quality.cast_to_contract(fixed, "products")
    assert dict(typed.dtypes)["product_weight_g"] == "int"


# ------------------------------------------------------------------ Q3 / Q11 / T5
def test_full_row_dedup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert quality.dedup_full_row(df).count() == 2


def test_keyed_dedup_is_layout_independent(spark):
    rows = [("o1", 1, "p2", "s1", None, Decimal("10.00"), Decimal("1.0000")),
            ("o1", 1, "p1", "s9", None, Decimal("99.00"), Decimal("1.0000")),
            ("o1", 1, "p1", "s2", None, Decimal("50.00"), Decimal("1.0000")),
            ("o2", 1, "p3", "s1", None, Decimal("5.00"), Decimal("0.5000"))] * 3
    schema = ("order_id string, order_item_id int, product_id string, seller_id string, "
              "shipping_limit_date timestamp, price decimal(18,2), freight_value decimal(18,4)")
    df = spark.createDataFrame(rows, schema)
    results = set()
    for n in (1, 7, 31):
        kept = conform.dedup_items(df.repartition(n)).orderBy("order_id").collect()
        results.add(tuple(tuple(r) for r in kept))
    assert len(results) == 1
    (kept,) = results
    assert [r[2:4] for r in kept] == [("p1", "s2"), ("p3", "s1")]


# ------------------------------------------------------------------ Q12 / Q13 / Q16 / T7
def test_date_flags_and_delivery_measures(spark):
    p = TS(2018, 1, 10, 12, 0)
    rows = [
        ("before", "c", "delivered", p, None, None, TS(2018, 1, 9), TS(2018, 1, 20)),
        ("estimate", "c", "delivered", p, None, None, TS(2018, 1, 15), TS(2018, 1, 5)),
        ("future", "c", "delivered", TS(2999, 1, 1), None, None, None, None),
        ("null", "c", "shipped", p, None, None, None, TS(2018, 1, 20)),
        ("late1h", "c", "delivered", p, None, None, TS(2018, 1, 20, 13, 0), TS(2018, 1, 20, 12, 0)),
        ("late3d", "c", "delivered", p, None, None, TS(2018, 1, 23, 1, 0), TS(2018, 1, 20, 23, 0)),
    ]
    df = conform.delivery_measures(conform.order_date_flags(_orders(spark, rows)))
    got = {r["order_id"]: r for r in df.collect()}
    assert got["before"]["flag_delivered_before_purchase"] is True
    assert got["estimate"]["flag_estimated_before_purchase"] is True
    assert got["future"]["flag_future_purchase"] is True
    assert not any(got["null"][c] for c in conform.DATE_FLAGS)
    assert got["null"]["flag_delayed"] is False and got["null"]["delay_days"] == 0
    assert got["null"]["delivery_days"] is None
    assert got["late1h"]["flag_delayed"] is True and got["late1h"]["delay_days"] == 0
    assert got["late3d"]["delay_days"] == 3
    assert got["estimate"]["estimated_delivery_days"] == -5
    assert conform.invalid_date_count(conform.order_date_flags(_orders(spark, rows))) \
        .first()["invalid_dates"] == 3


# ------------------------------------------------------------------ Q14 / A1 / A2
def test_financial_flag(spark):
    p = TS(2018, 1, 1)
    orders = _orders(spark, [(o, "c", "delivered", p, None, None, None, None)
                             for o in ("equal", "off", "nopay", "negpay", "negfreight")])
    pays = spark.createDataFrame([
        ("equal", 1, "x", 1, Decimal("10.004")), ("off", 1, "x", 1, Decimal("10.01")),
        ("negpay", 1, "x", 1, Decimal("10.00")), ("negpay", 2, "x", 1, Decimal("-3.00")),
        ("negfreight", 1, "x", 1, Decimal("5.00")),
    ], "order_id string, payment_sequential int, payment_type string, "
       "payment_installments int, payment_value decimal(18,4)")
    items = spark.createDataFrame([
        ("equal", 1, "p", "s", None, Decimal("9.00"), Decimal("1.0000")),
        ("off", 1, "p", "s", None, Decimal("9.00"), Decimal("1.0000")),
        ("nopay", 1, "p", "s", None, Decimal("9.00"), Decimal("1.0000")),
        ("negpay", 1, "p", "s", None, Decimal("9.00"), Decimal("1.0000")),
        ("negfreight", 1, "p", "s", None, Decimal("5.00"), Decimal("0.0000")),
        ("negfreight", 2, "p", "s", None, Decimal("7.00"), Decimal("-1.0000")),
    ], "order_id string, order_item_id int, product_id string, seller_id string, "
       "shipping_limit_date timestamp, price decimal(18,2), freight_value decimal(18,4)")
    got = {r["order_id"]: r for r in conform.financial_flag(orders, pays, items).collect()}
    assert got["equal"]["flag_financial_inconsistency"] is False
    assert got["off"]["flag_financial_inconsistency"] is True
    assert got["nopay"]["flag_financial_inconsistency"] is False
    assert got["nopay"]["total_payment"] is None
    assert got["negpay"]["total_payment"] == Decimal("10.0000")
    assert got["negpay"]["flag_financial_inconsistency"] is False
    assert got["negfreight"]["total_items"] == Decimal("5.00")
    assert got["negfreight"]["flag_financial_inconsistency"] is False


# ------------------------------------------------------------------ Q15 / M1 / T8
def test_customer_rules(spark):
    rows = [("a", "a", 999, "x", "SP"), ("b", "b", 1000, None, None), ("c", "c", 99999, "y", "RJ"),
            ("d", "d", 100000, "z", "MG"), ("e", "e", None, "w", "BA")]
    df = spark.createDataFrame(rows, "customer_id string, customer_unique_id string, "
                               "customer_zip_code_prefix int, customer_city string, "
                               "customer_state string")
    got = {r["customer_id"]: r for r in conform.customer_rules(df).collect()}
    assert [got[k]["customer_zip_code_prefix"] for k in "abcde"] == [None, 1000, 99999, None, None]
    assert got["b"]["customer_city"] == "unknown" and got["b"]["customer_state"] == "unknown"
    assert conform.invalid_zip_count(conform.customer_rules(df)).first()["invalid_zip"] == 3


# ------------------------------------------------------------------ W1 / W2 / T12 / T16
def _fact(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_status string, "
                                       "order_purchase_timestamp timestamp, total_payment decimal(28,4)")


def test_growth_uses_previous_existing_month(spark):
    fo = _fact(spark, [
        ("o1", "c1", "delivered", TS(2020, 1, 5), Decimal("100")),
        ("o2", "c1", "shipped", TS(2020, 3, 5), Decimal("150")),
        ("o3", "c2", "canceled", TS(2020, 3, 6), Decimal("999")),
        ("o4", "c2", "delivered", TS(2020, 4, 6), Decimal("0")),
        ("o5", "c3", "delivered", TS(2020, 5, 6), Decimal("10")),
    ])
    got = {(r["year"], r["month"]): r for r in marts.metrics_revenue(fo).collect()}
    assert sorted(got) == [(2020, 1), (2020, 3), (2020, 4), (2020, 5)]
    assert got[(2020, 1)]["monthly_growth_pct"] is None
    assert got[(2020, 3)]["monthly_growth_pct"] == 50.0  # vs January; canceled excluded
    assert got[(2020, 4)]["monthly_growth_pct"] == -100.0
    assert got[(2020, 5)]["monthly_growth_pct"] is None  # previous month is 0
    assert got[(2020, 3)]["total_orders"] == 1


# ------------------------------------------------------------------ W3-W5 / A18 / T13
def _items(spark, rows):
    """Item-fact rows (order, product, category, price); seller 's1', no freight."""
    df = spark.createDataFrame(rows, "order_id string, product_id string, "
                                     "product_category_name_english string, price decimal(18,2)")
    return df.withColumns({
        "order_item_id": F.lit(1), "seller_id": F.lit("s1"), "seller_state": F.lit("SP"),
        "freight_value": F.lit(Decimal("0")).cast("decimal(18,4)"),
        "total_value": F.col("price") + F.lit(Decimal("0")).cast("decimal(18,4)"),
    })


def test_abc_edges(spark):
    orders = _fact(spark, [("o1", "c", "delivered", TS(2020, 1, 1), None)])
    items = _items(spark, [("o1", "p80", "a", Decimal("80")), ("o1", "p15", "b", Decimal("15")),
                           ("o1", "p5", "c", Decimal("5"))])
    got = {r["product_id"]: r for r in marts.metrics_abc(items, orders).collect()}
    assert [got[p]["abc_class"] for p in ("p80", "p15", "p5")] == ["A", "B", "C"]
    assert [got[p]["rank"] for p in ("p80", "p15", "p5")] == [1, 2, 3]
    single = marts.metrics_abc(_items(spark, [("o1", "only", "a", Decimal("7"))]), orders).first()
    assert single["abc_class"] == "C" and single["cumulative_revenue_pct"] == 100.0
    ties = _items(spark, [("o1", "pb", "a", Decimal("10")), ("o1", "pa", "a", Decimal("10"))])
    ranked = {r["product_id"]: r["rank"] for r in marts.metrics_abc(ties, orders).collect()}
    assert ranked == {"pa": 1, "pb": 2}


@pytest.mark.parametrize("buckets", [1, 3, 8, 50])
def test_range_bucketed_rank_equals_plain_window(spark, buckets):
    rnd = random.Random(buckets)
    rows = [(f"p{i:05d}", Decimal(rnd.choice([7, 7, 7]) if i % 3 == 0 else rnd.randint(1, 500)))
            for i in range(1500)]  # a third of the rows share one revenue value
    df = spark.createDataFrame(rows, "product_id string, total_revenue decimal(18,2)")
    order = [F.col("total_revenue").desc(), F.col("product_id").asc()]
    fast = global_rank_running_sum(df, order, "total_revenue", n_buckets=buckets,
                                   total_col="total")
    w = Window.orderBy(*order)
    plain = df.select("product_id", F.row_number().over(w).alias("rank"),
                      F.sum("total_revenue").over(w.rowsBetween(Window.unboundedPreceding, 0))
                      .alias("running_sum"))
    a = sorted((r["product_id"], r["rank"], r["running_sum"]) for r in fast.collect())
    b = sorted((r["product_id"], r["rank"], r["running_sum"]) for r in plain.collect())
    assert a == b
    assert {r["total"] for r in fast.select("total").distinct().collect()} == \
        {sum(v for _, v in rows)}


# ------------------------------------------------------------------ A10 / A11 / T10 / T11
def test_review_fanout_and_orphans(spark):
    orders = _fact(spark, [("o1", "c", "delivered", TS(2020, 2, 1), Decimal("1"))])
    items = spark.createDataFrame(
        [("o1", 1, "x"), ("o1", 2, "x"), ("o1", 3, "y")],
        "order_id string, order_item_id int, product_category_name_english string")
    reviews = spark.createDataFrame(
        [("r1", "o1", 5), ("r2", "nope", 1)], "review_id string, order_id string, review_score int")
    by_cat = {r["product_category_name_english"]: r
              for r in marts.metrics_reviews_by_category(reviews, items).collect()}
    assert by_cat["x"]["total_reviews"] == 2 and by_cat["y"]["total_reviews"] == 1
    assert by_cat[None]["total_reviews"] == 1 and by_cat[None]["avg_score"] == 1.0
    monthly = {(r["year"], r["month"]): r for r in marts.metrics_reviews(reviews, orders).collect()}
    assert monthly[(2020, 2)]["promoters"] == 1 and monthly[(2020, 2)]["nps"] == 100.0
    assert monthly[(None, None)]["detractors"] == 1 and monthly[(None, None)]["nps"] == -100.0
    fanout = marts.review_item_rows(reviews, items)
    assert fanout.count() == 4


# ------------------------------------------------------------------ A15 / D28 / D29
def test_small_cohort(spark):
    fo = _fact(spark, [
        ("a", "c1", "delivered", TS(2017, 1, 3), Decimal("1")),
        ("b", "c1", "delivered", TS(2017, 1, 20), Decimal("1")),
        ("c", "c1", "delivered", TS(2017, 2, 2), Decimal("1")),
        ("d", "c1", "delivered", TS(2018, 2, 2), Decimal("1")),
        ("e", "c2", "delivered", TS(2017, 2, 9), Decimal("1")),
    ])
    cohort = {(r["cohort_month"], r["months_since_first"]): r["customers"]
              for r in marts.metrics_cohort(fo).collect()}
    assert cohort == {("2017-01", 0): 1, ("2017-01", 1): 1, ("2017-01", 13): 1, ("2017-02", 0): 1}
    matrix = {r["cohort_month"]: r.asDict() for r in serving.cohort_matrix(
        marts.metrics_cohort(fo)).collect()}
    assert matrix["2017-01"]["13"] == 1 and matrix["2017-02"]["1"] is None
    ret = {r["cohort_month"]: r.asDict() for r in serving.cohort_retention_pct(
        marts.metrics_cohort(fo)).collect()}
    assert ret["2017-01"]["0"] == 100.0 and ret["2017-01"]["13"] == 100.0
    rate = marts.repurchase_rate(fo).first()
    assert (rate["recurrent_customers"], rate["total_customers"], rate["repurchase_rate_pct"]) \
        == (1, 2, 50.0)


# ------------------------------------------------------------------ D38 / T14
def test_adhoc_sql_accepts_only_queries(spark):
    spark.range(3).createOrReplaceTempView("adhoc_t")
    assert serving.adhoc_select(spark, "SELECT count(*) AS n FROM adhoc_t").first()["n"] == 3
    assert serving.adhoc_select(spark, "WITH x AS (SELECT 1 AS a) SELECT * FROM x").count() == 1
    for bad in ("DROP VIEW adhoc_t", "CREATE TABLE adhoc_x AS SELECT 1 AS a",
                "SET spark.sql.shuffle.partitions=3", "CACHE TABLE adhoc_t"):
        with pytest.raises(serving.NotAQueryError):
            serving.adhoc_select(spark, bad)
    assert spark.catalog.tableExists("adhoc_t")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
