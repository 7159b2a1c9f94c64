"""Registry of named queries over the driver's test tables.

Each entry is ``(spark, sf_dir) -> DataFrame``: it maps the test tables onto
silver, builds gold and marts lazily, and returns one operator's result with
decimal money cast to double.  Keys follow SURVEY section 2.  The matching
DuckDB SQL lives in ``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.scalars import as_double_money, id_abbreviation, period_label
from mercato.operators import conform, marts, quality, serving
from mercato.plans import pipeline
from mercato.plans.gold import Gold, Marts
from mercato.sources import files, sinks, testdata
from mercato.sources.sql import register_views, sql_source

QueryFn = Callable[[SparkSession, str], DataFrame]

# Range used by the period filter queries (F7, D7, D8): the feature under test.
PERIOD_START, PERIOD_END = (1996, 3), (2000, 10)
ABC_FILTER_CLASS = "B"
ADHOC_SQL = ("SELECT order_status, count(*) AS orders, sum(total_payment) AS revenue "
             "FROM fact_orders GROUP BY order_status")
SQL_SOURCE_TEXT = ("SELECT customer_state, count(*) AS orders FROM fact_orders "
                   "WHERE order_status = 'delivered' GROUP BY customer_state")


class Ctx:
    """Per-call context: silver, gold and marts over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return testdata.load_silver(self.spark, self.sf_dir)

    @cached_property
    def gold(self) -> Gold:
        return Gold(self.silver)

    @cached_property
    def marts(self) -> Marts:
        return Marts.of(self.gold)


# The ingestion time of the registered query's run.
AS_OF = dt.datetime(2024, 1, 15, 8, 30, tzinfo=dt.timezone.utc)

# Columns of the cohort matrices: the months since a customer's first order that seven years hold;
# what lies beyond stands in the column ``later_months``.
COHORT_MONTHS = range(84)

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: Callable[[Ctx], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_double_money(fn(Ctx(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return register


# ======================================================================= S
@query("csv_scan_raw")
def _csv_scan_raw(c: Ctx) -> DataFrame:
    """Silver orders written as CSV, scanned back with the given schema."""
    df = c.silver["orders"]
    path = sinks.scratch_path(c.spark, "raw_orders") + ".csv"
    sinks.write_csv(df, path)
    return files.read_csv_raw(c.spark, path, schema=df.schema)


@query("csv_scan_bronze")
def _csv_scan_bronze(c: Ctx) -> DataFrame:
    """Bronze CSV read as strings, then cast to the item contract types."""
    df = c.silver["order_items"]
    path = sinks.scratch_path(c.spark, "bronze_items")
    sinks.write_csv(df, path)
    return quality.cast_to_contract(files.read_csv_bronze(c.spark, path), "order_items")


@query("parquet_scan_silver")
def _parquet_scan_silver(c: Ctx) -> DataFrame:
    """S3: silver payments written as partitioned Parquet and scanned back."""
    df = c.silver["order_payments"].withColumns(
        {"ingestion_year": F.lit(2024), "ingestion_month": F.lit(1)})
    path = sinks.scratch_path(c.spark, "silver_payments")
    sinks.write_parquet_partitioned(df, path)
    return files.read_parquet(c.spark, path).drop("ingestion_year", "ingestion_month")


@query("parquet_scan_gold")
def _parquet_scan_gold(c: Ctx) -> DataFrame:
    """Gold fact_orders written as Parquet, scanned back with a pushed filter."""
    path = sinks.scratch_path(c.spark, "gold_fact_orders")
    sinks.write_parquet(c.gold.fact_orders, path)
    return files.read_parquet(c.spark, path).where(F.col("order_status") != marts.CANCELED) \
        .select("order_id", "customer_state", "total_payment")


@query("csv_sink")
def _csv_sink(c: Ctx) -> DataFrame:
    """The customer dimension round-tripped through the CSV sink."""
    df = c.gold.dim_customers
    path = sinks.scratch_path(c.spark, "dim_customers_csv")
    sinks.write_csv(df, path)
    return files.read_csv_bronze(c.spark, path, schema=df.schema)


@query("parquet_sink_partitioned")
def _parquet_sink_partitioned(c: Ctx) -> DataFrame:
    """Items partitioned by ship year/month; partition columns come back as int."""
    df = c.silver["order_items"].withColumns({
        "ingestion_year": F.year("shipping_limit_date"),
        "ingestion_month": F.month("shipping_limit_date")})
    path = sinks.scratch_path(c.spark, "items_partitioned")
    sinks.write_parquet_partitioned(df, path)
    return files.read_parquet(c.spark, path)


@query("parquet_sink")
def _parquet_sink(c: Ctx) -> DataFrame:
    """fact_order_items round-tripped through the Parquet sink."""
    path = sinks.scratch_path(c.spark, "fact_order_items")
    sinks.write_parquet(c.gold.fact_order_items, path)
    return files.read_parquet(c.spark, path)


# Embedded in-memory Derby runs inside the driver JVM: no server, no port.
JDBC_URL = "jdbc:derby:memory:mercato;create=true"
JDBC_PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@query("jdbc_sink")
def _jdbc_sink(c: Ctx) -> DataFrame:
    """The seller dimension written over JDBC (overwrite) and read back."""
    from mercato.sources.sql import read_jdbc
    sinks.write_jdbc(c.gold.dim_sellers, JDBC_URL, "DIM_SELLERS", JDBC_PROPS, num_partitions=4)
    back = read_jdbc(c.spark, JDBC_URL, "DIM_SELLERS", JDBC_PROPS)
    return back.toDF(*[n.lower() for n in back.columns])


@query("sql_source")
def _sql_source(c: Ctx) -> DataFrame:
    """SQL text over registered gold views."""
    register_views({"fact_orders": c.gold.fact_orders})
    return sql_source(c.spark, SQL_SOURCE_TEXT)


@query("write_verify")
def _write_verify(c: Ctx) -> DataFrame:
    """Expected vs read-back row counts of a verified Parquet write."""
    path = sinks.scratch_path(c.spark, "verified_fact_orders")
    counts = sinks.write_verified(c.gold.fact_orders, lambda d: sinks.write_parquet(d, path),
                                  lambda: files.read_parquet(c.spark, path))
    written = files.read_parquet(c.spark, path)
    return written.agg(F.count(F.lit(1)).alias("written_rows")) \
        .withColumn("expected_rows", F.lit(counts["expected_rows"]).cast("bigint"))


@query("row_count_probe")
def _row_count_probe(c: Ctx) -> DataFrame:
    """Row counts of the gold tables (with D34's one-job union)."""
    return serving.table_counts(c.gold.tables())


# ======================================================================= Q
def _messy(name: str) -> str:
    return f" {name.replace('_', ' ').title()}($) "


@query("normalize_columns")
def _normalize_columns(c: Ctx) -> DataFrame:
    """Q1: customers with messy headers, normalised back to snake_case."""
    df = c.silver["customers"]
    messy = df.toDF(*[_messy(n) for n in df.columns])
    return quality.normalize_columns(messy)


@query("ingestion_metadata")
def _ingestion_metadata(c: Ctx) -> DataFrame:
    """Q2: ingestion columns of a run whose context carries its one timestamp."""
    run = pipeline.RunContext(AS_OF)
    return quality.add_ingestion_metadata(c.silver["sellers"], run.as_of)


@query("dedup_full_row")
def _dedup_full_row(c: Ctx) -> DataFrame:
    """Q3: full-row dedup of payment (order, type) pairs."""
    return quality.dedup_full_row(c.silver["order_payments"].select("order_id", "payment_type"))


@query("null_profile")
def _null_profile(c: Ctx) -> DataFrame:
    """Q4: null count/percent of every silver order column in one aggregate."""
    return quality.null_profile(c.silver["orders"])


@query("non_empty_guard")
def _non_empty_guard(c: Ctx) -> DataFrame:
    """Q5: emptiness flags of the silver customers (limit-1 probes)."""
    return quality.emptiness_flags(c.silver["customers"])


@query("rename_typos")
def _rename_typos(c: Ctx) -> DataFrame:
    """Q6: products with the two misspelt headers, renamed to the contract."""
    df = c.silver["products"].withColumnsRenamed({
        "product_name_length": "product_name_lenght",
        "product_description_length": "product_description_lenght"})
    return quality.rename_typos(df, "products")


@query("schema_contract")
def _schema_contract(c: Ctx) -> DataFrame:
    """Q7: payments with a missing, an extra, an uncastable and a null column held against the contract."""
    df = c.silver["order_payments"].drop("payment_installments").withColumns({
        "payment_type": F.when(F.col("order_id") % 11 != 0, F.col("payment_type")),
        "payment_value": F.when(F.col("order_id") % 7 == 0, "n/a").otherwise(F.col("payment_value").cast("string")),
        "channel": F.lit("web")})
    return quality.contract_findings(df, "order_payments")


@query("cast_to_contract")
def _cast_to_contract(c: Ctx) -> DataFrame:
    """Q8: payments as text, cast to the contract types (bad text -> null)."""
    df = c.silver["order_payments"]
    as_text = df.select(*[F.col(n).cast("string").alias(n) for n in df.columns])
    return quality.cast_to_contract(as_text, "order_payments")


@query("drop_strict_nulls")
def _drop_strict_nulls(c: Ctx) -> DataFrame:
    """Q9: customers without rows that miss a strict column (null city)."""
    return quality.drop_strict_nulls(c.silver["customers"], "customers")


@query("optional_null_profile")
def _optional_null_profile(c: Ctx) -> DataFrame:
    """Q10: null profile of the optional order columns."""
    return quality.optional_null_profile(c.silver["orders"], "orders")


@query("dedup_by_key")
def _dedup_by_key(c: Ctx) -> DataFrame:
    """Q11: items unique on (order_id, order_item_id) with a total tie-break."""
    return conform.dedup_items(c.silver["order_items"])


@query("order_date_flags")
def _order_date_flags(c: Ctx) -> DataFrame:
    """Q12: the three date flags per order."""
    return conform.order_date_flags(c.silver["orders"]).select("order_id", *conform.DATE_FLAGS)


@query("invalid_date_count")
def _invalid_date_count(c: Ctx) -> DataFrame:
    """Q13: orders with any date flag."""
    return conform.invalid_date_count(conform.order_date_flags(c.silver["orders"]))


@query("financial_flag")
def _financial_flag(c: Ctx) -> DataFrame:
    """Q14: per-order totals and the financial consistency flag."""
    s = c.silver
    out = conform.financial_flag(conform.dedup_orders(s["orders"]), s["order_payments"],
                                 conform.dedup_items(s["order_items"]))
    return out.select("order_id", "total_payment", "total_items", "total_freight",
                      "total_items_freight", "flag_financial_inconsistency")


@query("customer_rules")
def _customer_rules(c: Ctx) -> DataFrame:
    """Q15: zip range and unknown city/state."""
    return conform.customer_rules(c.silver["customers"])


@query("invalid_zip_count")
def _invalid_zip_count(c: Ctx) -> DataFrame:
    """Q15 count: customers whose zip was nulled."""
    return conform.invalid_zip_count(conform.customer_rules(c.silver["customers"]))


@query("delivery_measures")
def _delivery_measures(c: Ctx) -> DataFrame:
    """Q16: delivery and estimate days, delayed flag and delay days."""
    return conform.delivery_measures(c.silver["orders"]).select(
        "order_id", "delivery_days", "estimated_delivery_days", "flag_delayed", "delay_days")


@query("default_category")
def _default_category(c: Ctx) -> DataFrame:
    """Q17: English category per product, ``uncategorized`` when untranslated."""
    return c.gold.dim_products.select("product_id", "product_category_name",
                                      "product_category_name_english")


@query("item_total_value")
def _item_total_value(c: Ctx) -> DataFrame:
    """Q18: item price + freight."""
    return c.gold.fact_order_items.select("order_id", "order_item_id", "price", "freight_value",
                                          "total_value")


@query("period_label")
def _period_label(c: Ctx) -> DataFrame:
    """Q19: YYYY-MM labels of every purchase month."""
    months = c.gold.fact_orders.select(F.year("order_purchase_timestamp").alias("year"),
                                       F.month("order_purchase_timestamp").alias("month")).distinct()
    return months.withColumn("period", period_label("year", "month"))


@query("id_abbreviation")
def _id_abbreviation(c: Ctx) -> DataFrame:
    """Q20: short seller ids."""
    return c.gold.dim_sellers.select("seller_id", id_abbreviation("seller_id").alias("seller_short"))


@query("scalar_dates")
def _scalar_dates(c: Ctx) -> DataFrame:
    """Date functions used across the pipeline, applied to every order."""
    ts = F.col("order_purchase_timestamp")
    return c.silver["orders"].select(
        "order_id",
        F.to_date(ts).alias("purchase_date"),
        F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"), F.weekofyear(ts).alias("week"),
        F.quarter(ts).alias("quarter"), F.dayofweek(ts).alias("day_of_week"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
        F.datediff(F.col("order_estimated_delivery_date"), ts).alias("estimate_days"),
        F.months_between(F.trunc(F.col("order_estimated_delivery_date"), "MM"),
                         F.trunc(ts, "MM")).cast("int").alias("estimate_months"),
    )


@query("scalar_strings")
def _scalar_strings(c: Ctx) -> DataFrame:
    """String functions used across the pipeline, applied to every seller."""
    s = c.gold.dim_sellers
    return s.select(
        "seller_id",
        F.lower(F.trim(F.col("seller_city"))).alias("city_lower"),
        F.regexp_replace(F.lower(F.col("seller_state")), "[^a-z0-9]+", "_").alias("state_slug"),
        F.lpad(F.col("seller_zip_code_prefix").cast("string"), 5, "0").alias("zip5"),
        F.coalesce(F.col("seller_city"), F.lit("unknown")).alias("city_or_unknown"),
        id_abbreviation("seller_id", 3).alias("seller_short3"),
    )


# ======================================================================= F
@query("period_filter")
def _period_filter(c: Ctx) -> DataFrame:
    """monthly revenue rows inside an inclusive period range."""
    return serving.period_filter(c.marts.metrics_revenue, PERIOD_START, PERIOD_END)


@query("abc_class_filter")
def _abc_class_filter(c: Ctx) -> DataFrame:
    """F8: ABC detail of one class."""
    return serving.abc_class_filter(c.marts.metrics_abc, ABC_FILTER_CLASS)


# ======================================================================= J
@query("join_left_preagg")
def _join_left_preagg(c: Ctx) -> DataFrame:
    """Orders left-joined with pre-aggregated payment totals."""
    orders = conform.dedup_orders(c.silver["orders"]).select("order_id", "order_status")
    return orders.join(conform.payments_per_order(c.silver["order_payments"]), "order_id", "left")


@query("join_left_broadcast")
def _join_left_broadcast(c: Ctx) -> DataFrame:
    """Products left-joined with the (small) category translation."""
    p = c.silver["products"].select("product_id", "product_category_name")
    return p.join(c.silver["category_translation"], "product_category_name", "left")


@query("join_semi_valid_orders")
def _join_semi_valid_orders(c: Ctx) -> DataFrame:
    """Item rows of non-canceled orders (left-semi join)."""
    return marts.items_of_valid_orders(c.gold.fact_order_items, c.gold.fact_orders)


@query("join_fanout_reviews")
def _join_fanout_reviews(c: Ctx) -> DataFrame:
    """Each review once per item of its order."""
    return marts.review_item_rows(c.gold.reviews, c.gold.fact_order_items)


@query("first_purchase_window")
def _first_purchase_window(c: Ctx) -> DataFrame:
    """Every order with its customer's first purchase instant."""
    return marts.first_purchase(c.gold.fact_orders)


# ======================================================================= A
@query("payments_per_order")
def _payments_per_order(c: Ctx) -> DataFrame:
    return conform.payments_per_order(c.silver["order_payments"])


@query("items_per_order")
def _items_per_order(c: Ctx) -> DataFrame:
    return conform.items_per_order(conform.dedup_items(c.silver["order_items"]))


for _name in Marts.NAMES:
    query(_name)(lambda c, _n=_name: getattr(c.marts, _n))


@query("customer_ltv")
def _customer_ltv(c: Ctx) -> DataFrame:
    return marts.customer_ltv(c.gold.fact_orders)


@query("metrics_revenue_exact")
def _metrics_revenue_exact(c: Ctx) -> DataFrame:
    """A3 with exact median and p90 (range counting instead of the sketch)."""
    return marts.metrics_revenue_exact(c.gold.fact_orders)


@query("repurchase_rate")
def _repurchase_rate(c: Ctx) -> DataFrame:
    return marts.repurchase_rate(c.gold.fact_orders)


@query("product_revenue")
def _product_revenue(c: Ctx) -> DataFrame:
    return marts.product_revenue(c.gold.fact_order_items, c.gold.fact_orders)


@query("revenue_grand_total")
def _revenue_grand_total(c: Ctx) -> DataFrame:
    return marts.revenue_grand_total(c.gold.fact_order_items, c.gold.fact_orders)


@query("abc_class_counts")
def _abc_class_counts(c: Ctx) -> DataFrame:
    return marts.abc_class_counts(c.marts.metrics_abc)


# ======================================================================= M
for _name in ("dim_customers", "dim_products", "dim_sellers", "dim_dates", "fact_orders",
              "fact_order_items"):
    query(_name)(lambda c, _n=_name: getattr(c.gold, _n))


# ======================================================================= W
@query("global_rank")
def _global_rank(c: Ctx) -> DataFrame:
    """Rank of every product by revenue (ties by product id)."""
    return marts.ranked_products(c.gold.fact_order_items, c.gold.fact_orders) \
        .select("product_id", "total_revenue", "rank")


@query("running_share")
def _running_share(c: Ctx) -> DataFrame:
    """Running revenue and cumulative share in rank order."""
    r = marts.ranked_products(c.gold.fact_order_items, c.gold.fact_orders)
    return r.select("product_id", "rank", "running_revenue",
                    (F.col("running_revenue").cast("double") /
                     F.col("grand_total").cast("double") * 100).alias("cumulative_revenue_pct"))


# ======================================================================= D
def _m(c: Ctx) -> Marts:
    return c.marts


_D: dict[str, Callable[[Ctx], DataFrame]] = {
    "overview_kpis": lambda c: serving.overview_kpis(_m(c).metrics_revenue, _m(c).metrics_delivery),
    "overview_monthly_revenue": lambda c: serving.overview_monthly_revenue(_m(c).metrics_revenue),
    "overview_top_states": lambda c: serving.overview_top_states(_m(c).metrics_revenue_by_state),
    "overview_order_status": lambda c: serving.overview_order_status(c.gold.fact_orders),
    "overview_nps_series": lambda c: serving.overview_nps_series(_m(c).metrics_reviews),
    "revenue_periods": lambda c: serving.revenue_periods(_m(c).metrics_revenue),
    "revenue_period_kpis": lambda c: serving.revenue_period_kpis(
        _m(c).metrics_revenue, PERIOD_START, PERIOD_END),
    "revenue_period_series": lambda c: serving.revenue_period_series(
        _m(c).metrics_revenue, PERIOD_START, PERIOD_END),
    "revenue_growth_sign": lambda c: serving.revenue_growth_sign(_m(c).metrics_revenue),
    "revenue_state_map": lambda c: serving.revenue_state_map(_m(c).metrics_revenue_by_state),
    "revenue_top_categories": lambda c: serving.revenue_top_categories(
        _m(c).metrics_revenue_by_category),
    "cancellation_series": lambda c: serving.cancellation_series(_m(c).metrics_cancellations),
    "revenue_raw": lambda c: serving.revenue_raw(_m(c).metrics_revenue),
    "logistics_kpis": lambda c: serving.logistics_kpis(_m(c).metrics_delivery),
    "logistics_days_series": lambda c: serving.logistics_days_series(_m(c).metrics_delivery),
    "logistics_delay_series": lambda c: serving.logistics_delay_series(_m(c).metrics_delivery),
    "logistics_by_state": lambda c: serving.logistics_by_state(_m(c).metrics_delivery_by_state),
    "logistics_slowest_states": lambda c: serving.logistics_slowest_states(
        _m(c).metrics_delivery_by_state),
    "logistics_most_delayed_states": lambda c: serving.logistics_most_delayed_states(
        _m(c).metrics_delivery_by_state),
    "reviews_kpis": lambda c: serving.reviews_kpis(_m(c).metrics_reviews),
    "reviews_monthly": lambda c: serving.reviews_monthly(_m(c).metrics_reviews),
    "nps_distribution": lambda c: serving.nps_distribution(_m(c).metrics_reviews),
    "reviews_top_categories": lambda c: serving.reviews_top_categories(
        _m(c).metrics_reviews_by_category),
    "reviews_raw": lambda c: serving.reviews_raw(_m(c).metrics_reviews),
    "customer_kpis": lambda c: serving.customer_kpis(_m(c).metrics_customers),
    "recurrent_customers": lambda c: serving.recurrent_customers(c.gold.fact_orders),
    "customer_series": lambda c: serving.customer_series(_m(c).metrics_customers),
    "cohort_matrix": lambda c: serving.cohort_matrix(_m(c).metrics_cohort, COHORT_MONTHS),
    "cohort_retention_pct": lambda c: serving.cohort_retention_pct(
        _m(c).metrics_cohort, COHORT_MONTHS),
    "top_sellers": lambda c: serving.top_sellers(_m(c).metrics_revenue_by_seller,
                                                 c.gold.dim_sellers),
    "top_categories_by_volume": lambda c: serving.top_categories_by_volume(
        _m(c).metrics_revenue_by_category),
    "abc_summary": lambda c: serving.abc_summary(_m(c).metrics_abc),
    "abc_detail": lambda c: serving.abc_detail(_m(c).metrics_abc),
    "table_counts": lambda c: serving.table_counts({
        k: v for k, v in c.gold.tables().items()
        if k in ("fact_orders", "fact_order_items", "dim_customers", "dim_products",
                 "dim_sellers")}),
    "flag_summary": lambda c: serving.flag_summary(c.gold.fact_orders),
    "flag_percentages": lambda c: serving.flag_percentages(c.gold.fact_orders),
    "schema_catalog": lambda c: serving.schema_catalog(c.spark, c.gold.fact_orders),
    "adhoc_select": lambda c: (register_views({"fact_orders": c.gold.fact_orders}),
                               serving.adhoc_select(c.spark, ADHOC_SQL))[1],
    "sellers_raw": lambda c: serving.sellers_raw(_m(c).metrics_revenue_by_seller),
    "cohort_raw": lambda c: serving.cohort_raw(_m(c).metrics_cohort),
}
for _name, _fn in _D.items():
    query(_name)(_fn)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)
