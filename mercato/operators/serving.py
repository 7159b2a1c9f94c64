"""Read-side dashboard queries (D1-D40) over gold tables and marts.

Each function takes the DataFrames it reads and returns a DataFrame.  Sorting
and top-k happen here (``orderBy(...).limit(k)`` plans as
``TakeOrderedAndProject``: a per-partition top-k, then a merge of k rows per
partition).  Every sort carries a tie-break so results are deterministic.
Labels, ratios, pivots and re-sorts that a dashboard would do client-side
are Spark expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions.scalars import id_abbreviation, period_label, ratio


# One-row KPIs that average doubles are rounded here: the last bits of a
# floating-point sum depend on summation order (i.e. on partitioning), so an
# unrounded value would not be reproducible across layouts or engines.
KPI_DIGITS = 9


def _kpi_avg(col: str | Column) -> Column:
    return F.round(F.avg(col), KPI_DIGITS)


def _label(df: DataFrame) -> DataFrame:
    return df.withColumn("period", period_label("year", "month"))


def _by_month(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first())


def _top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _sign(col: str) -> Column:
    """``positive`` when >= 0; ``negative`` otherwise, including null."""
    return F.when(F.col(col) >= 0, "positive").otherwise("negative")


def period_key(year: int, month: int) -> int:
    return year * 100 + month


def period_filter(monthly: DataFrame, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """inclusive year-month range."""
    key = F.col("year") * 100 + F.col("month")
    return monthly.where(key.between(period_key(*start), period_key(*end)))


# ------------------------------------------------------------------ overview
def overview_kpis(metrics_revenue: DataFrame, metrics_delivery: DataFrame) -> DataFrame:
    """D1 in one aggregate: the two marts are stacked, not joined."""
    rev = metrics_revenue.select("total_revenue", "total_orders",
                                 F.lit(None).cast("double").alias("delay_rate_pct"))
    dly = metrics_delivery.select(F.lit(None).cast(metrics_revenue.schema["total_revenue"].dataType)
                                  .alias("total_revenue"),
                                  F.lit(None).cast("bigint").alias("total_orders"),
                                  "delay_rate_pct")
    return rev.unionByName(dly).agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        ratio(F.sum("total_revenue"), F.sum("total_orders")).alias("avg_ticket"),
        _kpi_avg("delay_rate_pct").alias("avg_delay_rate_pct"),
    )


def overview_monthly_revenue(metrics_revenue: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_revenue.select("year", "month", "total_revenue")))


def overview_top_states(metrics_revenue_by_state: DataFrame, k: int = 10) -> DataFrame:
    return _top(metrics_revenue_by_state.select("customer_state", "total_revenue"), k,
                F.col("total_revenue").desc_nulls_last(), F.col("customer_state").asc_nulls_first())


def overview_order_status(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("total")) \
        .orderBy(F.col("total").desc(), F.col("order_status").asc_nulls_first())


def overview_nps_series(metrics_reviews: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_reviews.select("year", "month", "nps")))


# ------------------------------------------------------------------ revenue
def revenue_periods(metrics_revenue: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_revenue.select("year", "month").distinct()))


def revenue_period_kpis(metrics_revenue: DataFrame, start: tuple[int, int],
                        end: tuple[int, int]) -> DataFrame:
    return period_filter(metrics_revenue, start, end).agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        ratio(F.sum("total_revenue"), F.sum("total_orders")).alias("avg_ticket"),
        _kpi_avg(F.col("median_order_value").cast("double")).alias("median_ticket"),
        _kpi_avg(F.col("p90_order_value").cast("double")).alias("p90_ticket"),
    )


def revenue_period_series(metrics_revenue: DataFrame, start: tuple[int, int],
                          end: tuple[int, int]) -> DataFrame:
    rows = period_filter(metrics_revenue, start, end) \
        .select("year", "month", "total_revenue", "monthly_growth_pct")
    return _label(_by_month(rows))


def revenue_growth_sign(metrics_revenue: DataFrame) -> DataFrame:
    rows = metrics_revenue.select("year", "month", "monthly_growth_pct") \
        .withColumn("growth_sign", _sign("monthly_growth_pct"))
    return _label(_by_month(rows))


def revenue_state_map(metrics_revenue_by_state: DataFrame) -> DataFrame:
    return metrics_revenue_by_state.select("customer_state", "total_revenue", "total_orders") \
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("customer_state").asc_nulls_first())


def revenue_top_categories(metrics_revenue_by_category: DataFrame, k: int = 15) -> DataFrame:
    return _top(metrics_revenue_by_category.select("product_category_name_english",
                                                   "total_revenue"), k,
                F.col("total_revenue").desc_nulls_last(),
                F.col("product_category_name_english").asc_nulls_first())


def cancellation_series(metrics_cancellations: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_cancellations.select(
        "year", "month", "cancellation_rate_pct", "lost_revenue")))


def revenue_raw(metrics_revenue: DataFrame) -> DataFrame:
    return _by_month(metrics_revenue)


# ------------------------------------------------------------------ logistics
def logistics_kpis(metrics_delivery: DataFrame) -> DataFrame:
    return metrics_delivery.agg(
        _kpi_avg("avg_delivery_days").alias("avg_delivery"),
        _kpi_avg("delay_rate_pct").alias("avg_delay"),
        _kpi_avg("sla_compliance_pct").alias("avg_sla"),
        F.sum("total_delayed").alias("total_delayed"),
        F.sum("total_delivered").alias("total_delivered"),
    )


def logistics_days_series(metrics_delivery: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_delivery.select(
        "year", "month", "avg_delivery_days", "avg_estimated_days")))


def logistics_delay_series(metrics_delivery: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_delivery.select("year", "month", "delay_rate_pct")))


_STATE_COLS = ["customer_state", "avg_delivery_days", "delay_rate_pct", "total_delivered"]
def _slowest() -> list[Column]:
    return [F.col("avg_delivery_days").desc_nulls_last(), F.col("customer_state").asc_nulls_first()]


def logistics_by_state(metrics_delivery_by_state: DataFrame) -> DataFrame:
    return metrics_delivery_by_state.select(*_STATE_COLS).orderBy(*_slowest())


def logistics_slowest_states(metrics_delivery_by_state: DataFrame, k: int = 10) -> DataFrame:
    return _top(metrics_delivery_by_state.select(*_STATE_COLS), k, *_slowest())


def logistics_most_delayed_states(metrics_delivery_by_state: DataFrame, k: int = 10) -> DataFrame:
    return _top(metrics_delivery_by_state.select(*_STATE_COLS), k,
                F.col("delay_rate_pct").desc_nulls_last(), *_slowest())


# ------------------------------------------------------------------ reviews
def reviews_kpis(metrics_reviews: DataFrame) -> DataFrame:
    return metrics_reviews.agg(
        _kpi_avg("nps").alias("avg_nps"),
        F.round(ratio(F.sum(F.col("avg_score") * F.col("total_reviews")), F.sum("total_reviews")),
                KPI_DIGITS).alias("avg_score"),
        F.sum("total_reviews").alias("total_reviews"),
        F.sum("promoters").alias("promoters"),
        F.sum("detractors").alias("detractors"),
    )


def reviews_monthly(metrics_reviews: DataFrame) -> DataFrame:
    rows = metrics_reviews.select("year", "month", "nps", "avg_score", "total_reviews") \
        .withColumn("nps_sign", _sign("nps"))
    return _label(_by_month(rows))


def nps_distribution(metrics_reviews: DataFrame) -> DataFrame:
    return metrics_reviews.agg(
        F.sum("promoters").alias("promoters"),
        F.sum("neutrals").alias("neutrals"),
        F.sum("detractors").alias("detractors"),
    )


def reviews_top_categories(metrics_reviews_by_category: DataFrame, k: int = 20) -> DataFrame:
    rows = metrics_reviews_by_category.where(F.col("product_category_name_english").isNotNull()) \
        .select("product_category_name_english", "avg_score", "total_reviews")
    return _top(rows, k, F.col("avg_score").desc_nulls_last(),
                F.col("product_category_name_english").asc())


def reviews_raw(metrics_reviews: DataFrame) -> DataFrame:
    return _by_month(metrics_reviews)


# ------------------------------------------------------------------ customers
def customer_kpis(metrics_customers: DataFrame) -> DataFrame:
    return metrics_customers.agg(
        F.sum("new_customers").alias("total_customers"),
        _kpi_avg("avg_ltv").alias("avg_ltv"),
    )


def recurrent_customers(fact_orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Customer ids with more than one order row, distinct customers, rate to 1 decimal.

    Like the source's ``GROUP BY ... HAVING COUNT(*) > 1`` the null id forms a
    group of its own, while the distinct count ignores it.  One partial
    aggregate per customer (skew-safe), then one global row.
    """
    per_customer = fact_orders.groupBy(customer_key).agg(F.count(F.lit(1)).alias("n"))
    return per_customer.agg(
        F.count_if(F.col("n") > 1).alias("recurrent"),
        F.count(customer_key).alias("total"),
    ).withColumn(
        "rate_pct",
        F.coalesce(F.bround(ratio("recurrent", "total") * 100, 1), F.lit(0.0)),
    )


def customer_series(metrics_customers: DataFrame) -> DataFrame:
    return _label(_by_month(metrics_customers.select("year", "month", "new_customers", "avg_ltv")))


def _pivot_months(df: DataFrame, value_col: str, months: Sequence[int] | None) -> DataFrame:
    """One row per cohort, one column per ``months_since_first`` value.

    Without ``months`` Spark first finds the distinct values (bounded by the calendar span).  With
    ``months`` the columns are fixed and the plan is one aggregate; no cell is lost: those of all
    other months stand in ``later_months`` as ``month=value``, by month, joined by ``;`` (null without any).
    """
    if months is None:
        pivoted = df.groupBy("cohort_month").pivot("months_since_first")
        return pivoted.agg(F.first(value_col)).orderBy("cohort_month")
    month = F.col("months_since_first")
    cells = [F.max(F.when(month == m, F.col(value_col))).alias(str(m)) for m in months]
    text = F.concat(month.cast("string"), F.lit("="), F.col(value_col).cast("decimal(18,6)").cast("string"))
    later = F.sort_array(F.collect_list(F.when(~month.isin(list(months)), F.struct(month.alias("m"), text.alias("text")))))
    # bounded by the calendar span of one cohort
    joined = F.when(F.size(later) > 0, F.array_join(F.transform(later, lambda c: c["text"]), ";"))
    return df.groupBy("cohort_month").agg(*cells, joined.alias("later_months")).orderBy("cohort_month")


def cohort_matrix(metrics_cohort: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    return _pivot_months(metrics_cohort, "customers", months)


def cohort_retention_long(metrics_cohort: DataFrame) -> DataFrame:
    """Customers of each cell over the cohort's month-0 customers x 100.

    The window is per cohort: at most one row per month since the cohort
    started, so its size is bounded by the calendar span.
    """
    month0 = F.max(F.when(F.col("months_since_first") == 0, F.col("customers"))) \
        .over(Window.partitionBy("cohort_month"))
    return metrics_cohort.withColumn("retention_pct", ratio("customers", month0) * 100)


def cohort_retention_pct(metrics_cohort: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    return _pivot_months(cohort_retention_long(metrics_cohort), "retention_pct", months)


def cohort_raw(metrics_cohort: DataFrame) -> DataFrame:
    return metrics_cohort.select("cohort_month", "months_since_first", "customers") \
        .orderBy("cohort_month", "months_since_first")


# ------------------------------------------------------------------ ranking
def top_sellers(metrics_revenue_by_seller: DataFrame, dim_sellers: DataFrame,
                k: int = 10) -> DataFrame:
    joined = metrics_revenue_by_seller.select("seller_id", "total_revenue", "total_orders") \
        .join(dim_sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "inner")
    top = _top(joined, k, F.col("total_revenue").desc_nulls_last(),
               F.col("seller_id").asc_nulls_first())
    return top.select("seller_id", "seller_city", "seller_state", "total_revenue",
                      "total_orders", id_abbreviation("seller_id").alias("seller_short"))


def top_categories_by_volume(metrics_revenue_by_category: DataFrame, k: int = 10) -> DataFrame:
    return _top(metrics_revenue_by_category.select(
        "product_category_name_english", "total_orders", "total_revenue"), k,
        F.col("total_orders").desc_nulls_last(), F.col("total_revenue").desc_nulls_last(),
        F.col("product_category_name_english").asc_nulls_first())


def abc_summary(metrics_abc: DataFrame) -> DataFrame:
    return metrics_abc.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.sum("total_revenue").alias("total_revenue"),
    ).orderBy("abc_class")


def abc_detail(metrics_abc: DataFrame) -> DataFrame:
    return metrics_abc.select(
        "abc_class", "product_id", "product_category_name_english", "total_revenue",
        "total_orders",
        F.round("revenue_pct", 2).alias("revenue_pct"),
        F.round("cumulative_revenue_pct", 2).alias("cumulative_revenue_pct"),
    ).orderBy("abc_class", F.col("total_revenue").desc_nulls_last(), "product_id")


def abc_class_filter(metrics_abc: DataFrame, abc_class: str) -> DataFrame:
    """F8: the ABC detail of one class."""
    return abc_detail(metrics_abc).where(F.col("abc_class") == abc_class)


def sellers_raw(metrics_revenue_by_seller: DataFrame) -> DataFrame:
    return metrics_revenue_by_seller.orderBy(F.col("total_revenue").desc_nulls_last(),
                                             F.col("seller_id").asc_nulls_first())


# ------------------------------------------------------------------ technical
def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; all counts run as one job (a union of aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("table_name"),
                                                             "total")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


FLAG_COLUMNS = {
    "financial_inconsistency": "flag_financial_inconsistency",
    "delayed": "flag_delayed",
    "delivered_before_purchase": "flag_delivered_before_purchase",
    "estimated_before_purchase": "flag_estimated_before_purchase",
    "future_purchase": "flag_future_purchase",
}


def flag_summary(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.agg(
        *[F.sum(F.col(col).cast("int")).alias(name) for name, col in FLAG_COLUMNS.items()],
        F.count(F.lit(1)).alias("total"),
    )


def flag_percentages(fact_orders: DataFrame) -> DataFrame:
    """Long form (flag, occurrences, total, pct) via unpivot of D35."""
    summary = flag_summary(fact_orders)
    long = summary.unpivot("total", list(FLAG_COLUMNS), "flag", "occurrences")
    return long.withColumn("pct", ratio("occurrences", "total") * 100)


def schema_catalog(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column name, type and nullability of a table, in column order, and how many of its rows fill it.

    The names come from the table's schema, the counts from one aggregate over its rows.
    """
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    entries = [
        F.struct(F.lit(i + 1).alias("ordinal_position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
                 F.col("__rows").alias("total_rows"), F.col(f"c{i}").alias("filled_rows"))
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


class NotAQueryError(ValueError):
    """Raised when ad-hoc SQL is a command (DDL/DML/SET...) rather than a query."""


def adhoc_select(spark: SparkSession, sql: str) -> DataFrame:
    """Run free SQL only when it is a read-only query.

    ``spark.sql`` executes commands eagerly, so the text is first checked
    without running it: it must also be valid as a subquery
    (``SELECT * FROM (<text>)``), which only queries are (SELECT, WITH,
    VALUES, TABLE, set operations).  DDL, DML, SET and CACHE fail that parse.
    A prefix test (the source dashboard's) would accept ``SELECT``-looking
    text that is not a single query and refuse ``WITH`` queries.
    """
    text = sql.strip().rstrip(";")
    try:
        spark.sql(f"SELECT * FROM ({text}) AS adhoc_q")  # analysed, not executed
    except Exception as exc:  # parse or analysis error: not a single query
        raise NotAQueryError(f"only single read-only queries are allowed: {exc}") from exc
    return spark.sql(text)
