"""Lazy containers wiring silver -> gold -> marts.

``Gold`` and ``Marts`` only compose DataFrames; nothing runs until an action.
The pipeline (``plans.pipeline``) materialises the same frames as tables so
later stages read them back instead of recomputing the lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from mercato.operators import marts, star


class Gold:
    """Gold dimensions and facts built from canonical silver DataFrames."""

    def __init__(self, silver: dict[str, DataFrame]):
        self.silver = silver

    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.silver["customers"])

    @cached_property
    def dim_products(self) -> DataFrame:
        return star.dim_products(self.silver["products"], self.silver["category_translation"])

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return star.dim_sellers(self.silver["sellers"])

    @cached_property
    def dim_dates(self) -> DataFrame:
        return star.dim_dates(self.silver["orders"])

    @cached_property
    def fact_orders(self) -> DataFrame:
        s = self.silver
        return star.fact_orders(s["orders"], s["customers"], s["order_payments"], s["order_items"])

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return star.fact_order_items(self.silver["order_items"], self.dim_products,
                                     self.dim_sellers)

    @property
    def reviews(self) -> DataFrame:
        return self.silver["order_reviews"]

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.dim_customers,
            "dim_products": self.dim_products,
            "dim_sellers": self.dim_sellers,
            "dim_dates": self.dim_dates,
            "fact_orders": self.fact_orders,
            "fact_order_items": self.fact_order_items,
        }


class Marts:
    """The metric marts over a set of gold tables (plus silver reviews)."""

    def __init__(self, fact_orders: DataFrame, fact_order_items: DataFrame, reviews: DataFrame,
                 abc_buckets: int | None = None, item_rollup: DataFrame | None = None):
        self.fo = fact_orders
        self.foi = fact_order_items
        self.reviews = reviews
        self.abc_buckets = abc_buckets
        self._item_rollup = item_rollup

    @cached_property
    def item_rollup(self) -> DataFrame:
        """Valid item rows per (product, category, seller, state), shared by three marts."""
        if self._item_rollup is not None:
            return self._item_rollup
        return marts.valid_item_rollup(self.foi, self.fo)

    @classmethod
    def of(cls, gold: Gold, abc_buckets: int | None = None) -> "Marts":
        return cls(gold.fact_orders, gold.fact_order_items, gold.reviews, abc_buckets)

    @cached_property
    def metrics_revenue(self) -> DataFrame:
        return marts.metrics_revenue(self.fo)

    @cached_property
    def metrics_revenue_by_state(self) -> DataFrame:
        return marts.metrics_revenue_by_state(self.fo)

    @cached_property
    def metrics_revenue_by_category(self) -> DataFrame:
        return marts.metrics_revenue_by_category(self.foi, self.fo, self.item_rollup)

    @cached_property
    def metrics_revenue_by_seller(self) -> DataFrame:
        return marts.metrics_revenue_by_seller(self.foi, self.fo, self.item_rollup)

    @cached_property
    def metrics_delivery(self) -> DataFrame:
        return marts.metrics_delivery(self.fo)

    @cached_property
    def metrics_delivery_by_state(self) -> DataFrame:
        return marts.metrics_delivery_by_state(self.fo)

    @cached_property
    def metrics_cancellations(self) -> DataFrame:
        return marts.metrics_cancellations(self.fo)

    @cached_property
    def metrics_reviews(self) -> DataFrame:
        return marts.metrics_reviews(self.reviews, self.fo)

    @cached_property
    def metrics_reviews_by_category(self) -> DataFrame:
        return marts.metrics_reviews_by_category(self.reviews, self.foi)

    @cached_property
    def metrics_customers(self) -> DataFrame:
        return marts.metrics_customers(self.fo)

    @cached_property
    def metrics_cohort(self) -> DataFrame:
        return marts.metrics_cohort(self.fo)

    @cached_property
    def metrics_abc(self) -> DataFrame:
        return marts.metrics_abc(self.foi, self.fo, self.abc_buckets, self.item_rollup)

    # The twelve tables a serving layer publishes.
    NAMES = ("metrics_revenue", "metrics_revenue_by_state", "metrics_revenue_by_category",
             "metrics_revenue_by_seller", "metrics_delivery", "metrics_delivery_by_state",
             "metrics_cancellations", "metrics_reviews", "metrics_reviews_by_category",
             "metrics_customers", "metrics_cohort", "metrics_abc")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}
