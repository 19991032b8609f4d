"""Store-day and product aggregates.

Dimension facts depend on the grouping key alone, so sales are reduced by key first, with
map-side combine, and the facts are joined to the few reduced rows. A hot store or product is
reduced in every task before it is shuffled.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import exact_average, total
from tillwright.operators.enrich import PRODUCT_FACTS, STORE_FACTS, add_facts
from tillwright.schemas import DAILY_SALES_SUMMARY, PRODUCT_PERFORMANCE

OrderCount = Literal["distinct", "rows"]


def _orders(order_count: OrderCount) -> Column:
    """``rows`` equals ``distinct`` where ``sale_id`` is unique, and spares its second shuffle."""
    if order_count == "distinct":
        return F.count_distinct("sale_id")
    return F.count("sale_id")


def _signed(sign: str | None) -> Column:
    return F.count("sale_id") if sign is None else F.sum(sign).cast("bigint")


def daily_totals(sales: DataFrame, sign: str | None = None) -> DataFrame:
    """Revenue, orders and items of every store and day; ``sign`` names a column that counts a sale as +1 or -1."""
    return sales.groupBy("sale_date", "store_id").agg(
        total(F.col("total_amount")).alias("total_revenue"), _signed(sign).alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"))


def with_basket(totals: DataFrame) -> DataFrame:
    return totals.withColumn("average_basket", exact_average(F.col("total_revenue"), F.col("total_orders")))


def store_days(sales: DataFrame, order_count: OrderCount = "distinct") -> DataFrame:
    return (
        sales.groupBy("sale_date", "store_id")
        .agg(
            total(F.col("total_amount")).alias("total_revenue"),
            _orders(order_count).alias("total_orders"),
            F.sum("quantity").alias("total_items_sold"),
            F.count("total_amount").alias("_priced"),
        )
        .withColumn("average_basket", exact_average(F.col("total_revenue"), F.col("_priced")))
        .drop("_priced")
    )


def daily_sales_summary(sales: DataFrame, stores: DataFrame, order_count: OrderCount = "distinct") -> DataFrame:
    """Revenue, orders, items and average basket of every store and day.

    ``sales`` needs ``sale_date``; store facts are taken from ``stores``.
    """
    return add_facts(store_days(sales, order_count), stores, "store_id", STORE_FACTS).select(
        *DAILY_SALES_SUMMARY.names
    )


def product_totals(sales: DataFrame, order_count: OrderCount = "distinct", sign: str | None = None) -> DataFrame:
    """Revenue, quantity and orders of every product; with ``sign`` as in ``daily_totals``."""
    return sales.groupBy("product_id").agg(
        total(F.col("total_amount")).alias("total_revenue"),
        F.sum("quantity").alias("total_quantity_sold"),
        (_signed(sign) if sign else _orders(order_count)).alias("number_of_orders"),
    )


def product_performance(sales: DataFrame, products: DataFrame, order_count: OrderCount = "distinct") -> DataFrame:
    """Revenue, quantity and orders of every product."""
    reduced = product_totals(sales, order_count)
    return add_facts(reduced, products, "product_id", PRODUCT_FACTS).select(*PRODUCT_PERFORMANCE.names)
