"""Report queries over the aggregates, the metric log and the streamed sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import MONEY, display_amount, display_count, exact_average, or_zero
from tillwright.operators.enrich import PRODUCT_FACTS, add_facts
from tillwright.session import cut

# Sums of the stored sums; wide enough for any number of store-days or products.
GRAND_TOTAL = "decimal(30,2)"


def _store_day_totals() -> dict:
    return {
        "total_revenue": F.sum("total_revenue").cast(GRAND_TOTAL),
        "total_orders": F.sum("total_orders"),
        "total_items_sold": F.sum("total_items_sold"),
    }


def batch_kpis(daily: DataFrame) -> DataFrame:
    """One row of totals, zeros if there are no store-days; the basket is revenue over orders."""
    sums = daily.agg(*[c.alias(n) for n, c in _store_day_totals().items()])
    return sums.select(
        or_zero(F.col("total_revenue"), GRAND_TOTAL).alias("total_revenue"),
        or_zero(F.col("total_orders"), "bigint").alias("total_orders"),
        or_zero(F.col("total_items_sold"), "bigint").alias("total_items_sold"),
        or_zero(exact_average(F.col("total_revenue"), F.col("total_orders")), MONEY).alias("average_basket"),
    )


def kpi_display(kpis: DataFrame) -> DataFrame:
    """Totals as the text a report shows."""
    return kpis.select(
        display_amount(F.col("total_revenue")).alias("total_revenue"),
        display_count(F.col("total_orders")).alias("total_orders"),
        display_count(F.col("total_items_sold")).alias("total_items_sold"),
        display_amount(F.col("average_basket")).alias("average_basket"),
    )


def daily_sales(daily: DataFrame) -> DataFrame:
    """Totals and weighted basket of every day, in order of the day."""
    return (
        daily.groupBy("sale_date")
        .agg(*[c.alias(n) for n, c in _store_day_totals().items()])
        .withColumn("average_basket", exact_average(F.col("total_revenue"), F.col("total_orders")))
        .orderBy("sale_date")
    )


def city_sales(daily: DataFrame) -> DataFrame:
    """Revenue and orders per city, highest revenue first; sales without a city form one group."""
    totals = _store_day_totals()
    return (
        daily.groupBy("city")
        .agg(totals["total_revenue"].alias("total_revenue"), totals["total_orders"].alias("total_orders"))
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("city"))
    )


def _by_category(performance: DataFrame) -> DataFrame:
    return performance.groupBy("category").agg(
        F.sum("total_revenue").cast(GRAND_TOTAL).alias("total_revenue"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
    )


def category_sales(performance: DataFrame) -> DataFrame:
    """Revenue and quantity per category, highest revenue first."""
    return _by_category(performance).orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("category"))


def category_revenue_share(performance: DataFrame) -> DataFrame:
    """Share of each category in all revenue, from 0 to 1 with eight decimals.

    The grand total is a scalar subquery, so no single task sees all categories.
    """
    categories = _by_category(performance)
    grand = categories.agg(F.sum("total_revenue").cast(GRAND_TOTAL)).scalar()
    share = F.col("total_revenue").cast("double") / F.nullif(grand.cast("double"), F.lit(0.0))
    return categories.select("category", "total_revenue", F.round(share, 8).alias("revenue_share"))


def top_products(performance: DataFrame, products: DataFrame | None = None, n: int = 10) -> DataFrame:
    """The ``n`` products of highest revenue; equal revenue is ordered by product id.

    ``performance`` has the facts of each product, or, to look up those of the ``n`` alone, they
    come from ``products``.
    """
    order = [F.desc_nulls_first("total_revenue"), F.col("product_id")]
    best = performance.orderBy(*order).limit(n)
    if products is not None:
        best = add_facts(best, _matching(products, best, "product_id", n), "product_id", PRODUCT_FACTS).orderBy(*order)
    return best.select("product_name", "category", "total_revenue", "total_quantity_sold", "number_of_orders")


def recent_metrics(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest metric rows, newest first."""
    return metrics.orderBy(F.desc("metric_timestamp"), F.desc("metric_key")).limit(n)


def metrics_series(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest metric rows in order of time."""
    return recent_metrics(metrics, n).orderBy("metric_timestamp", "metric_key")


def latest_metrics(metrics: DataFrame) -> DataFrame:
    return recent_metrics(metrics, 1)


def latest_metrics_display(metrics: DataFrame) -> DataFrame:
    return latest_metrics(metrics).select(
        display_amount(F.col("total_revenue")).alias("total_revenue"),
        display_count(F.col("total_orders")).alias("total_orders"),
        display_amount(F.col("average_basket")).alias("average_basket"),
    )


#: A dimension is reduced by a broadcast of the keys of a top-n up to this length, and by a plain join beyond.
BROADCAST_ROWS = 10_000


def _matching(dimension: DataFrame, few: DataFrame, key: str, n: int = BROADCAST_ROWS) -> DataFrame:
    """Dimension rows that the ``n`` rows of ``few`` refer to."""
    keys = few.select(key).distinct()
    return dimension.join(F.broadcast(keys) if n <= BROADCAST_ROWS else keys, key, "left_semi")


def recent_stream_sales(sales: DataFrame, products: DataFrame, stores: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest streamed sales with product and store, newest first.

    The newest rows are picked before any join and evaluated once. A dimension is reduced to the
    rows they refer to, so it is neither shuffled nor broadcast whole, whatever its size.
    """
    newest = cut(sales.orderBy(F.desc("ingestion_timestamp"), F.desc("sale_id")).limit(n))
    with_product = add_facts(newest, _matching(products, newest, "product_id", n), "product_id",
                             ("product_name", "category"))
    return (
        add_facts(with_product, _matching(stores, newest, "store_id", n), "store_id", ("store_name", "city"))
        .orderBy(F.desc("ingestion_timestamp"), F.desc("sale_id"))
        .select("sale_id", "sale_timestamp", "product_name", "category", "store_name", "city",
                "quantity", "total_amount", "payment_method")
    )


def recent_by_sale_time(sales: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` newest streamed sales by business time."""
    return sales.orderBy(F.desc("sale_timestamp"), F.desc("sale_id")).limit(n)
