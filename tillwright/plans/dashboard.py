"""The frames a sales dashboard shows, over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwright import schemas
from tillwright.operators import reports
from tillwright.plans.warehouse import Warehouse
from tillwright.streaming.ingest import StreamTables, recent_metrics, recent_sales


def batch_reports(warehouse: Warehouse) -> dict[str, DataFrame]:
    state = warehouse.state()
    daily = warehouse.table(schemas.DAILY_SALES_SUMMARY, state)
    performance = warehouse.table(schemas.PRODUCT_PERFORMANCE, state)
    return {
        "batch_kpis": reports.batch_kpis(daily),
        "daily_sales": reports.daily_sales(daily),
        "city_sales": reports.city_sales(daily),
        "category_sales": reports.category_sales(performance),
        "category_revenue_share": reports.category_revenue_share(performance),
        "top_products": reports.top_products(performance),
    }


def stream_reports(warehouse: Warehouse, tables: StreamTables) -> dict[str, DataFrame]:
    spark, state = warehouse.spark, warehouse.state()
    metrics = recent_metrics(spark, tables)
    return {
        "latest_metrics": reports.latest_metrics(metrics),
        "recent_metrics": reports.recent_metrics(metrics),
        "metrics_series": reports.metrics_series(metrics),
        "recent_stream_sales": reports.recent_stream_sales(
            recent_sales(spark, tables), warehouse.table(schemas.PRODUCTS, state), warehouse.table(schemas.STORES, state)),
    }
