"""Cleaning and enrichment of sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import line_total
from tillwright.schemas import SALES_CLEAN

PRODUCT_FACTS = ("product_name", "category")
STORE_FACTS = ("store_name", "city", "region")


def is_clean() -> Column:
    """Accepted sales; a NULL quantity or amount is not accepted."""
    return F.col("sale_id").isNotNull() & (F.col("quantity") > 0) & (F.col("total_amount") >= 0)


def clean(sales: DataFrame) -> DataFrame:
    return sales.filter(is_clean())


def add_facts(rows: DataFrame, dimension: DataFrame, key: str, facts: tuple[str, ...]) -> DataFrame:
    """Left join of a dimension that is unique per ``key``: keeps every row, NULL facts for orphans.

    There is no broadcast hint. Spark broadcasts the two to four columns used here while their
    size is below ``spark.sql.autoBroadcastJoinThreshold``; past that it sorts and merges, and
    adaptive execution splits the tasks of a hot key.
    """
    return rows.join(dimension.select(key, *facts), key, "left")


def add_time_parts(sales: DataFrame) -> DataFrame:
    return sales.withColumns({
        "sale_date": F.to_date("sale_timestamp"),
        "sale_hour": F.hour("sale_timestamp").cast("int"),
    })


def enrich(sales: DataFrame, products: DataFrame, stores: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sales with product and store facts and time parts, and the columns ``keep``; the price stays the one of the sale."""
    joined = add_facts(add_facts(sales, products, "product_id", PRODUCT_FACTS), stores, "store_id", STORE_FACTS)
    columns = [c for c in SALES_CLEAN.names if c in SALES_CLEAN.fed or c in sales.columns]
    return add_time_parts(joined).select(*columns, *keep)


def with_line_total(sales: DataFrame) -> DataFrame:
    return sales.withColumn("total_amount", line_total(F.col("quantity"), F.col("unit_price")))


def total_differs() -> Column:
    """The recorded amount is not quantity times price."""
    return ~F.col("total_amount").eqNullSafe(line_total(F.col("quantity"), F.col("unit_price")))
