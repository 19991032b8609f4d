"""Declared tables: columns, types, keys and load-time stamps, with the layer each belongs to."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    sql_type: str
    required: bool = True
    stamped: bool = False  # filled with the load time, kept from the first load

    @property
    def max_length(self) -> int | None:
        if self.sql_type.startswith("VARCHAR"):
            return int(self.sql_type[len("VARCHAR("):-1])
        return None

    @property
    def spark_type(self) -> T.DataType:
        if self.sql_type.startswith("DECIMAL"):
            precision, scale = self.sql_type[len("DECIMAL("):-1].split(",")
            return T.DecimalType(int(precision), int(scale))
        return T.StringType() if self.max_length else _TYPES[self.sql_type]


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    key: tuple[str, ...]
    columns: tuple[Column, ...] = field(default_factory=tuple)

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def stamps(self) -> list[str]:
        return [c.name for c in self.columns if c.stamped]

    @property
    def fed(self) -> list[str]:
        """Columns a source must deliver."""
        return [c.name for c in self.columns if not c.stamped]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def struct(self, only_fed: bool = False) -> T.StructType:
        wanted = [c for c in self.columns if not (only_fed and c.stamped)]
        return T.StructType([T.StructField(c.name, c.spark_type) for c in wanted])

    def text_struct(self) -> T.StructType:
        """Every delivered column as text, for reading input that is still to be checked."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.fed])

    def ddl(self, location: str | None = None) -> str:
        parts = []
        for c in self.columns:
            text = f"{c.name} {c.sql_type}"
            if c.required and not c.stamped:
                text += " NOT NULL"
            if c.stamped:
                text += " DEFAULT localtimestamp()"
            parts.append(text)
        where = f" LOCATION '{location}'" if location else ""
        return f"CREATE TABLE IF NOT EXISTS {self.full_name} ({', '.join(parts)}) USING parquet{where}"


# Table layout, key, type and length of every column.
# Summed measures are wider than in a 32-bit store (BIGINT, DECIMAL(20,2)), because one hot
# product or store may hold a third of all sales and must not overflow.
_ID = "VARCHAR(50)"
_LONG_ID = "VARCHAR(100)"
_MONEY = "DECIMAL(10,2)"
_TOTAL = "DECIMAL(20,2)"
_TIME = "TIMESTAMP_NTZ"

_SALE = (
    Column("sale_id", _LONG_ID),
    Column("product_id", _ID),
    Column("store_id", _ID),
    Column("customer_id", _LONG_ID),
    Column("quantity", "INT"),
    Column("unit_price", _MONEY),
    Column("total_amount", _MONEY),
    Column("payment_method", "VARCHAR(50)"),
    Column("sale_timestamp", _TIME),
)
_INGESTED = Column("ingestion_timestamp", _TIME, required=False, stamped=True)
_CREATED = Column("created_at", _TIME, required=False, stamped=True)

PRODUCTS = Table("raw", "products", ("product_id",), (
    Column("product_id", _ID),
    Column("product_name", "VARCHAR(255)"),
    Column("category", "VARCHAR(100)"),
    Column("unit_price", _MONEY),
    Column("stock_quantity", "INT"),
    _CREATED,
))

STORES = Table("raw", "stores", ("store_id",), (
    Column("store_id", _ID),
    Column("store_name", "VARCHAR(255)"),
    Column("city", "VARCHAR(100)"),
    Column("region", "VARCHAR(100)"),
    _CREATED,
))

SALES_BATCH = Table("raw", "sales_batch", ("sale_id",), (*_SALE, _INGESTED))
SALES_STREAM = Table("raw", "sales_stream", ("sale_id",), (*_SALE, _INGESTED))

SALES_CLEAN = Table("staging", "sales_clean", ("sale_id",), (
    Column("sale_id", _LONG_ID),
    Column("product_id", _ID),
    Column("product_name", "VARCHAR(255)", required=False),
    Column("category", "VARCHAR(100)", required=False),
    Column("store_id", _ID),
    Column("store_name", "VARCHAR(255)", required=False),
    Column("city", "VARCHAR(100)", required=False),
    Column("region", "VARCHAR(100)", required=False),
    Column("customer_id", _LONG_ID),
    Column("quantity", "INT"),
    Column("unit_price", _MONEY),
    Column("total_amount", _MONEY),
    Column("payment_method", "VARCHAR(50)"),
    Column("sale_timestamp", _TIME),
    Column("sale_date", "DATE"),
    Column("sale_hour", "INT"),
    _INGESTED,
))

DAILY_SALES_SUMMARY = Table("analytics", "daily_sales_summary", ("sale_date", "store_id"), (
    Column("sale_date", "DATE"),
    Column("store_id", _ID),
    Column("store_name", "VARCHAR(255)", required=False),
    Column("city", "VARCHAR(100)", required=False),
    Column("region", "VARCHAR(100)", required=False),
    Column("total_revenue", _TOTAL, required=False),
    Column("total_orders", "BIGINT", required=False),
    Column("total_items_sold", "BIGINT", required=False),
    Column("average_basket", _MONEY, required=False),
))

PRODUCT_PERFORMANCE = Table("analytics", "product_performance", ("product_id",), (
    Column("product_id", _ID),
    Column("product_name", "VARCHAR(255)", required=False),
    Column("category", "VARCHAR(100)", required=False),
    Column("total_revenue", _TOTAL, required=False),
    Column("total_quantity_sold", "BIGINT", required=False),
    Column("number_of_orders", "BIGINT", required=False),
))

REALTIME_SALES_METRICS = Table("analytics", "realtime_sales_metrics", ("metric_timestamp", "metric_key"), (
    Column("metric_timestamp", _TIME),
    Column("metric_key", _LONG_ID),
    Column("total_revenue", _TOTAL, required=False),
    Column("total_orders", "BIGINT", required=False),
    Column("average_basket", _MONEY, required=False),
))

TABLES = {t.full_name: t for t in (
    PRODUCTS, STORES, SALES_BATCH, SALES_STREAM, SALES_CLEAN,
    DAILY_SALES_SUMMARY, PRODUCT_PERFORMANCE, REALTIME_SALES_METRICS,
)}

# Format of a business time written as text.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def create_tables(spark: SparkSession, root: str | None = None) -> None:
    """Create the layers and tables in the session catalog where they are absent."""
    for layer in dict.fromkeys(t.layer for t in TABLES.values()):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for table in TABLES.values():
        location = f"{root}/{table.layer}/{table.name}" if root else None
        spark.sql(table.ddl(location))
