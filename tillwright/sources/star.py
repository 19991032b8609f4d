"""The sales model over a star schema of ``lineitem``, ``orders``, ``part``, ``supplier`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.ids import format_id
from tillwright.functions.money import MONEY, line_total
from tillwright.schemas import PRODUCTS, SALES_BATCH, STORES

ARRIVAL = "arrival_timestamp"

# Payment method of each return flag.
PAYMENT_OF_FLAG = {"A": "card", "N": "cash", "R": "mobile_money"}

# Seconds after which a purchase event is delivered (again).
REDELIVERY_SECONDS = (0, 120, 600)

# Columns of the source tables. Declared, so that no job has to read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def products(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        F.col("p_size").alias("stock_quantity"),
    ).select(*PRODUCTS.fed)


def stores(spark: SparkSession, root: str) -> DataFrame:
    nation, region = table(spark, root, "nation"), table(spark, root, "region")
    supplier = table(spark, root, "supplier")
    return (
        supplier
        .join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            F.col("s_suppkey").cast("string").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
        .select(*STORES.fed)
    )


def sales_arrivals(spark: SparkSession, root: str, recorded_amount: bool = False) -> DataFrame:
    """Every delivered sale line with its arrival time; a sale may be delivered more than once.

    The amount is derived from quantity and product price, or as recorded in the line.
    """
    lines, orders = table(spark, root, "lineitem"), table(spark, root, "orders")
    price = table(spark, root, "part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("unit_price"))
    quantity = F.col("l_quantity").cast("int")
    payment = F.create_map(*[F.lit(x) for pair in PAYMENT_OF_FLAG.items() for x in pair])[F.col("l_returnflag")]
    # The price of an unknown product is the line's own.
    unit_price = F.coalesce("unit_price", (F.col("l_extendedprice") / F.col("l_quantity")).cast(MONEY))
    derived = line_total(quantity, unit_price)
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return (
        lines
        .join(orders, lines.l_orderkey == orders.o_orderkey, "left")
        .join(price, lines.l_partkey == price.p_partkey, "left")
        .select(
            F.concat_ws("-", F.lit("BATCH"), "l_orderkey", "l_linenumber").alias("sale_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("store_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            quantity.alias("quantity"),
            unit_price.alias("unit_price"),
            (F.col("l_extendedprice").cast(MONEY) if recorded_amount else derived).alias("total_amount"),
            payment.alias("payment_method"),
            (F.col("o_orderdate") + hours).alias("sale_timestamp"),
            F.col("l_shipdate").alias(ARRIVAL),
        )
        .select(*SALES_BATCH.fed, ARRIVAL)
    )


def stream_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Every event as one sale message, in arrival order of ``ingestion_timestamp``."""
    amount = F.col("value").cast(MONEY)
    return table(spark, root, "events").select(
        format_id("stream_sale", F.col("event_id")).alias("sale_id"),
        (F.col("event_id") % 2500).cast("string").alias("product_id"),
        F.get_json_object("props", "$.k").alias("store_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.lit(1).alias("quantity"),
        amount.alias("unit_price"),
        amount.alias("total_amount"),
        F.col("event_type").alias("payment_method"),
        F.col("ts").alias("sale_timestamp"),
        F.col("ts").alias("ingestion_timestamp"),
    )


def with_redeliveries(arrivals: DataFrame) -> DataFrame:
    """Purchases are delivered again 120 s and 600 s later, each time for 1.00 more."""
    once, thrice = F.array(F.lit(0)), F.array(*[F.lit(n) for n in REDELIVERY_SECONDS])
    repeats = F.when(F.col("payment_method") == "purchase", thrice).otherwise(once)
    delay = F.make_dt_interval(secs=F.col("_delay"))
    return (
        arrivals.select("*", F.posexplode(repeats).alias("_n", "_delay"))
        .withColumns({
            "total_amount": (F.col("total_amount") + F.col("_n")).cast(MONEY),
            "ingestion_timestamp": F.col("ingestion_timestamp") + delay,
        })
        .drop("_n", "_delay")
    )
