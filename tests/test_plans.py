"""What the physical plans of the registered queries must and must not contain."""

import re
from contextlib import contextmanager

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tillwright import registry, schemas
from tillwright.operators import aggregates, enrich, realtime
from tillwright.sources import star

EAGER = {"csv_roundtrip", "append_rows", "upsert_sales_batch", "stream_file_ingest", "reload_overwrite",
         "batch_load", "table_schema", "recent_stream_sales", "stream_quarantine", "stream_metric_log", "load_rejects",
         "sql_report", "constraint_violations", "realtime_metrics_recent", "realtime_metrics_series", "realtime_kpi_latest"}
# One row, or one row per table, is all that reaches the single partition here.
ONE_ROW = {"batch_kpis", "batch_kpis_empty", "kpi_display", "category_revenue_share", "table_counts"}
LAZY = sorted(set(registry.queries()) - EAGER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_single_task(spark, name):
    text = plan(spark_entry.queries()[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas", text)
    if name not in ONE_ROW:
        assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", ["top_products", "realtime_metrics_recent", "realtime_kpi_latest",
                                  "recent_by_sale_time"])
def test_top_n_without_a_sort_of_everything(spark, name):
    text = plan(spark_entry.queries()[name](spark, SMALL))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_best_products_are_picked_before_the_join(spark):
    text = plan(spark_entry.queries()["top_products"](spark, SMALL))
    assert text.index("p_name") < text.rindex("TakeOrderedAndProject")  # the catalogue joins what was picked below
    assert text.count("TakeOrderedAndProject") >= 1 and "BroadcastHashJoin" in text


def test_product_performance_reads_what_it_needs(spark):
    text = plan(spark_entry.queries()["product_performance"](spark, SMALL))
    assert "supplier.parquet" not in text and "l_tax" not in text and "p_brand" not in text


def test_kpis_read_no_store(spark):
    assert "supplier.parquet" not in plan(spark_entry.queries()["batch_kpis"](spark, SMALL))


def test_clean_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "sales")
    star.sales_arrivals(spark, SMALL).write.parquet(path)
    text = plan(enrich.clean(spark.read.parquet(path)).select("store_id"))
    assert "PushedFilters: [IsNotNull(quantity), IsNotNull(total_amount)" in text
    assert "customer_id" not in text.split("ReadSchema")[1]


def test_reduction_before_the_dimension_join(spark):
    sales = enrich.add_time_parts(star.sales_arrivals(spark, SMALL))
    text = plan(aggregates.daily_sales_summary(sales, star.stores(spark, SMALL), "rows"))
    joined = text.index("s_suppkey")
    assert text.index("partial_sum") < joined


@contextmanager
def conf(spark, **values):
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Thresholds scaled down to the few megabytes of a test.
SKEW_IN_SMALL = {
    "autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1",
    "adaptive__advisoryPartitionSizeInBytes": "16KB",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "16KB", "adaptive__skewJoin__skewedPartitionFactor": "1",
}


def test_large_dimension_is_not_broadcast(spark):
    with conf(spark, autoBroadcastJoinThreshold="100"):
        sales = star.sales_arrivals(spark, SMALL)
        text = plan(enrich.enrich(sales, star.products(spark, SMALL), star.stores(spark, SMALL)))
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") >= 4


def test_hot_product_is_split(spark):
    """A third of all sales are of one product; the join to a large catalogue splits its rows."""
    i = F.col("id")
    sales = spark.range(0, 120_000, 1, 8).select(
        F.concat(F.lit("S"), i).alias("sale_id"), F.when(i % 3 == 0, 0).otherwise(i).cast("string").alias("product_id"),
        (i % 50).cast("string").alias("store_id"), F.lit("c").alias("customer_id"), F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("unit_price"), F.lit(1).cast("decimal(10,2)").alias("total_amount"),
        F.lit("card").alias("payment_method"),
        F.lit("2024-03-01 10:00:00").cast("timestamp_ntz").alias("sale_timestamp"))
    products = spark.range(0, 120_000, 1, 8).select(
        i.cast("string").alias("product_id"), F.lit("n").alias("product_name"), F.lit("x").alias("category"))
    stores = spark.range(50).select(i.cast("string").alias("store_id"), F.lit("n").alias("store_name"),
                                    F.lit("c").alias("city"), F.lit("r").alias("region"))
    with conf(spark, **SKEW_IN_SMALL):
        enriched = enrich.enrich(sales, products, stores)
        assert enriched.columns == schemas.SALES_CLEAN.fed
        rows = enriched.groupBy("category", "city").agg(F.count("*").alias("n"))
        assert [tuple(r) for r in rows.collect()] == [("x", "c", 120_000)]
        assert "SortMergeJoin(skew=true)" in plan(rows)


def test_hot_instant_is_split(spark):
    """A third of all messages arrive in one microsecond."""
    i = F.col("id")
    seconds = F.when(i % 3 == 0, 1000).otherwise(i).cast("decimal(18,6)")
    arrivals = spark.range(0, 90_000, 1, 8).select(
        F.concat(F.lit("S"), i).alias("sale_id"),
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias(
            "ingestion_timestamp"),
        F.lit(2).cast("decimal(10,2)").alias("total_amount"))
    with conf(spark, **SKEW_IN_SMALL):
        got = realtime.snapshots(arrivals)
        hot = got.groupBy("metric_timestamp").agg(F.max("total_orders"), F.count("*").alias("n")).orderBy(F.desc("n"))
        # Seconds 700 to 1000 hold one other sale each, but for every third.
        assert tuple(hot.collect()[0])[1:] == (30_000 + 201, 30_000 + 1)
        assert "SortMergeJoin(skew=true)" in plan(hot)


@pytest.mark.parametrize("name, scans", [("realtime_snapshots", 2), ("realtime_snapshots_redelivered", 2)])
def test_snapshots_share_their_shuffles(spark, name, scans):
    df = spark_entry.queries()[name](spark, SMALL)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == scans
    assert final.count("Generate inline") == 1
