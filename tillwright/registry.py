"""Named queries over the star schema tables, each exercising one operator on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright import schemas
from tillwright.functions import events
from tillwright.functions.ids import format_id
from tillwright.functions.money import MONEY
from tillwright.functions.times import format_time, parse_time
from tillwright.operators import aggregates, enrich, quality, realtime, reports
from tillwright.operators.upsert import replay_upserts, upsert
from tillwright.plans.batch import BatchLoad, Feed
from tillwright.plans.warehouse import Warehouse
from tillwright.session import cut, scratch_path
from tillwright.sources import files, star, topics
from tillwright.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which every client shows alike."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = lambda spark, root: comparable(build(spark, root))
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _raw_sales(spark, root):
    return replay_upserts(star.sales_arrivals(spark, root), schemas.SALES_BATCH, star.ARRIVAL)


def _sales(spark, root):
    return enrich.add_time_parts(enrich.clean(_raw_sales(spark, root)))


def _daily(spark, root):
    # Sale ids are unique after the upsert, so rows are orders.
    return aggregates.daily_sales_summary(_sales(spark, root), star.stores(spark, root), "rows")


def _store_days(spark, root):
    return aggregates.store_days(_sales(spark, root), "rows")


def _performance(spark, root):
    return aggregates.product_performance(_sales(spark, root), star.products(spark, root), "rows")


def _deliveries(spark, root):
    return star.with_redeliveries(star.stream_arrivals(spark, root))


def _stream_sales(spark, root):
    return replay_upserts(_deliveries(spark, root), schemas.SALES_STREAM, "ingestion_timestamp")


def _snapshots(spark, root):
    return realtime.snapshots(star.stream_arrivals(spark, root))


def _metric_log(spark, root):
    """The stored metric log of all arrivals, by day."""
    log = ingest.StreamTables(scratch_path(spark, "metrics")).metrics(spark)
    log.write(_snapshots(spark, root), F.to_date("metric_timestamp"), 0)
    return log


# --- sources, sinks and tables -------------------------------------------------------------------


@query
def csv_roundtrip(spark, root):
    path, third = scratch_path(spark, "sales-csv"), F.col("quantity") % 3
    awkward = F.concat(F.lit('  "a", '), "customer_id", F.lit('\\" '))
    texts = F.when(third == 0, awkward).when(third == 1, "").otherwise(F.col("customer_id"))
    files.write_csv(_raw_sales(spark, root).withColumn("customer_id", texts).select(*schemas.SALES_BATCH.fed), path)
    return files.read_csv(spark, path, schemas.SALES_BATCH)


@query
def append_rows(spark, root):
    path = scratch_path(spark, "appended")
    sales = _deliveries(spark, root)
    purchase = F.col("payment_method") == "purchase"
    for part in (sales.filter(purchase), sales.filter(~purchase)):
        files.append_parquet(part, schemas.SALES_STREAM.names, path)
    return files.read_parquet(spark, path)


@query
def upsert_products(spark, root):
    products, size = star.products(spark, root), F.col("stock_quantity")
    loaded = upsert(None, products.filter(size <= 40), schemas.PRODUCTS, (), _time(FIRST_LOAD))
    dearer = products.filter(size > 30).withColumn("unit_price", (F.col("unit_price") + 1).cast(MONEY))
    return upsert(loaded, dearer, schemas.PRODUCTS, (), _time(SECOND_LOAD))


@query
def upsert_stores(spark, root):
    stores, region = star.stores(spark, root), F.col("region")
    loaded = upsert(None, stores.filter(region != "ASIA"), schemas.STORES, (), _time(FIRST_LOAD))
    renamed = stores.filter(region.isin("ASIA", "EUROPE")).withColumn(
        "store_name", F.concat("city", F.lit(" Store"))
    )
    return upsert(loaded, renamed, schemas.STORES, (), _time(SECOND_LOAD))


@query
def upsert_sales_batch(spark, root):
    arrivals, cutoff = star.sales_arrivals(spark, root), _time("1998-01-01 00:00:00")
    stored, order = Warehouse(spark, scratch_path(spark, "sales-batch"), buckets=2), (star.ARRIVAL,)
    stored.upsert_facts(arrivals.filter(F.col(star.ARRIVAL) < cutoff), schemas.SALES_BATCH, order, cutoff)
    stored.upsert_facts(arrivals.filter(F.col(star.ARRIVAL) >= cutoff), schemas.SALES_BATCH, order, _time("2002-01-01 00:00:00"))
    return stored.table(schemas.SALES_BATCH)


@query
def stream_upsert(spark, root):
    return _stream_sales(spark, root)


def _ingested(spark, messages, metrics=False):
    folder = scratch_path(spark, "stream")
    topics.write_topic_files(messages, f"{folder}/topic")
    tables = ingest.StreamTables(folder)
    ingest.ingest_available(topics.read_topic_files(spark, f"{folder}/topic"), tables, metrics=metrics)
    return tables


@query
def stream_file_ingest(spark, root):
    return ingest.read_sales(spark, _ingested(spark, events.encode(_deliveries(spark, root), "ingestion_timestamp")))


@query
def stream_quarantine(spark, root):
    return ingest.read_quarantine(spark, _ingested(spark, _damaged(spark, root)))


@query
def stream_metric_log(spark, root):
    """The metric row of each message, in four batches, a quarter of the days each, in as many files as it has partitions."""
    folder, arrivals = scratch_path(spark, "metric-log"), star.stream_arrivals(spark, root)
    quarter = F.ntile(4).over(Window.orderBy("batch"))
    days = arrivals.select(F.to_date("ingestion_timestamp").alias("batch")).distinct().select("batch", quarter.alias("file"))
    bounds = [r.least for r in days.groupBy("file").agg(F.min("batch").alias("least")).orderBy("file").collect()]
    tables = ingest.StreamTables(folder)
    for first, end in zip(bounds, [*bounds[1:], None]):
        day = F.to_date("ingestion_timestamp")
        part = arrivals.filter((day >= F.lit(first)) & (F.lit(True) if end is None else day < F.lit(end)))
        topics.write_topic_files(events.encode(part, "ingestion_timestamp"), f"{folder}/topic")
        # What has arrived since the batch before is one batch.
        ingest.ingest_available(topics.read_topic_files(spark, f"{folder}/topic"), tables)
    return ingest.read_metrics(spark, tables)


@query
def reload_overwrite(spark, root):
    warehouse = Warehouse(spark, scratch_path(spark, "reload"))
    arrived = aggregates.product_performance(star.sales_arrivals(spark, root), star.products(spark, root), "rows")
    warehouse.publish({schemas.PRODUCT_PERFORMANCE: arrived})
    warehouse.publish({schemas.PRODUCT_PERFORMANCE: _performance(spark, root)})
    return warehouse.table(schemas.PRODUCT_PERFORMANCE)


def _feed(spark, root):
    return Feed(star.products(spark, root), star.stores(spark, root), star.sales_arrivals(spark, root),
                (star.ARRIVAL,))


@query
def batch_load(spark, root):
    return BatchLoad(spark, scratch_path(spark, "warehouse"), buckets=2).run(_feed(spark, root), _time(FIRST_LOAD))


@query
def table_counts(spark, root):
    """Rows of six tables; what several of them are made from is reduced once and stored."""
    raw = cut(_raw_sales(spark, root).select("sale_id", "product_id", "store_id", "quantity", "total_amount", "sale_timestamp"))
    sales = enrich.add_time_parts(enrich.clean(raw))
    return quality.table_counts({
        "raw.products": star.products(spark, root), "raw.stores": star.stores(spark, root),
        "raw.sales_batch": raw, "staging.sales_clean": sales,
        "analytics.daily_sales_summary": sales.select("sale_date", "store_id").distinct(),
        "analytics.product_performance": sales.select("product_id").distinct(),
    })


@query
def table_schema(spark, root):
    warehouse = Warehouse(spark, scratch_path(spark, "schema"))
    warehouse.publish({schemas.DAILY_SALES_SUMMARY: _daily(spark, root)})
    return quality.table_schema(spark, "analytics.daily_sales_summary", warehouse.table(schemas.DAILY_SALES_SUMMARY))


def _dirty_feed(spark, root):
    arrivals, quantity = star.sales_arrivals(spark, root), F.col("quantity")
    return arrivals.select(
        "sale_id", "product_id", F.repeat("store_id", F.when(quantity > 49, 60).otherwise(1)).alias("store_id"),
        "customer_id", "quantity", F.col("unit_price").cast("string").alias("unit_price"),
        F.when(quantity > 45, F.col("total_amount") * 10000).otherwise(F.col("total_amount"))
        .cast("decimal(18,2)").cast("string").alias("total_amount"),
        F.when(quantity <= 40, F.col("payment_method")).alias("payment_method"), "sale_timestamp", star.ARRIVAL,
    )


@query
def constraint_violations(spark, root):
    return quality.violations(_dirty_feed(spark, root), schemas.SALES_BATCH)


@query
def load_rejects(spark, root):
    """Sales that a load of a dirty feed keeps, and the rules that the others break."""
    feed, rejects = quality.set_aside(_dirty_feed(spark, root), schemas.SALES_BATCH)
    warehouse = Warehouse(spark, scratch_path(spark, "rejects"), buckets=2)
    warehouse.upsert_facts(feed, schemas.SALES_BATCH, (star.ARRIVAL,), _time(FIRST_LOAD))
    kept = warehouse.table(schemas.SALES_BATCH).select(
        F.col("sale_id").alias("row_key"), F.lit("").alias("column_name"), F.lit("accepted").alias("rule"),
        F.col("total_amount").cast("string").alias("value"))
    return kept.unionByName(rejects)


# --- cleaning and enrichment ---------------------------------------------------------------------


@query
def enrich_sales(spark, root):
    return enrich.enrich(star.sales_arrivals(spark, root), star.products(spark, root), star.stores(spark, root))


@query
def clean_sales(spark, root):
    fewer = _raw_sales(spark, root).withColumn("quantity", F.col("quantity") - 5).drop("ingestion_timestamp")
    sales = enrich.clean(enrich.with_line_total(fewer))
    return enrich.enrich(sales, star.products(spark, root), star.stores(spark, root))


def _few_stores(spark, root):
    return star.stores(spark, root).filter(F.col("region") != "ASIA")


@query
def enrich_orphans(spark, root):
    products = star.products(spark, root).filter(F.col("stock_quantity") < 50)
    sales = _raw_sales(spark, root).drop("ingestion_timestamp")
    return enrich.enrich(sales, products, _few_stores(spark, root))


@query
def orphan_city_sales(spark, root):
    return reports.city_sales(
        aggregates.daily_sales_summary(_sales(spark, root), _few_stores(spark, root), "rows")
    )


@query
def derive_line_total(spark, root):
    recorded = star.sales_arrivals(spark, root, recorded_amount=True)
    checked = recorded.withColumns({
        "differs": enrich.total_differs(), "recorded_amount": F.col("total_amount"),
    })
    return enrich.with_line_total(checked).select(
        "sale_id", "quantity", "unit_price", "recorded_amount", "total_amount", "differs"
    )


# --- aggregates ----------------------------------------------------------------------------------


@query
def daily_sales_summary(spark, root):
    return _daily(spark, root)


@query
def daily_sales_summary_distinct(spark, root):
    sales = enrich.add_time_parts(enrich.clean(star.sales_arrivals(spark, root)))
    return aggregates.daily_sales_summary(sales, star.stores(spark, root), "distinct")


@query
def daily_sales_summary_rowcount(spark, root):
    sales = enrich.add_time_parts(star.sales_arrivals(spark, root))
    return aggregates.daily_sales_summary(sales, star.stores(spark, root), "rows").orderBy("sale_date", "store_id")


@query
def product_performance(spark, root):
    return _performance(spark, root)


@query
def product_performance_distinct(spark, root):
    sales = enrich.clean(star.sales_arrivals(spark, root))
    return aggregates.product_performance(sales, star.products(spark, root), "distinct")


@query
def product_performance_rowcount(spark, root):
    products = star.products(spark, root)
    return aggregates.product_performance(star.sales_arrivals(spark, root), products, "rows").orderBy(
        F.desc_nulls_first("total_revenue"), "product_id"
    )


# --- reports -------------------------------------------------------------------------------------


@query
def batch_kpis(spark, root):
    return reports.batch_kpis(_store_days(spark, root))


@query
def batch_kpis_empty(spark, root):
    return reports.batch_kpis(_store_days(spark, root).filter(F.col("total_revenue") < 0))


@query
def kpi_display(spark, root):
    return reports.kpi_display(reports.batch_kpis(_store_days(spark, root)))


@query
def daily_sales(spark, root):
    return reports.daily_sales(_store_days(spark, root))


@query
def city_sales(spark, root):
    return reports.city_sales(_daily(spark, root))


@query
def sql_report(spark, root):
    """Revenue by region and weekday, as SQL text over the catalog's tables of a load."""
    warehouse = Warehouse(spark, scratch_path(spark, "named"), buckets=1)
    with warehouse.load() as load:
        load.replace(schemas.STORES, upsert(None, star.stores(spark, root), schemas.STORES, (), _time(FIRST_LOAD)))
        load.upsert_facts(star.sales_arrivals(spark, root), schemas.SALES_BATCH, (star.ARRIVAL,), _time(FIRST_LOAD))
    warehouse.register("report_")
    return spark.sql("""
        SELECT s.region, weekday(b.sale_timestamp) AS weekday, COUNT(*) AS sales,
               CAST(SUM(b.total_amount) AS DECIMAL(20,2)) AS revenue
        FROM report_raw.sales_batch AS b INNER JOIN report_raw.stores AS s ON b.store_id = s.store_id
        GROUP BY s.region, weekday(b.sale_timestamp)
    """)


@query
def category_sales(spark, root):
    return reports.category_sales(_performance(spark, root))


@query
def category_revenue_share(spark, root):
    return reports.category_revenue_share(_performance(spark, root))


@query
def top_products(spark, root):
    return reports.top_products(aggregates.product_totals(_sales(spark, root), "rows"), star.products(spark, root))


# --- realtime ------------------------------------------------------------------------------------


@query
def realtime_snapshots(spark, root):
    return _snapshots(spark, root)


@query
def realtime_snapshots_redelivered(spark, root):
    return realtime.snapshots(_deliveries(spark, root))


@query
def realtime_metrics_recent(spark, root):
    return reports.recent_metrics(ingest.newest_rows(_metric_log(spark, root), 50))


@query
def realtime_metrics_series(spark, root):
    return reports.metrics_series(ingest.newest_rows(_metric_log(spark, root), 50))


@query
def realtime_kpi_latest(spark, root):
    return reports.latest_metrics_display(ingest.newest_rows(_metric_log(spark, root), 1))


@query
def recent_stream_sales(spark, root):
    tables = _ingested(spark, events.encode(_deliveries(spark, root), "ingestion_timestamp"))
    return reports.recent_stream_sales(ingest.recent_sales(spark, tables), star.products(spark, root),
                                       star.stores(spark, root))


@query
def recent_by_sale_time(spark, root):
    return reports.recent_by_sale_time(_stream_sales(spark, root))


# --- messages and scalar functions ---------------------------------------------------------------


def _damaged(spark, root):
    """Messages of errors lack their last character; those of signups have a quantity that is no number."""
    sales = star.stream_arrivals(spark, root)
    messages = events.encode(sales, "ingestion_timestamp")
    kind = F.get_json_object("value", "$.payment_method")
    value = F.col("value")
    return messages.withColumn(
        "value",
        F.when(kind == "error", F.substring(value, F.lit(1), F.length(value) - 1))
        .when(kind == "signup", F.replace(value, F.lit('"quantity":1'), F.lit('"quantity":"x"')))
        .otherwise(value),
    )


@query
def json_events_encode(spark, root):
    return events.encode(star.stream_arrivals(spark, root), "ingestion_timestamp")


@query
def json_events_parse(spark, root):
    return events.accepted(_damaged(spark, root))


@query
def json_events_rejected(spark, root):
    return events.rejected(_damaged(spark, root))


@query
def format_ids(spark, root):
    lines, orders = (star.table(spark, root, t) for t in ("lineitem", "orders"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        format_id("product", F.col("l_partkey")).alias("product_id"),
        format_id("store", F.col("l_suppkey")).alias("store_id"),
        format_id("sale", F.col("l_orderkey")).alias("sale_id"),
        format_id("customer", F.col("o_custkey")).alias("customer_id"),
    )


@query
def parse_times(spark, root):
    text = format_time(F.col("sale_timestamp"))
    parsed = star.sales_arrivals(spark, root).select("sale_id", text.alias("time_text")).withColumn(
        "sale_timestamp", parse_time(F.col("time_text"))
    )
    return enrich.add_time_parts(parsed).withColumnRenamed("sale_timestamp", "parsed")
