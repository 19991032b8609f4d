"""Reports over stored batch and stream tables."""

from conftest import at, money
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.functions import events
from tillwright.plans.batch import BatchLoad, Feed
from tillwright.plans.dashboard import batch_reports, stream_reports
from tillwright.session import shuffle_settings
from tillwright.sources import topics
from tillwright.streaming import ingest


def test_reports_over_stored_tables(spark, sales_frame, sale, products, stores, tmp_path):
    load = BatchLoad(spark, str(tmp_path / "warehouse"))
    load.run(Feed(products, stores, sales_frame([sale("a"), sale("b", product_id="P002", amount="30.00")])),
             F.lit("2024-03-02 00:00:00").cast("timestamp_ntz"))
    got = {name: [tuple(r) for r in df.collect()] for name, df in batch_reports(load.warehouse).items()}
    assert got["batch_kpis"] == [(money(40), 2, 2, money(20))]
    assert got["category_sales"] == [("Fashion", money(30), 1), ("Home", money(10), 1)]
    assert [r[0] for r in got["top_products"]] == ["Jeans", "Lamp"]
    assert got["city_sales"] == [("Lyon", money(40), 2)]

    tables = ingest.StreamTables(str(tmp_path / "stream"))
    sent = sales_frame([sale("s", ingested="2024-03-02 10:00:00")], schemas.SALES_STREAM)
    topics.write_topic_files(events.encode(sent, "ingestion_timestamp"), str(tmp_path / "topic"))
    ingest.ingest_available(topics.read_topic_files(spark, str(tmp_path / "topic")), tables)
    live = {name: df.collect() for name, df in stream_reports(load.warehouse, tables).items()}
    assert live["latest_metrics"][0].metric_timestamp == at("2024-03-02 10:00:00")
    assert live["recent_stream_sales"][0].city == "Lyon"


def test_shuffle_size_follows_the_data():
    assert shuffle_settings(1) == {"spark.sql.shuffle.partitions": "200"}
    assert int(shuffle_settings(100 << 40)["spark.sql.shuffle.partitions"]) == 204_800
