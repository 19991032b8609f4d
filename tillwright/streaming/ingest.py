"""Streaming ingest of sale events: keyed upsert, a metric row a message, quarantine.

A micro-batch keeps no state of its own: which of its sales are known, and since when, is read from
the stored ones. A sale is stored by the day of its first arrival, and a redelivery is looked for
where that may be: among sales that arrived within ``LATE`` before, and for the few that were sold
longer ago, from the day of the sale on. So a batch costs as much as the sales of the last hour
and of these days, however long the stream has run, and nothing grows with it but the stored
sales. A redelivery whose first arrival is both longer ago and on a day before that of the sale
is stored as a new sale; reading all sales still joins both.

Each batch writes the versions of sales it changed, and its metric rows, under its ``batch_id``; run
again after a failure it replaces them. Readers take the newest version of a sale.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwright import storage
from tillwright.functions.events import accepted, rejected
from tillwright.operators.realtime import WINDOW_SECONDS, repeated_sales, snapshots
from tillwright.operators.upsert import latest_by_key, rows_of_keys
from tillwright.schemas import REALTIME_SALES_METRICS, SALES_STREAM
from tillwright.session import build_session, scratch_path
from tillwright.sources.topics import TOPIC_COLUMNS, read_kafka
from tillwright.streaming.daylog import BATCH, DayLog

#: How long after its first arrival a redelivery is known by that alone; a later one by the day of the sale.
LATE = timedelta(hours=1)
LAST = "last_arrival"
VERSION = SALES_STREAM.struct().add(LAST, T.TimestampNTZType())


@dataclass(frozen=True)
class StreamTables:
    """Folders of one ingest; all in storage that the whole cluster reaches."""

    root: str

    def sales(self, spark: SparkSession) -> DayLog:
        """Versions of sales by day of first arrival."""
        return DayLog(spark, f"{self.root}/raw/sales_stream", VERSION, "sale_id")

    def metrics(self, spark: SparkSession) -> DayLog:
        """Metric rows by day."""
        return DayLog(spark, f"{self.root}/analytics/realtime_sales_metrics", REALTIME_SALES_METRICS.struct())

    @property
    def quarantine(self) -> str:
        return f"{self.root}/raw/sales_stream_rejected"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def committed(self, spark: SparkSession) -> int:
        """The last batch that will not run again; -1 if there is none."""
        names = storage.children(spark, f"{self.checkpoint('sales')}/commits")
        return max((int(n) for n in names if n.isdigit()), default=-1)


def _time(moment: datetime) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def _newest(versions: DataFrame) -> DataFrame:
    """Newest version of each sale, by arrival, with the least of the first arrivals they name."""
    rows = versions.select(*SALES_STREAM.fed, LAST, F.col("ingestion_timestamp").alias("_first"))
    found = latest_by_key(rows, ["sale_id"], [LAST], {"ingestion_timestamp": "_first", "_last": LAST})
    return found.withColumnRenamed("_last", LAST).select(*VERSION.names)


def _known(log: DayLog, arrivals: DataFrame, least: datetime, sold: datetime) -> DataFrame:
    """Stored versions of the sales that arrived; ``least`` is the first arrival, ``sold`` the first sale time."""
    recent, days = least - LATE, log.days()
    versions = log.read([d for d in days if d >= recent.date()])
    ids = arrivals.select("sale_id").distinct()
    found = versions.filter(F.col("ingestion_timestamp") >= _time(recent)).join(ids, "sale_id", "left_semi")
    older = [d for d in days if sold.date() <= d <= recent.date()] if sold < recent else []
    if older:
        late = arrivals.filter(F.col("sale_timestamp") < _time(recent))
        before = log.read(older).filter(F.col("ingestion_timestamp") < _time(recent))
        found = found.unionByName(rows_of_keys(before, late.select("sale_id").distinct(), ["sale_id"]))
    return found


def _keep_batch(tables: StreamTables, strict: bool = False, metrics: bool = True):
    def keep(messages: DataFrame, batch_id: int) -> None:
        """Write the changed sales by day of first arrival, then the metric rows of this batch."""
        spark, log = messages.sparkSession, tables.sales(messages.sparkSession)
        scratch = scratch_path(spark, "arrivals")
        accepted(messages, strict).write.parquet(scratch)
        arrivals = spark.read.schema(SALES_STREAM.struct()).parquet(scratch)
        at = F.col("ingestion_timestamp")
        span = arrivals.agg(F.min(at).alias("least"), F.min("sale_timestamp").alias("sold")).first()
        if span.least is None:
            return
        stored = scratch_path(spark, "known")
        _known(log, arrivals, span.least, span.sold).write.parquet(stored)
        known = spark.read.parquet(stored)
        # A version that this batch wrote when it ran before names the same first arrival.
        firsts = known.groupBy("sale_id").agg(F.min("ingestion_timestamp").alias("_known"))
        rows = arrivals.select(*SALES_STREAM.fed, at.alias(LAST))
        changed = latest_by_key(rows, ["sale_id"], [LAST], {"_first": LAST, "_last": LAST}).join(firsts, "sale_id", "left")
        log.write(
            changed.withColumns({"ingestion_timestamp": F.least("_first", "_known"), LAST: F.col("_last")}),
            F.to_date("ingestion_timestamp"), batch_id)
        if metrics:
            _log_metrics(tables, arrivals, known.filter(F.col(BATCH) < batch_id), span.least, batch_id)
        for path in (scratch, stored):
            storage.delete(spark, path)

    return keep


def _log_metrics(tables: StreamTables, arrivals: DataFrame, known: DataFrame, least: datetime, batch_id: int) -> None:
    """A metric row for each arrival of the batch, over what was stored before and the batch itself.

    Sales whose window reaches into the batch are read from the days of that window. Each counts as
    one arrival, its first, of the newest amount; so do the known sales that the batch delivers again.
    """
    spark = arrivals.sparkSession
    log, since = tables.sales(spark), least - timedelta(seconds=WINDOW_SECONDS)
    held = log.read([d for d in log.days() if d >= since.date()]).filter(
        (F.col("ingestion_timestamp") >= _time(since)) & (F.col(BATCH) < batch_id))
    stored, again = scratch_path(spark, "before"), scratch_path(spark, "repeated")
    _newest(held.unionByName(known)).select(*SALES_STREAM.names).write.parquet(stored)
    before = spark.read.schema(SALES_STREAM.struct()).parquet(stored)
    # Most sales are delivered once; their ids alone are shuffled to tell.
    repeated_sales(arrivals, before).write.parquet(again)
    rows = snapshots(arrivals, before, spark.read.parquet(again))
    tables.metrics(spark).write(rows, F.to_date("metric_timestamp"), batch_id)
    for path in (stored, again):
        storage.delete(spark, path)


def start_sales(messages: DataFrame, tables: StreamTables, strict: bool = False, metrics: bool = True, **trigger) -> StreamingQuery:
    """Keep the sales, and unless told otherwise the metric log, up to date with a stream of messages."""
    return (
        messages.writeStream.option("checkpointLocation", tables.checkpoint("sales"))
        .foreachBatch(_keep_batch(tables, strict, metrics))
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def start_quarantine(messages: DataFrame, tables: StreamTables, **trigger) -> StreamingQuery:
    """Set invalid messages aside, unchanged."""
    return (
        rejected(messages).writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", tables.checkpoint("rejected"))
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(tables.quarantine)
    )


def read_sales(spark: SparkSession, tables: StreamTables) -> DataFrame:
    """The streamed sales, one row per sale."""
    return _newest(tables.sales(spark).read()).select(*SALES_STREAM.names)


def read_metrics(spark: SparkSession, tables: StreamTables) -> DataFrame:
    return tables.metrics(spark).read().select(*REALTIME_SALES_METRICS.names)


def _newest_days(log: DayLog, n: int, count: Callable[[DataFrame], int]) -> DataFrame:
    """Rows of the newest days, so many that they hold ``n``; each day is counted once, older ones are not listed."""
    days: list[date] = []
    held = 0
    for day in reversed(log.days()):
        days.append(day)
        held += count(log.read([day]))
        if held >= n:
            break
    return log.read(days)


def newest_rows(log: DayLog, n: int) -> DataFrame:
    """Rows of the newest days, so many days that the ``n`` newest rows are among them."""
    return _newest_days(log, n, lambda day: day.limit(n).count()).select(*log.schema.names)


def recent_metrics(spark: SparkSession, tables: StreamTables, n: int = 50) -> DataFrame:
    return newest_rows(tables.metrics(spark), n)


def recent_sales(spark: SparkSession, tables: StreamTables, n: int = 20) -> DataFrame:
    """Streamed sales of the newest days, so many days that the ``n`` newest sales are among them.

    A sale never leaves the day of its first arrival, so older days cannot hold any.
    """
    versions = _newest_days(tables.sales(spark), n, lambda day: day.select("sale_id").distinct().limit(n).count())
    return _newest(versions).select(*SALES_STREAM.names)


def read_quarantine(spark: SparkSession, tables: StreamTables) -> DataFrame:
    return spark.read.schema(TOPIC_COLUMNS).parquet(tables.quarantine)


def compact(spark: SparkSession, tables: StreamTables, before: date) -> list[date]:
    """Fold the days before ``before``: one version a sale, one folder of metric rows; returns the days of sales folded.

    Only batches whose commit is in the checkpoint are folded. Run it between batches.
    """
    committed = tables.committed(spark)

    def newest(versions: DataFrame) -> DataFrame:
        batches = versions.groupBy("sale_id").agg(F.max(BATCH).alias(BATCH))
        return _newest(versions).join(batches, "sale_id")

    tables.metrics(spark).fold(before, committed, lambda rows: rows)
    return tables.sales(spark).fold(before, committed, newest)


def ingest_available(messages: DataFrame, tables: StreamTables, strict: bool = False, metrics: bool = True) -> None:
    """Process everything that has arrived and stop. Invalid messages are set aside, or stop it if ``strict``."""
    queries = [start_sales(messages, tables, strict, metrics, availableNow=True)]
    if not strict:
        queries.append(start_quarantine(messages, tables, availableNow=True))
    for query in queries:
        query.awaitTermination()


def main() -> None:
    parser = argparse.ArgumentParser(description="Keep the stream tables up to date with a Kafka topic.")
    parser.add_argument("servers")
    parser.add_argument("topic")
    parser.add_argument("root", help="folder of the tables and checkpoints, in shared storage")
    parser.add_argument("--strict", action="store_true", help="stop at an invalid message")
    parser.add_argument("--data-bytes", type=int, help="volume of a batch, to size shuffles")
    parser.add_argument("--max-offsets", type=int, help="messages a batch takes at most")
    args = parser.parse_args()
    spark, tables = build_session(data_bytes=args.data_bytes), StreamTables(args.root)
    messages = read_kafka(spark, args.servers, args.topic, max_offsets_per_trigger=args.max_offsets)
    start_sales(messages, tables, args.strict)
    if not args.strict:
        start_quarantine(messages, tables)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
