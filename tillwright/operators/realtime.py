"""Realtime metrics: what a trailing five-minute window over *first* ingestion shows after each arrival.

An arrival at ``t`` sees every sale first ingested at or after ``t - 5 min``, at its newest payload.
Redelivery changes the amount of a sale, not its place in the window.

The plan is a prefix sum over changes. Each change adds at its arrival and takes away once the
window of its sale has passed. No task has to sort an unbounded group, however many rows share a
sale, a tick or an instant:

* changes of one microsecond are summed before the shuffle;
* running sums are formed inside one tick (at most a million instants) on top of running sums of
  whole ticks inside one block (1024 ticks);
* a change alive across a block border is carried over by one more summed change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.money import MONEY, TOTAL, exact_average, or_zero
from tillwright.functions.times import SECOND_US, floor_to, micros
from tillwright.schemas import SALES_STREAM

# Length of the trailing window, closed at both ends.
WINDOW_SECONDS = 300
WINDOW_US = WINDOW_SECONDS * SECOND_US

# Powers of two: about a second, and about 18 minutes. A block is longer than the window, so a
# change touches at most two blocks.
TICK_US = 1 << 20
BLOCK_US = 1 << 30


def _tick(at: Column) -> Column:
    return floor_to(at, TICK_US)


def _block(at: Column) -> Column:
    return floor_to(at, BLOCK_US)


def _deliveries(arrivals: DataFrame) -> DataFrame:
    """Change of revenue and orders by each arrival; none if the window of its sale has passed.

    The previous amount of a sale is looked up inside one tick and, for the first arrival of a
    tick, among the few hundred earlier ticks of the window of the sale.
    """
    # Of deliveries at one instant the one counts that the upsert keeps: the greatest row.
    instants = arrivals.groupBy("sale_id", _tick(F.col("at")).alias("tick"), "at").agg(
        F.max("row")["total_amount"].alias("amount")
    )
    ticks = instants.groupBy("sale_id", _block(F.col("tick")).alias("block"), "tick").agg(
        F.min("at").alias("lowest"), F.max_by("amount", "at").alias("last")
    )
    # A window touches two blocks; joined per block, a sale delivered for years is no hot key.
    # Always ``lowest``; naming ``last`` keeps both uses of ``ticks`` one plan, hence one shuffle.
    lowest = F.coalesce(F.when(F.col("last").isNull(), F.col("lowest")), F.col("lowest"))
    first = F.min(lowest)
    first_blocks = ticks.groupBy("sale_id").agg(first.alias("first")).select(
        "sale_id", "first",
        F.explode(F.array(_block(F.col("first")), _block(F.col("first")) + BLOCK_US)).alias("block"),
    )
    by_sale = Window.partitionBy("sale_id").orderBy("tick")
    alive_ticks = (
        ticks.join(first_blocks, ["sale_id", "block"])
        .filter(F.col("lowest") <= F.col("first") + WINDOW_US)
        .select("sale_id", "tick", "first", F.lag("last").over(by_sale).alias("last_before"))
    )
    by_tick = Window.partitionBy("sale_id", "tick").orderBy("at")
    previous = F.coalesce(F.lag("amount").over(by_tick), F.col("last_before"), F.lit(0).cast(MONEY))
    in_window = F.coalesce(F.col("at") <= F.col("first") + WINDOW_US, F.lit(False))
    return (
        instants.join(alive_ticks, ["sale_id", "tick"], "left")
        .select("at", "first", (F.col("amount") - previous).alias("step"), in_window.alias("in_window"))
        .select(
            "at",
            F.coalesce(F.when(F.col("in_window"), F.col("first") + WINDOW_US), F.col("at")).alias("last_at"),
            F.when(F.col("in_window"), F.col("step")).otherwise(0).alias("revenue"),
            F.when(F.col("at") == F.col("first"), 1).otherwise(0).cast("bigint").alias("orders"),
        )
        .select("at", (F.col("last_at") + 1).alias("until"), "revenue", "orders")
    )


def _lone(arrivals: DataFrame) -> DataFrame:
    """``_deliveries`` of sales that arrive once: nothing to look up."""
    return arrivals.select("at", (F.col("at") + WINDOW_US + 1).alias("until"), F.col("row")["total_amount"].alias("revenue"),
                           F.lit(1).cast("bigint").alias("orders"))


def repeated_sales(arrivals: DataFrame, before: DataFrame) -> DataFrame:
    """``sale_id`` of the sales that both together hold more than once."""
    ids = arrivals.select("sale_id").unionByName(before.select("sale_id"))
    return ids.groupBy("sale_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("sale_id")


def _changes(deliveries: DataFrame) -> DataFrame:
    """Add at ``at``, take away at ``until``; carried into the next block if that lies between."""
    crosses = _block(F.col("until")) > _block(F.col("at"))
    no_revenue, no_orders = -F.col("revenue"), -F.col("orders")

    def change(block: Column, at: Column, revenue: Column, orders: Column) -> Column:
        return F.struct(block.alias("block"), _tick(at).alias("tick"), at.alias("at"),
                        revenue.alias("revenue"), orders.alias("orders"))

    add = change(_block(F.col("at")), F.col("at"), F.col("revenue"), F.col("orders"))
    drop = change(_block(F.col("until")), F.col("until"), no_revenue, no_orders)
    # The instant just before the block; no arrival or end of this block is in its tick.
    carry = change(_block(F.col("until")), _block(F.col("until")) - 1, F.col("revenue"), F.col("orders"))
    return deliveries.select(
        F.inline(F.when(crosses, F.array(add, carry, drop)).otherwise(F.array(add, drop)))
    )


def _running(rows: DataFrame, group: list[str], order: str, last_row: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, last_row)
    return rows.withColumns({c: F.sum(c).over(w) for c in ("revenue", "orders")})


def _states(changes: DataFrame) -> DataFrame:
    """Revenue and orders in the window at every instant at which something changes."""
    sums = {"revenue": F.sum("revenue").cast(TOTAL), "orders": F.sum("orders")}
    named = [c.alias(n) for n, c in sums.items()]
    instants = changes.groupBy("block", "tick", "at").agg(*named)
    ticks = instants.groupBy("block", "tick").agg(*named)
    # What holds before the first instant of each tick, placed just before it.
    before = _running(ticks, ["block"], "tick", -1).select(
        "block", "tick", (F.col("tick") - 1).alias("at"),
        F.coalesce("revenue", F.lit(0)).cast(TOTAL).alias("revenue"), F.coalesce("orders", F.lit(0)).alias("orders"),
    )
    # Both conditions name a column the windows do not group by, so they stay above them and
    # leave one shared plan, hence one shuffle, for ``instants``.
    real = (F.col("at") >= F.col("tick")) & (F.col("at") >= F.col("block"))
    return _running(instants.unionByName(before), ["block", "tick"], "at", Window.currentRow).filter(real).select(
        "at", "revenue", "orders"
    )


def _known(name: str) -> Column:
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"NULL in {name} of an arrival")))


def snapshots(arrivals: DataFrame, before: DataFrame | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """One metric row per arrival, as the metric log holds it after the arrival was stored.

    ``arrivals`` has ``sale_id``, ``ingestion_timestamp``, ``total_amount`` and any other columns
    of a sale. Arrivals at the same microsecond see each other. A NULL key is an error, as it is
    for the upsert. ``before`` holds sales that were stored before, one row each, by their first
    arrival; they count like arrivals but get no row. ``repeated``, if given, is the stored result of
    ``repeated_sales``; only these are then shuffled by sale.
    """
    row = [c for c in SALES_STREAM.fed if c in arrivals.columns and c != "sale_id"]

    # Never NULL, so that the optimizer adds no null filters, and with them scans and shuffles,
    # to the uses of the shared parts below.
    def timed(rows: DataFrame) -> DataFrame:
        return rows.select(
            _known("sale_id").alias("sale_id"), _known("ingestion_timestamp").alias("ingestion_timestamp"),
            F.coalesce(micros(F.col("ingestion_timestamp")), F.lit(0)).alias("at"), F.struct(*row).alias("row"))

    counted = arrivals if before is None else arrivals.select("sale_id", "ingestion_timestamp", *row).unionByName(
        before.select("sale_id", "ingestion_timestamp", *row))
    counted = timed(counted)
    if repeated is None:
        deliveries = _deliveries(counted)
    else:
        deliveries = _deliveries(counted.join(repeated, "sale_id", "left_semi")).unionByName(
            _lone(counted.join(repeated, "sale_id", "left_anti")))
    states = _states(_changes(deliveries))
    return timed(arrivals).join(states, "at").select(
        F.col("ingestion_timestamp").alias("metric_timestamp"),
        F.col("sale_id").alias("metric_key"),
        or_zero(F.col("revenue"), TOTAL).alias("total_revenue"),
        or_zero(F.col("orders"), "bigint").alias("total_orders"),
        or_zero(exact_average(F.col("revenue").cast(TOTAL), F.col("orders")), MONEY).alias("average_basket"),
    )


def window_metrics(sales: DataFrame, now: Column) -> DataFrame:
    """One metric row over the stored sales of the last five minutes before ``now``; zeros if none."""
    since = now - F.make_dt_interval(secs=F.lit(WINDOW_SECONDS))
    sums = sales.filter(F.col("ingestion_timestamp") >= since).agg(
        F.sum("total_amount").cast(TOTAL).alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    return sums.select(
        now.alias("metric_timestamp"),
        or_zero(F.col("revenue"), TOTAL).alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        or_zero(exact_average(F.col("revenue"), F.col("orders")), MONEY).alias("average_basket"),
    )
