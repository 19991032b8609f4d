"""The batch load: files to raw tables, raw to staging, staging to analytics.

After the first build, staging and analytics are refreshed: only parts that a load touched, or
that hold sales of a changed product or store, are computed anew. The result is that of a full
build, but for the load time of staged sales, which stays that of the build that wrote them.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.operators.aggregates import daily_totals, product_totals, with_basket
from tillwright.operators.enrich import PRODUCT_FACTS, STORE_FACTS, add_facts, clean, enrich
from tillwright.operators.quality import table_counts
from tillwright.operators.upsert import upsert
from tillwright.plans.warehouse import BUCKET, DAY, FEW_PARTS, Load, Warehouse, month_of
from tillwright.schemas import Table
from tillwright.session import build_session, cut
from tillwright.sources.files import LINE_ORDER, read_csv


@dataclass(frozen=True)
class Feed:
    """Delivered rows of one load; the orders name the columns that tell newer rows from older."""

    products: DataFrame
    stores: DataFrame
    sales: DataFrame
    order: tuple[str, ...] = ()
    dimension_order: tuple[str, ...] = ()


def csv_feed(spark: SparkSession, folder: str, multi_line: bool = False) -> Feed:
    """CSV files of one delivery; of two lines with one key the later one counts."""
    read = [read_csv(spark, f"{folder}/{name}.csv", table, multi_line, numbered=True) for name, table in (
        ("products", schemas.PRODUCTS), ("stores", schemas.STORES), ("sales_batch", schemas.SALES_BATCH))]
    return Feed(*read, LINE_ORDER, LINE_ORDER)


class BatchLoad:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.warehouse = Warehouse(spark, root, buckets)

    def load_raw(self, feed: Feed, loaded_at: Column) -> None:
        """All three raw tables in one load."""
        with self.warehouse.load() as load:
            for table, rows in ((schemas.PRODUCTS, feed.products), (schemas.STORES, feed.stores)):
                before = load.table(table) if load.parts(table) else None
                load.replace(table, upsert(before, rows, table, feed.dimension_order, loaded_at))
            load.upsert_facts(feed.sales, schemas.SALES_BATCH, feed.order, loaded_at)

    def _changed(self, load: Load, table: Table, facts: tuple[str, ...], since: int) -> DataFrame | None:
        """Keys of a dimension that are new or whose facts differ from those of load ``since``; None if there are none."""
        w, key = self.warehouse, table.key[0]
        before = tuple(n for n in load.state if n <= since)
        if w.path(table, before) == w.path(table, load.state):
            return None
        old, new = (w.table(table, s).select(key, F.struct(*facts).alias(side)) for s, side in ((before, "old"), (load.state, "new")))
        return new.join(old, key, "left").filter(~F.col("old").eqNullSafe(F.col("new"))).select(key)

    def build_staging(self, loaded_at: Column, full: bool = False) -> None:
        """Cleaned and enriched sales, in the parts of the raw ones."""
        w = self.warehouse
        with w.load() as load:
            since = None if full else max(load.parts(schemas.SALES_CLEAN).values(), default=None)
            raw = load.parts(schemas.SALES_BATCH)
            touched = dict(raw) if since is None else {part: n for part, n in raw.items() if n > since}
            for table, facts in ((schemas.PRODUCTS, PRODUCT_FACTS), (schemas.STORES, STORE_FACTS)):
                keys = self._changed(load, table, facts, since) if since is not None else None
                if keys is not None:
                    rest = w.rows(schemas.SALES_BATCH, {part: n for part, n in raw.items() if part not in touched})
                    holding = rest.select(table.key[0], DAY, BUCKET).join(keys, table.key[0], "left_semi")
                    # One row a part.
                    for row in holding.select(F.col(DAY).cast("string"), F.col(BUCKET).cast("string")).distinct().collect():
                        touched[tuple(row)] = raw[tuple(row)]
            sales = w.rows(schemas.SALES_BATCH, touched).drop("ingestion_timestamp")
            parts = sales.select("sale_id", DAY, BUCKET, *[c for c in sales.columns if c not in ("sale_id", DAY, BUCKET)])
            enriched = enrich(clean(parts), load.table(schemas.PRODUCTS), load.table(schemas.STORES), keep=(DAY, BUCKET))
            staged = enriched.withColumn("ingestion_timestamp", loaded_at.cast("timestamp_ntz"))
            load.replace_parts(schemas.SALES_CLEAN, staged, touched, spread=len(touched) > FEW_PARTS)

    def build_analytics(self, full: bool = False) -> None:
        """Store-days and product totals. Stored sale ids are unique, so rows are orders.

        A refresh adds what the touched parts of staging now hold to the stored totals and takes away
        what they held at the last build. Only months with a day of which a total or a store changed are written.
        """
        w = self.warehouse
        with w.load() as load:
            since = None if full else load.parts(schemas.PRODUCT_PERFORMANCE).get(())
            stores, products = load.table(schemas.STORES), load.table(schemas.PRODUCTS)
            now = load.parts(schemas.SALES_CLEAN)
            if since is None:
                sales = w.rows(schemas.SALES_CLEAN, now)
                load.replace(schemas.DAILY_SALES_SUMMARY, _summary(daily_totals(sales), stores))
                load.replace(schemas.PRODUCT_PERFORMANCE, _performance(product_totals(sales, "rows"), products))
                return
            before = w.parts(schemas.SALES_CLEAN, tuple(n for n in load.state if n <= since))
            touched = {part for part, n in now.items() if n > since}
            signed = w.rows(schemas.SALES_CLEAN, {p: now[p] for p in touched}).withColumn("sign", F.lit(1)).unionByName(
                w.rows(schemas.SALES_CLEAN, {p: n for p, n in before.items() if p in touched}).withColumn("sign", F.lit(-1)))
            moved = signed.withColumns({c: F.col(c) * F.col("sign") for c in ("total_amount", "quantity")})
            change = cut(daily_totals(moved, "sign").filter("total_revenue <> 0 OR total_orders <> 0 OR total_items_sold <> 0"))
            days = change.select("sale_date")
            renamed = self._changed(load, schemas.STORES, STORE_FACTS, since)
            if renamed is not None:
                days = days.unionByName(load.table(schemas.DAILY_SALES_SUMMARY).join(renamed, "store_id", "left_semi").select("sale_date"))
            # One row a month.
            months = {(str(r[0]),) for r in days.select(month_of(F.col("sale_date"))).distinct().collect()}
            held = w.rows(schemas.DAILY_SALES_SUMMARY, {
                part: n for part, n in load.parts(schemas.DAILY_SALES_SUMMARY).items() if part in months})
            totalled = _summed(held.select(*change.columns), change, ("sale_date", "store_id"))
            load.replace_parts(schemas.DAILY_SALES_SUMMARY, _summary(totalled, stores), months)
            totals = load.table(schemas.PRODUCT_PERFORMANCE)
            by_product = product_totals(moved, "rows", "sign")
            load.replace(schemas.PRODUCT_PERFORMANCE, _performance(_summed(totals.select(*by_product.columns), by_product, ("product_id",)), products))

    def run(self, feed: Feed, loaded_at: Column) -> DataFrame:
        """All three steps, and the row counts of the tables after them."""
        self.load_raw(feed, loaded_at)
        self.build_staging(loaded_at)
        self.build_analytics()
        return self.counts()

    def counts(self) -> DataFrame:
        """Rows of the stored tables; no column of them is read."""
        w = self.warehouse
        state = w.state()
        tables = (schemas.PRODUCTS, schemas.STORES, schemas.SALES_BATCH, schemas.SALES_CLEAN,
                  schemas.DAILY_SALES_SUMMARY, schemas.PRODUCT_PERFORMANCE)
        return table_counts({t.full_name: w.table(t, state) for t in tables})

    def drop_old(self, keep: int = 2) -> list[str]:
        """Delete versions that neither readers nor the next refresh need."""
        return self.warehouse.drop_old(keep, self.warehouse.loaded_at(schemas.PRODUCT_PERFORMANCE))


def _summed(held: DataFrame, change: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Totals with the change added; keys that are left without an order go."""
    orders = "total_orders" if "total_orders" in held.columns else "number_of_orders"
    sums = [F.sum(c).cast(held.schema[c].dataType).alias(c) for c in held.columns if c not in keys]
    return held.unionByName(change).groupBy(*keys).agg(*sums).filter(F.col(orders) > 0)


def _summary(totals: DataFrame, stores: DataFrame) -> DataFrame:
    return add_facts(with_basket(totals), stores, "store_id", STORE_FACTS).select(*schemas.DAILY_SALES_SUMMARY.names)


def _performance(totals: DataFrame, products: DataFrame) -> DataFrame:
    return add_facts(totals, products, "product_id", PRODUCT_FACTS).select(*schemas.PRODUCT_PERFORMANCE.names)


def main() -> None:
    parser = argparse.ArgumentParser(description="Load CSV files into the sales warehouse.")
    parser.add_argument("csv_folder")
    parser.add_argument("warehouse")
    parser.add_argument("--data-bytes", type=int, help="volume of the sales, to size shuffles")
    parser.add_argument("--buckets", type=int, default=16, help="parts of a day of sales; never change it later")
    parser.add_argument("--multi-line", action="store_true", help="fields hold line breaks, so files are not split")
    parser.add_argument("--full", action="store_true", help="compute staging and analytics from all sales")
    parser.add_argument("--take-over", action="store_true", help="give up a load that died")
    args = parser.parse_args()
    spark = build_session(data_bytes=args.data_bytes)
    load = BatchLoad(spark, args.warehouse, args.buckets)
    if args.take_over:
        load.warehouse.abandon()
    load.load_raw(csv_feed(spark, args.csv_folder, args.multi_line), F.localtimestamp())
    load.build_staging(F.localtimestamp(), args.full)
    load.build_analytics(args.full)
    load.counts().show(truncate=False)
    load.drop_old()
    load.warehouse.register()


if __name__ == "__main__":
    main()
