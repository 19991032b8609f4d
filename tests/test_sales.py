"""Cleaning, enrichment, aggregates and reports on small hand-written rows."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import at, money
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.functions.money import exact_average
from tillwright.operators import aggregates, enrich, reports


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_dirty_rows(sales_frame, sale):
    dirty = [sale(None), sale("zero", quantity=0), sale("minus", quantity=-1), sale("none", quantity=None),
             sale("refund", amount="-0.01"), sale("no-amount", amount=None), sale("free", amount="0.00")]
    sales = sales_frame(dirty)
    assert [r.sale_id for r in enrich.clean(sales).collect()] == ["free"]


def test_orphans_keep_their_row(sales_frame, sale, products, stores):
    sales = sales_frame([sale("a"), sale("b", product_id="P999"), sale("c", store_id="S999")])
    got = {r.sale_id: r for r in enrich.enrich(sales, products, stores).collect()}
    assert len(got) == 3
    assert got["b"].category is None and got["b"].city == "Lyon"
    assert got["c"].city is None and got["c"].category == "Home"
    assert (got["a"].sale_date, got["a"].sale_hour) == (date(2024, 3, 1), 10)
    assert list(got["a"].asDict()) == schemas.SALES_CLEAN.fed


def test_sale_price_wins_over_catalogue_price(sales_frame, sale, products, stores):
    got = enrich.enrich(sales_frame([sale(price="3.50")]), products, stores).first()
    assert got.unit_price == money("3.50")


def test_orphans_group_under_null(sales_frame, sale, products, stores):
    sales = enrich.add_time_parts(sales_frame([sale("a"), sale("b", store_id="S999"), sale("c", store_id="S998")]))
    cities = rows(reports.city_sales(aggregates.daily_sales_summary(sales, stores)))
    assert cities == [(None, money(20), 2), ("Lyon", money(10), 1)]
    performance = aggregates.product_performance(sales_frame([sale("a"), sale("b", product_id="P999")]), products)
    assert {r[0] for r in rows(reports.category_sales(performance))} == {None, "Home"}


def test_distinct_and_row_counts(sales_frame, sale, stores):
    sales = enrich.add_time_parts(sales_frame([sale("a"), sale("a"), sale("b")]))
    assert aggregates.daily_sales_summary(sales, stores, "distinct").first().total_orders == 2
    assert aggregates.daily_sales_summary(sales, stores, "rows").first().total_orders == 3


def test_half_cent_average_is_not_rounded_twice(spark):
    sums = spark.createDataFrame([
        (Decimal("1000.00"), 200_001, Decimal("0.00")),
        (Decimal("1000.00"), 200_000, Decimal("0.01")),
        (Decimal("-1000.00"), 200_000, Decimal("-0.01")),
        (Decimal("10.00"), 3, Decimal("3.33")),
        (Decimal("20.00"), 3, Decimal("6.67")),
        (Decimal("99999999999999999.99"), 4_000_000_000_000, Decimal("25000.00")),
        (Decimal("1.00"), 0, None),
        (None, 1, None),
    ], "total decimal(20,2), n bigint, want decimal(10,2)")
    got = sums.select(exact_average(F.col("total"), F.col("n")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_basket_is_weighted(sales_frame, sale, stores):
    few = [sale("a", amount="10.00")]
    many = [sale(f"b{i}", store_id="S002", amount="1.00") for i in range(9)]
    daily = aggregates.daily_sales_summary(enrich.add_time_parts(sales_frame(few + many)), stores)
    assert rows(reports.daily_sales(daily)) == [(date(2024, 3, 1), money(19), 10, 10, money("1.90"))]
    assert rows(reports.batch_kpis(daily)) == [(money(19), 10, 10, money("1.90"))]


def test_no_sales(sales_frame, stores, products):
    none = enrich.add_time_parts(sales_frame([]))
    daily = aggregates.daily_sales_summary(none, stores)
    assert rows(reports.batch_kpis(daily)) == [(money(0), 0, 0, money(0))]
    assert rows(reports.daily_sales(daily)) == []
    assert rows(reports.top_products(aggregates.product_performance(none, products))) == []


def test_display(spark):
    kpis = spark.createDataFrame([(Decimal("1234567.50"), 1200, 5, Decimal("3.10"))],
                                 "total_revenue decimal(30,2), total_orders bigint, total_items_sold bigint, "
                                 "average_basket decimal(10,2)")
    assert rows(reports.kpi_display(kpis)) == [("1,234,567.50 €", "1,200", "5", "3.10 €")]


def test_top_products_breaks_ties_by_id(spark):
    performance = spark.createDataFrame(
        [(f"P{i:03}", f"n{i}", "c", Decimal("5.00"), 1, 1) for i in range(12, 0, -1)],
        schemas.PRODUCT_PERFORMANCE.struct())
    assert [r[0] for r in rows(reports.top_products(performance))] == [f"n{i}" for i in range(1, 11)]


def test_shares_add_up(spark):
    performance = spark.createDataFrame(
        [("P1", "a", "x", Decimal("30.00"), 1, 1), ("P2", "b", "y", Decimal("10.00"), 1, 1)],
        schemas.PRODUCT_PERFORMANCE.struct())
    assert {r[0]: r[2] for r in rows(reports.category_revenue_share(performance))} == {"x": 0.75, "y": 0.25}


def test_newest_sales_with_facts(sales_frame, sale, products, stores):
    sales = sales_frame([sale(f"s{i:02}", product_id="P001" if i % 2 else "P999",
                              ingested=f"2024-03-01 10:00:{i:02}") for i in range(30)], schemas.SALES_STREAM)
    got = reports.recent_stream_sales(sales, products, stores).collect()
    assert [r.sale_id for r in got] == [f"s{i:02}" for i in range(29, 9, -1)]
    assert [r.category for r in got[:2]] == ["Home", None]
    by_time = reports.recent_by_sale_time(sales).collect()
    assert [r.sale_id for r in by_time] == ["s29", "s28", "s27", "s26", "s25"]


def test_revenue_is_conserved(spark):
    from conftest import SMALL
    from tillwright.operators.upsert import replay_upserts
    from tillwright.sources import star

    raw = replay_upserts(star.sales_arrivals(spark, SMALL), schemas.SALES_BATCH, star.ARRIVAL)
    sales = enrich.add_time_parts(enrich.clean(raw))
    daily = aggregates.daily_sales_summary(sales, star.stores(spark, SMALL), "rows")
    performance = aggregates.product_performance(sales, star.products(spark, SMALL), "rows")
    totals = [df.agg(F.sum(c)).first()[0] for df, c in (
        (sales, "total_amount"), (daily, "total_revenue"), (performance, "total_revenue"))]
    assert totals[0] == totals[1] == totals[2]
    enriched = enrich.enrich(raw, star.products(spark, SMALL), star.stores(spark, SMALL))
    assert enriched.count() == raw.count()


@pytest.mark.parametrize("text", ["2024-03-31 02:30:00", "1969-12-31 23:59:59", "2024-02-29 00:00:00"])
def test_times_do_not_depend_on_the_session_zone(spark, text):
    from tillwright.functions.times import floor_to, format_time, from_micros, micros, parse_time

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        row = spark.createDataFrame([(text,)], "t string").select(
            parse_time(F.col("t")).alias("ts")).select(
            "ts", format_time(F.col("ts")).alias("text"), micros(F.col("ts")).alias("us"),
            floor_to(micros(F.col("ts")), 1 << 20).alias("tick")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.text == text and row.ts == at(text) and from_micros(row.us) == at(text)
    assert row.tick <= row.us < row.tick + (1 << 20) and row.tick % (1 << 20) == 0
