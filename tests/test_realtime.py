"""Realtime metrics against a replay in plain Python."""

from datetime import timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import SPARK_ERRORS, at, money
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwright.operators import realtime

START = at("2024-03-01 09:59:58.5")
SCHEMA = "sale_id string, ingestion_timestamp timestamp_ntz, total_amount decimal(10,2)"


def replay(arrivals):
    """Metric rows as a one-at-a-time upsert and query of the last five minutes gives them."""
    out, firsts, amounts = [], {}, {}
    ordered = sorted(arrivals, key=lambda a: (a[1], a[2]))
    for when in sorted({a[1] for a in ordered}):
        same = [a for a in ordered if a[1] == when]
        for sale_id, _, amount in same:
            firsts.setdefault(sale_id, when)
            amounts[sale_id] = amount
        seen = [amounts[s] for s, first in firsts.items() if first >= when - timedelta(minutes=5)]
        total = sum(seen, Decimal(0))
        basket = (total / len(seen)).quantize(Decimal("0.01"), ROUND_HALF_UP) if seen else Decimal(0)
        out += [(when, s, total, len(seen), basket) for s, _, _ in same]
    return sorted(out)


def run(spark, arrivals):
    df = spark.createDataFrame(arrivals, SCHEMA)
    return sorted(tuple(r) for r in realtime.snapshots(df).collect())


def arrival(sale_id, seconds, amount):
    return (sale_id, START + timedelta(seconds=seconds), money(amount))


def test_window_is_closed(spark):
    rows = [arrival("a", 0, 1), arrival("b", 300, 2), arrival("c", 300.000001, 4)]
    got = run(spark, rows)
    assert [r[2] for r in got] == [money(1), money(3), money(6)]
    assert got == replay(rows)


def test_redelivery_inside_the_window(spark):
    rows = [arrival("a", 0, 10), arrival("a", 120, 11), arrival("b", 300, 1), arrival("c", 301, 1)]
    got = run(spark, rows)
    assert [(r[2], r[3]) for r in got] == [(money(10), 1), (money(11), 1), (money(12), 2), (money(2), 2)]


def test_redelivery_after_the_window(spark):
    got = run(spark, [arrival("a", 0, 10), arrival("a", 600, 11)])
    assert [r[2:] for r in got] == [(money(10), 1, money(10)), (money(0), 0, money(0))]


def test_arrivals_at_one_instant_see_each_other(spark):
    rows = [arrival("a", 0, 1), arrival("b", 0, 2), arrival("c", 7, 4)]
    assert run(spark, rows) == replay(rows)
    assert [r[3] for r in run(spark, rows)] == [2, 2, 3]


def test_hot_sale_instant_and_tick(spark):
    rows = [arrival("hot", i * 0.9, 1 + i) for i in range(500)]
    rows += [arrival(f"x{i}", 40, 1) for i in range(300)]
    rows += [arrival(f"y{i}", 41 + i / 1_000_000, 1) for i in range(300)]
    assert run(spark, rows) == replay(rows)


moments = st.one_of(st.integers(0, 2400), st.sampled_from([0, 300, 600, 1073.741824, 1073.741823, 1.048576]))
arrivals = st.lists(st.tuples(st.sampled_from("abcdef"), moments, st.integers(0, 9)), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(arrivals)
def test_any_redeliveries(spark, events):
    rows = [arrival(*e) for e in events]
    assert run(spark, rows) == replay(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(moments, st.integers(0, 9)), min_size=1, max_size=25))
def test_any_single_deliveries(spark, events):
    rows = [arrival(f"s{i}", when, amount) for i, (when, amount) in enumerate(events)]
    assert run(spark, rows) == replay(rows)


def test_no_single_task_holds_everything(spark):
    rows = spark.createDataFrame([arrival("a", 0, 1)], SCHEMA)
    plan = realtime.snapshots(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_null_key_is_an_error(spark):
    with pytest.raises(SPARK_ERRORS, match="NULL in sale_id"):
        run(spark, [arrival(None, 0, 1)])


def test_equal_instants_follow_the_upsert(spark):
    """Two payloads in one microsecond: the metric shows the one that is stored."""
    schema = "sale_id string, product_id string, total_amount decimal(10,2), ingestion_timestamp timestamp_ntz"
    rows = [("a", "P1", money(5), START), ("a", "P2", money(1), START)]
    got = realtime.snapshots(spark.createDataFrame(rows, schema)).collect()
    assert [r.total_revenue for r in got] == [money(1), money(1)]


@pytest.mark.parametrize("now, want", [("2024-03-01 10:05:00", (3, 2, "1.50")), ("2024-03-01 11:00:00", (0, 0, "0"))])
def test_stored_sales_of_a_window(spark, now, want):
    sales = spark.createDataFrame(
        [("a", at("2024-03-01 10:00:00"), money(1)), ("b", at("2024-03-01 10:01:00"), money(2)),
         ("c", at("2024-03-01 09:59:59"), money(9))], SCHEMA)
    got = realtime.window_metrics(sales, F.lit(now).cast("timestamp_ntz")).first()
    assert (got.total_revenue, got.total_orders, got.average_basket) == (money(want[0]), want[1], money(want[2]))


def test_sales_that_arrive_once_need_no_look_back(spark):
    """The rows are those of looking back for all."""
    arrivals = spark.createDataFrame([arrival(s, 200 + n, n + 1) for n, s in enumerate("abcadbeaf")] + [arrival("late", 900, 3)], SCHEMA)
    before = spark.createDataFrame([arrival("a", 0, 7), arrival("old", 150, 2), arrival("late", 100, 1)], SCHEMA)
    again = realtime.repeated_sales(arrivals, before)
    assert sorted(r.sale_id for r in again.collect()) == ["a", "b", "late"]
    stored = spark.createDataFrame(again.collect(), again.schema)
    told = realtime.snapshots(arrivals, before, stored)
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, realtime.snapshots(arrivals, before).collect()))
    assert len(told.collect()) == 10
