"""Keyed upserts and published tables."""

from datetime import timedelta

import pytest
from conftest import at, money
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.operators.upsert import latest_by_key, replay_upserts, upsert
from tillwright.plans import warehouse
from tillwright.plans.batch import BatchLoad, Feed
from tillwright.plans.warehouse import Warehouse

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def time(text):
    return F.lit(text).cast("timestamp_ntz")


def price_list(spark, *rows):
    return spark.createDataFrame(
        [(i, n, "Home", money(p), 1) for i, n, p in rows], schemas.PRODUCTS.struct(only_fed=True))


def test_changed_price_keeps_created_at(spark):
    first = upsert(None, price_list(spark, ("P001", "Lamp", 5), ("P002", "Desk", 9)), schemas.PRODUCTS, (), time(T0))
    got = upsert(first, price_list(spark, ("P001", "Lamp", 6), ("P003", "Sofa", 7)), schemas.PRODUCTS, (), time(T1))
    assert {r.product_id: (r.unit_price, r.created_at) for r in got.collect()} == {
        "P001": (money(6), at(T0)), "P002": (money(9), at(T0)), "P003": (money(7), at(T1))}


def test_null_overwrites(spark):
    first = upsert(None, price_list(spark, ("P001", "Lamp", 5)), schemas.PRODUCTS, (), time(T0))
    got = upsert(first, price_list(spark, ("P001", None, 5)), schemas.PRODUCTS, (), time(T1)).first()
    assert got.product_name is None


def test_repeated_key_in_one_batch(sales_frame, sale):
    sales = sales_frame([sale("a", amount="1.00"), sale("a", amount="2.00")]).withColumn(
        "n", F.when(F.col("total_amount") > 1, 1).otherwise(2))
    got = upsert(None, sales, schemas.SALES_BATCH, ("n",), time(T0)).collect()
    assert [(r.sale_id, r.total_amount) for r in got] == [("a", money("1.00"))]


def test_null_key_fails_the_load(sales_frame, sale):
    with pytest.raises(PySparkException, match="NULL in key column sale_id"):
        upsert(None, sales_frame([sale(None)]), schemas.SALES_BATCH, (), time(T0)).collect()


deliveries = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(1, 9), st.integers(0, 5)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(deliveries)
def test_batches_equal_their_concatenation(spark, batch):
    batch = [(k, amount, i) for i, (k, amount, _) in enumerate(batch)]
    half = len(batch) // 2

    def frame(rows):
        rows = [(k, "P001", "S001", "C", 1, money(a), money(a), "card", at(T0), n) for k, a, n in rows]
        return spark.createDataFrame(rows, schemas.SALES_BATCH.struct(only_fed=True).add("n", "integer"))

    target = upsert(None, frame(batch[:half]), schemas.SALES_BATCH, ("n",), time(T0)) if half else None
    twice = upsert(target, frame(batch[half:]), schemas.SALES_BATCH, ("n",), time(T1))
    again = upsert(twice, frame(batch[half:]), schemas.SALES_BATCH, ("n",), time(T1))
    want = {}
    for i, (k, amount, _) in enumerate(batch):
        want[k] = (money(amount), want.get(k, (0, at(T0) if i < half else at(T1)))[1])
    for got in (twice, again):
        assert {r.sale_id: (r.total_amount, r.ingestion_timestamp) for r in got.collect()} == want


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id", F.lit("x").alias("v"))
    got = latest_by_key(rows, ["k"], ["id"], None)
    assert got.filter("k = -1").count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_replay_keeps_first_arrival(sales_frame, sale):
    rows = [sale("a", amount="1.00", ingested="2024-03-01 10:00:00"),
            sale("a", amount="2.00", ingested="2024-03-01 10:02:00"),
            sale("b", amount="5.00", ingested="2024-03-01 10:01:00")]
    got = replay_upserts(sales_frame(rows, schemas.SALES_STREAM), schemas.SALES_STREAM, "ingestion_timestamp")
    assert {r.sale_id: (r.total_amount, r.ingestion_timestamp) for r in got.collect()} == {
        "a": (money(2), at("2024-03-01 10:00:00")), "b": (money(5), at("2024-03-01 10:01:00"))}


def rows_of(w, table):
    return sorted(map(str, w.table(table).collect()))


def test_facts_rewrite_touched_parts_only(spark, sales_frame, sale, tmp_path):
    stored = Warehouse(spark, str(tmp_path), buckets=2)
    days = [at(T0) + timedelta(days=i) for i in range(3)]
    stored.upsert_facts(sales_frame([sale("a"), sale("b")]), schemas.SALES_BATCH, (), time(str(days[0])))
    stored.upsert_facts(sales_frame([sale("c")]), schemas.SALES_BATCH, (), time(str(days[1])))
    untouched = {p: n for p, n in stored.parts(schemas.SALES_BATCH).items() if p[0] == "2024-01-02"}
    for _ in range(2):
        stored.upsert_facts(sales_frame([sale("a", amount="7.00"), sale("d")]), schemas.SALES_BATCH, (), time(str(days[2])))
        got = {r.sale_id: (r.total_amount, r.ingestion_timestamp) for r in stored.table(schemas.SALES_BATCH).collect()}
        assert got == {"a": (money(7), days[0]), "b": (money(10), days[0]),
                       "c": (money(10), days[1]), "d": (money(10), days[2])}
    assert len(untouched) == 1 and untouched.items() <= stored.parts(schemas.SALES_BATCH).items()


RAW = (schemas.PRODUCTS, schemas.STORES, schemas.SALES_BATCH)


def test_facts_break_off_without_a_trace(spark, sales_frame, sale, products, stores, tmp_path, monkeypatch):
    """A load that fails while it writes, or whose driver dies before the switch, leaves all rows as they were."""
    load = BatchLoad(spark, str(tmp_path), buckets=2)
    w = load.warehouse
    load.load_raw(Feed(products, stores, sales_frame([sale("a"), sale("b")])), time(T0))
    before = [rows_of(w, t) for t in RAW]
    more = Feed(products.withColumn("unit_price", F.lit("9.99").cast("decimal(10,2)")), stores, sales_frame([sale("a", amount="99.00"), sale("c")]))
    bad_store = stores.withColumn("store_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        load.load_raw(Feed(more.products, bad_store, more.sales), time(T1))
    assert [rows_of(w, t) for t in RAW] == before

    def gone(*args):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr("tillwright.plans.warehouse.storage.rename", gone)
        with pytest.raises(OSError, match="gone"):
            load.load_raw(more, time(T1))
    assert [rows_of(w, t) for t in RAW] == before
    with pytest.raises(FileExistsError, match="under way"):  # its mark is still there
        load.load_raw(more, time(T1))
    assert w.abandon() == [3]
    load.load_raw(more, time(T1))
    assert w.table(schemas.SALES_BATCH).count() == 3 and w.state() == (1, 4)
    assert {"load=2", "load=3"} & {p.rsplit("/", 1)[1] for p in w.drop_old()}
    assert w.table(schemas.SALES_BATCH).count() == 3


def test_interleaved_loads_lose_nothing(spark, sales_frame, sale, products, stores, tmp_path, monkeypatch):
    """A load that starts while another is between reading and publishing fails; neither is lost without an error."""
    one, two = (BatchLoad(spark, str(tmp_path), buckets=2) for _ in range(2))
    feeds = [Feed(products, stores, sales_frame([sale(k) for k in keys])) for keys in ("ab", "bc")]
    upsert_facts, met = warehouse.Load.upsert_facts, []

    def interrupted(self, *args):
        if not met:
            met.append(None)
            for step in (lambda: two.load_raw(feeds[1], time(T1)), lambda: two.build_staging(time(T1)), two.build_analytics):
                with pytest.raises(FileExistsError):
                    step()
        return upsert_facts(self, *args)

    monkeypatch.setattr(warehouse.Load, "upsert_facts", interrupted)
    one.load_raw(feeds[0], time(T0))
    assert {r.sale_id for r in one.warehouse.table(schemas.SALES_BATCH).collect()} == {"a", "b"}
    two.load_raw(feeds[1], time(T1))
    assert {r.sale_id for r in one.warehouse.table(schemas.SALES_BATCH).collect()} == {"a", "b", "c"}


def test_many_folders_are_listed_by_spark(spark, sales_frame, sale, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path), buckets=2)
    w.upsert_facts(sales_frame([sale(str(i)) for i in range(9)]), schemas.SALES_BATCH, (), time(T0))
    w.upsert_facts(sales_frame([sale("8")]), schemas.SALES_BATCH, (), time(T1))
    here = sorted(w.versions(schemas.SALES_BATCH))
    monkeypatch.setattr(warehouse, "LISTED_HERE", 0)
    assert sorted(w.versions(schemas.SALES_BATCH)) == here and len(here) == 3
    assert w.table(schemas.SALES_BATCH).count() == 9


def test_a_number_is_taken_once(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path))
    with w.load():
        pass
    # A second load saw nothing under way, then the first took the number and was published.
    marked, seen = Warehouse._marked, iter([[], []])
    monkeypatch.setattr(Warehouse, "_marked", lambda self, *kinds: next(seen, None) if (found := marked(self, *kinds)) is None else next(seen, found))
    with pytest.raises(FileExistsError, match="taken by another"):
        w._begin()
    assert w.abandon() == []


def test_source_is_reduced_before_the_key_lookup(spark, sales_frame, sale, tmp_path, monkeypatch):
    """A sale that holds a third of the deliveries is one row when keys are looked up."""
    w = Warehouse(spark, str(tmp_path), buckets=1)
    w.upsert_facts(sales_frame([sale("hot")]), schemas.SALES_BATCH, (), time(T0))
    lookup, looked = warehouse.rows_of_keys, []
    monkeypatch.setattr(warehouse, "rows_of_keys",
                        lambda stored, delivered, keys: looked.append(delivered.count()) or lookup(stored, delivered, keys))
    w.upsert_facts(sales_frame([sale("hot", amount=str(i)) for i in range(300)] + [sale(str(i)) for i in range(600)]),
                   schemas.SALES_BATCH, (), time(T1))
    assert w.table(schemas.SALES_BATCH).filter("sale_id = 'hot'").first().total_amount == money(299)
    assert looked == [601]


def scanned(df, name):
    """A metric of the file scans of a plan that has run, summed."""

    def nodes(plan):
        yield plan
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from nodes(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from nodes(plan.plan())
        children = plan.children()
        for i in range(children.size()):
            yield from nodes(children.apply(i))

    found = [n.metrics().get(name).get().value() for n in nodes(df._jdf.queryExecution().executedPlan())
             if n.getClass().getSimpleName() == "FileSourceScanExec"]
    return sum(found)


@pytest.mark.parametrize("few", [True, False])
def test_stored_sales_are_not_shuffled(spark, sales_frame, sale, tmp_path, monkeypatch, few):
    """Row groups without a delivered key are not read; those with one go to new files as they are."""
    w = Warehouse(spark, str(tmp_path), buckets=2)
    rows = [sale(f"S{i:05d}", amount=str(i % 90)) for i in range(3000)]
    for n in range(3):
        w.upsert_facts(sales_frame(rows[n::3]), schemas.SALES_BATCH, (), time(f"2024-01-0{n + 1} 00:00:00"))
    frames, write = [], warehouse.Load.replace_parts
    monkeypatch.setattr(warehouse.Load, "replace_parts", lambda self, table, rows, *a, **k: frames.append(rows) or write(self, table, rows, *a, **k))
    lookups, lookup = [], warehouse.rows_of_keys

    def seen(*args):
        lookups.append(lookup(*args, few=1000 if few else 0))
        lookups[0].collect()
        return lookups[0]

    monkeypatch.setattr(warehouse, "rows_of_keys", seen)
    w.upsert_facts(sales_frame([sale("S00004", amount="55.00"), sale("new")]), schemas.SALES_BATCH, (), time("2024-02-01 00:00:00"))
    plan = frames[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and "FullOuter" not in plan
    physical = frames[0]._jdf.queryExecution().executedPlan().toString()
    stored_side = physical.split("+- Exchange hashpartitioning(load_day", 1)[0]
    assert "BroadcastHashJoin" in stored_side and "LeftOuter" in stored_side and "hashpartitioning" not in stored_side
    if few:
        assert scanned(lookups[0], "numOutputRows") <= 1000  # of 3,000
    got = {r.sale_id: r.total_amount for r in w.table(schemas.SALES_BATCH).collect()}
    assert len(got) == 3001 and got["S00004"] == money(55) and got["S00005"] == money(5)


def test_large_deliveries_are_joined_by_key(spark, sales_frame, sale, tmp_path, monkeypatch):
    lookup = warehouse.rows_of_keys
    monkeypatch.setattr(warehouse, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(warehouse, "rows_of_keys", lambda *a: lookup(*a, few=1))
    w = Warehouse(spark, str(tmp_path), buckets=3)
    w.upsert_facts(sales_frame([sale(str(i)) for i in range(40)]), schemas.SALES_BATCH, (), time(T0))
    w.upsert_facts(sales_frame([sale(str(i), amount="3.00") for i in range(20, 60)]), schemas.SALES_BATCH, (), time(T1))
    got = {r.sale_id: (r.total_amount, r.ingestion_timestamp) for r in w.table(schemas.SALES_BATCH).collect()}
    assert got == {str(i): (money(10 if i < 20 else 3), at(T0 if i < 40 else T1)) for i in range(60)}


def test_a_large_delivery_is_joined_once_and_written_from_there(spark, sales_frame, sale, tmp_path, monkeypatch):
    """Nothing is looked up in empty facts; after that, parts without a delivered key stay, whichever lookup tells."""
    monkeypatch.setattr(warehouse, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(warehouse, "LOOKUP_KEYS", 1)
    plans, write = [], warehouse.Load.replace_parts

    def seen(self, table, rows, touched, spread=True):
        plans.append((rows._jdf.queryExecution().optimizedPlan().toString(), spread))
        write(self, table, rows, touched, spread)

    monkeypatch.setattr(warehouse.Load, "replace_parts", seen)
    w = Warehouse(spark, str(tmp_path), buckets=2)
    for n in range(3):
        w.upsert_facts(sales_frame([sale(f"{n}-{i}") for i in range(20)]), schemas.SALES_BATCH, (), time(f"2024-01-0{n + 1} 00:00:00"))
    w.upsert_facts(sales_frame([sale(f"{n}-{i}", amount="3.00") for n in (0, 2) for i in range(20)]), schemas.SALES_BATCH, (), time("2024-02-01 00:00:00"))
    assert [plan.count("Join ") for plan, _ in plans] == [0, 1, 1, 1] and not any(spread for _, spread in plans)
    assert all("Join FullOuter" in plan for plan, _ in plans[1:])
    held = w.parts(schemas.SALES_BATCH)
    assert {part[0]: n for part, n in held.items()} == {"2024-01-01": 4, "2024-01-02": 2, "2024-01-03": 4}
    got = {r.sale_id: (r.total_amount, r.ingestion_timestamp) for r in w.table(schemas.SALES_BATCH).collect()}
    assert got == {f"{n}-{i}": (money(10 if n == 1 else 3), at(f"2024-01-0{n + 1} 00:00:00")) for n in range(3) for i in range(20)}


def test_load_refuses_what_the_declaration_forbids(spark, sales_frame, sale, products, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for bad in (sale("a", payment=None), sale("a", product_id="P" * 90)):
        with pytest.raises(PySparkException, match="is broken by"):
            w.upsert_facts(sales_frame([sale("b"), bad]), schemas.SALES_BATCH, (), time(T0))
    with pytest.raises(PySparkException, match="not_null of category"):
        w.publish({schemas.PRODUCTS: products.withColumn("category", F.lit(None).cast("string")).withColumn("created_at", time(T0))})
    assert w.state() == ()


def test_views_show_the_loads_and_cannot_be_written(spark, sales_frame, sale, products, stores, tmp_path):
    load = BatchLoad(spark, str(tmp_path), buckets=2)
    load.run(Feed(products, stores, sales_frame([sale("a"), sale("b")])), time(T0))
    names = load.warehouse.register("shown_")
    assert len(names) == 6 and spark.sql("SELECT count(*) FROM shown_raw.products").first()[0] == 2
    load.run(Feed(products, stores, sales_frame([sale("a", amount="4.00"), sale("c")])), time(T1))
    assert spark.table("shown_raw.sales_batch").count() == 2  # as of its load
    load.warehouse.register("shown_")
    for table in (schemas.SALES_BATCH, schemas.SALES_CLEAN, schemas.DAILY_SALES_SUMMARY, schemas.PRODUCT_PERFORMANCE):
        shown = spark.table(f"shown_{table.full_name}")
        assert sorted(map(str, shown.collect())) == rows_of(load.warehouse, table)
        assert shown.columns == table.names and [f.dataType for f in shown.schema] == [f.dataType for f in table.struct()]
    with pytest.raises(PySparkException):
        spark.sql("INSERT INTO shown_raw.stores VALUES ('S1', 'n', 'c', 'r', TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    assert spark.table("shown_raw.stores").count() == 2
    for name in names:
        spark.sql(f"DROP VIEW {name}")


def test_a_table_of_the_catalog_is_never_replaced(spark, products, stores, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.publish({t: f.withColumn("created_at", time(T0)) for t, f in ((schemas.PRODUCTS, products), (schemas.STORES, stores))})
    spark.sql("CREATE DATABASE IF NOT EXISTS kept_raw")
    spark.sql("CREATE TABLE kept_raw.stores (store_id STRING) USING parquet")
    spark.sql("INSERT INTO kept_raw.stores VALUES ('mine')")
    with pytest.raises(ValueError, match="kept_raw.stores"):
        w.register("kept_")
    assert spark.table("kept_raw.stores").first().store_id == "mine"
    assert not spark.catalog.tableExists("kept_raw.products")
    spark.sql("DROP TABLE kept_raw.stores")


def test_failed_load_leaves_tables_as_they_were(spark, products, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    with pytest.raises(LookupError):
        w.table(schemas.PRODUCTS)
    loaded = products.withColumn("created_at", time(T0))
    w.publish({schemas.PRODUCTS: loaded})
    broken = loaded.withColumn("product_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        w.publish({schemas.PRODUCTS: loaded.limit(1), schemas.STORES: broken.select(
            F.col("product_id").alias("store_id"), F.col("product_name").alias("store_name"),
            F.lit("c").alias("city"), F.lit("r").alias("region"), "created_at")})
    assert w.table(schemas.PRODUCTS).count() == 2
    w.publish({schemas.PRODUCTS: loaded.limit(1)})
    assert w.table(schemas.PRODUCTS).count() == 1


def test_old_versions_are_dropped(spark, products, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    assert w.drop_old() == []
    paths = []
    for n in (2, 1, 2):
        w.publish({schemas.PRODUCTS: products.limit(n).withColumn("created_at", time(T0))})
        paths.append(w.path(schemas.PRODUCTS))
    assert w.drop_old() == paths[:1] and w.drop_old() == []
    assert w.drop_old(keep=0, needed=3) == []
    assert w.drop_old(keep=0) == [paths[1]]
    assert w.table(schemas.PRODUCTS).count() == 2


def test_batch_load_twice(spark, sales_frame, sale, products, stores, tmp_path):
    load = BatchLoad(spark, str(tmp_path))
    feed = Feed(products, stores, sales_frame([sale("a"), sale("b", quantity=0), sale("c", product_id="P002")]))
    counts = {r.table_name: r.row_count for r in load.run(feed, time(T0)).collect()}
    assert counts == {"raw.products": 2, "raw.stores": 2, "raw.sales_batch": 3, "staging.sales_clean": 2,
                      "analytics.daily_sales_summary": 1, "analytics.product_performance": 2}
    more = Feed(products, stores, sales_frame([sale("a", amount="99.00"), sale("d")]))
    counts = {r.table_name: r.row_count for r in load.run(more, time(T1)).collect()}
    assert counts["raw.sales_batch"] == 4 and counts["staging.sales_clean"] == 3
    daily = load.warehouse.table(schemas.DAILY_SALES_SUMMARY).first()
    assert (daily.total_revenue, daily.total_orders) == (money(119), 3)
    assert load.warehouse.table(schemas.PRODUCTS).select("created_at").distinct().collect()[0][0] == at(T0)


def test_counts_read_no_column(spark, sales_frame, sale, products, stores, tmp_path):
    load = BatchLoad(spark, str(tmp_path), buckets=2)
    plan = load.run(Feed(products, stores, sales_frame([sale("a")])), time(T0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 6


BUILT = (schemas.DAILY_SALES_SUMMARY, schemas.PRODUCT_PERFORMANCE)


def as_full(load, stamp):
    """What a full build gives; it becomes current too."""
    load.build_staging(time(stamp), full=True)
    load.build_analytics(full=True)
    clean = load.warehouse.table(schemas.SALES_CLEAN).drop("ingestion_timestamp")
    return [sorted(map(str, clean.collect())), *(rows_of(load.warehouse, t) for t in BUILT)]


def refreshed(load):
    clean = load.warehouse.table(schemas.SALES_CLEAN).drop("ingestion_timestamp")
    return [sorted(map(str, clean.collect())), *(rows_of(load.warehouse, t) for t in BUILT)]


def test_refresh_rewrites_one_month_and_equals_a_full_build(spark, sales_frame, sale, products, stores, tmp_path):
    load = BatchLoad(spark, str(tmp_path), buckets=2)
    first = [sale(f"s{m}{i}", product_id=f"P00{i % 3}", store_id=f"S00{i % 4}", when=f"2024-0{m}-0{i % 2 + 3} 10:00:00") for m in range(1, 6) for i in range(6)]
    load.run(Feed(products, stores, sales_frame(first)), time(T0))
    before = load.warehouse.parts(schemas.DAILY_SALES_SUMMARY)
    assert set(before) == {(f"2024-0{m}-01",) for m in range(1, 6)}
    load.run(Feed(products, stores, sales_frame([sale("n1", when="2024-03-03 23:00:00", amount="7.77"), sale("n2", when="2024-03-03 01:00:00")])), time(T1))
    after = load.warehouse.parts(schemas.DAILY_SALES_SUMMARY)
    assert {p for p in after if after[p] != before[p]} == {("2024-03-01",)}
    load.drop_old()
    got = refreshed(load)
    assert got == as_full(load, T1)


def test_refresh_follows_corrections_and_dimensions(spark, sales_frame, sale, products, stores, tmp_path):
    """Amounts, days and stores that change, sales that become unclean, days that empty, products and stores renamed or new."""
    load = BatchLoad(spark, str(tmp_path), buckets=2)
    rows = [sale(f"s{i}", product_id=f"P00{i % 4}", store_id=f"S00{i % 4}", when=f"2024-03-0{i % 5 + 1} 10:00:00", amount=f"{i}.25") for i in range(20)]
    load.run(Feed(products, stores, sales_frame(rows)), time(T0))
    steps = [
        (products.withColumn("category", F.lit("Other")).limit(1), stores, [
            sale("s1", amount="0.50", when="2024-03-09 10:00:00"), sale("s2", quantity=0), sale("s6", store_id="S003", product_id="P001"),
            sale("t1", when="2024-04-01 00:00:00")]),
        (spark.createDataFrame([("P003", "New", "Fresh", money(1), 1)], products.schema), stores.withColumn("city", F.concat(F.col("city"), F.lit("!"))), [
            sale("t1", quantity=0, when="2024-04-01 00:00:00"), *[sale(f"s{i}", quantity=0) for i in range(0, 20, 5)]]),
    ]
    for n, (p, s, sales) in enumerate(steps):
        stamp = f"2024-02-0{n + 1} 00:00:00"
        load.run(Feed(p, s, sales_frame(sales)), time(stamp))
        load.drop_old(keep=1)
        got, again = refreshed(load), BatchLoad(spark, str(tmp_path / f"full{n}"), buckets=2)
        w = load.warehouse
        with again.warehouse.load() as copy:
            for t in (schemas.PRODUCTS, schemas.STORES):
                copy.replace(t, w.table(t))
            copy.replace_parts(schemas.SALES_BATCH, w.rows(schemas.SALES_BATCH, w.parts(schemas.SALES_BATCH)), ())
        assert got == as_full(again, stamp), n
