"""Files, declared tables, constraints, counts, schema listings and database options."""

import pytest
from conftest import SPARK_ERRORS, at, money
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.functions.ids import format_id
from tillwright.operators import quality
from tillwright.plans.batch import BatchLoad, csv_feed
from tillwright.session import cut, scratch_path, shared_dir
from tillwright.sources import files, jdbc


def test_csv_round_trip(spark, sales_frame, sale, tmp_path):
    sales = sales_frame([sale("a"), sale("b", amount="0.00", when="2024-12-31 23:59:59")])
    files.write_csv(sales, str(tmp_path / "csv"))
    assert sorted(files.read_csv(spark, str(tmp_path / "csv"), schemas.SALES_BATCH).collect()) == sorted(sales.collect())


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, stores, tmp_path):
    texts = [' pad ', '""', 'a "b", c', "", None, "back\\slash", "two\nlines"]
    rows = [(f"S{i}", t, "c", "r") for i, t in enumerate(texts)]
    files.write_csv(spark.createDataFrame(rows, schemas.STORES.struct(only_fed=True)), str(tmp_path / "csv"))
    got = files.read_csv(spark, str(tmp_path / "csv"), schemas.STORES, multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows, key=lambda r: r[0])
    (tmp_path / "s.csv").write_text('store_id,store_name,city,region\nS1,"He said ""hi""",Lyon,r\n')
    assert files.read_csv(spark, str(tmp_path / "s.csv"), schemas.STORES).first().store_name == 'He said "hi"'


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("store_id,store_name,city,region\nS1,n,c,r\n")
    (tmp_path / "b.csv").write_text("store_id,city,store_name,region\nS2,c,n,r\n")
    with pytest.raises(SPARK_ERRORS):
        files.read_csv(spark, str(tmp_path), schemas.STORES).collect()


def test_later_line_of_a_delivery_wins(spark, tmp_path):
    header = ",".join(schemas.SALES_BATCH.fed)
    line = "BATCH-1,{},S001,CUST-1,2,5.00,{},card,2024-03-01 08:00:00"
    (tmp_path / "sales_batch.csv").write_text("\n".join([header, line.format("P9", "20.00"), line.format("P1", "10.00")]) + "\n")
    (tmp_path / "products.csv").write_text("product_id,product_name,category,unit_price,stock_quantity\nP1,z,b,1,1\nP1,a,b,1,1\n")
    (tmp_path / "stores.csv").write_text("store_id,store_name,city,region\nS001,n,c,r\n")
    load = BatchLoad(spark, str(tmp_path / "w"), buckets=1)
    load.load_raw(csv_feed(spark, str(tmp_path)), F.lit("2024-03-02 00:00:00").cast("timestamp_ntz"))
    assert load.warehouse.table(schemas.SALES_BATCH).first().product_id == "P1"
    assert load.warehouse.table(schemas.PRODUCTS).first().product_name == "a"


def test_csv_columns_may_come_in_any_order(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("city,note,store_id,region,store_name\nThiès,x,S001,Thiès,Thiès Store\n")
    row = files.read_csv(spark, str(tmp_path / "stores.csv"), schemas.STORES).first()
    assert tuple(row) == ("S001", "Thiès Store", "Thiès", "Thiès")


def test_missing_or_malformed_csv_is_an_error(spark, tmp_path):
    with pytest.raises(SPARK_ERRORS, match="PATH_NOT_FOUND"):
        files.read_csv(spark, str(tmp_path / "none.csv"), schemas.STORES)
    (tmp_path / "p.csv").write_text("product_id,product_name,category,unit_price,stock_quantity\nP1,a,b,cheap,1\n")
    with pytest.raises(SPARK_ERRORS, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, str(tmp_path / "p.csv"), schemas.PRODUCTS).collect()
    with pytest.raises(SPARK_ERRORS, match="city"):
        files.read_csv(spark, str(tmp_path / "p.csv"), schemas.STORES)
    (tmp_path / "text.csv").write_text("store_id,store_name,city,region\nS1,n,,r\n")
    text = files.read_csv_text(spark, str(tmp_path / "text.csv"), schemas.STORES)
    assert [(r.column_name, r.rule) for r in quality.violations(text, schemas.STORES).collect()] == [
        ("city", "not_null")]


def test_empty_append_adds_nothing(spark, products, tmp_path):
    path = str(tmp_path / "t")
    files.append_parquet(products, schemas.PRODUCTS.fed, path)
    files.append_parquet(products.limit(0), schemas.PRODUCTS.fed, path)
    assert files.read_parquet(spark, path).count() == 2


def test_batch_load_from_csv(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "products.csv").write_text(
        "product_id,product_name,category,unit_price,stock_quantity\nP001,Lamp,Home,5.00,3\n")
    (folder / "stores.csv").write_text("store_id,store_name,city,region\nS001,Lyon Store,Lyon,Auvergne\n")
    header = ",".join(schemas.SALES_BATCH.fed)
    (folder / "sales_batch.csv").write_text(
        f"{header}\nBATCH-000001,P001,S001,CUST-123456,2,5.00,10.00,card,2024-03-01 08:00:00\n")
    load = BatchLoad(spark, str(tmp_path / "warehouse"))
    counts = load.run(csv_feed(spark, str(folder)), F.lit("2024-03-02 00:00:00").cast("timestamp_ntz"))
    assert {r.row_count for r in counts.collect()} == {1}
    clean = load.warehouse.table(schemas.SALES_CLEAN).first()
    assert (clean.sale_hour, clean.ingestion_timestamp) == (8, at("2024-03-02 00:00:00"))


def test_tables_are_created_once(spark):
    schemas.create_tables(spark)
    spark.sql("TRUNCATE TABLE raw.stores")
    spark.sql("INSERT INTO raw.stores (store_id, store_name, city, region) VALUES ('S1', 'n', 'c', 'r')")
    schemas.create_tables(spark)
    row = spark.table("raw.stores").first()
    assert row.store_id == "S1" and row.created_at is not None
    with pytest.raises(SPARK_ERRORS, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO raw.stores (store_id, store_name, city, region) VALUES ('{'S' * 51}', 'n', 'c', 'r')")
    for table in schemas.TABLES.values():
        assert [f.dataType for f in spark.table(table.full_name).schema] == [f.dataType for f in table.struct()]


def test_schema_listing(spark):
    stored = spark.createDataFrame([], schemas.DAILY_SALES_SUMMARY.struct())
    got = [(r.ordinal_position, r.column_name, r.data_type)
           for r in quality.table_schema(spark, "analytics.daily_sales_summary", stored).collect()]
    assert got[:2] == [(1, "sale_date", "date"), (2, "store_id", "character varying")]
    assert got[5:7] == [(6, "total_revenue", "numeric"), (7, "total_orders", "bigint")]


def test_constraint_breaches(spark):
    rows = [("P1", None, "c", "1.00", "1"), ("P" * 51, "n", "c", "1.00", "1"), ("P2", "n", "c", "123456789.00", "1"),
            ("P3", "n", "c", "1.00", "9999999999"), ("P4", "n", "c", "1.00", "1"), ("P4", "n", "c", "2.00", "1"),
            ("P5", "n", "c", "1.00", "1"), (None, "n", "c", "1.00", "1")]
    got = quality.violations(spark.createDataFrame(rows, schemas.PRODUCTS.text_struct()), schemas.PRODUCTS)
    assert sorted((r.row_key, r.column_name, r.rule) for r in got.collect()) == sorted([
        ("P1", "product_name", "not_null"), ("P" * 51, "product_id", "max_length"),
        ("P2", "unit_price", "type_range"), ("P3", "stock_quantity", "type_range"),
        ("P4", "product_id", "primary_key"), ("", "product_id", "not_null")])


def test_rejects_are_set_aside(spark):
    rows = [("P1", None, "c", "1.00", "1"), ("P2", "n", "c", "1.00", "1")]
    kept, rejects = quality.set_aside(spark.createDataFrame(rows, schemas.PRODUCTS.text_struct()), schemas.PRODUCTS)
    assert [tuple(r) for r in kept.collect()] == [("P2", "n", "c", money(1), 1)]
    assert [(r.row_key, r.rule) for r in rejects.collect()] == [("P1", "not_null")]


def test_typed_rows_have_no_breach(spark, products):
    assert quality.violations(products, schemas.PRODUCTS).count() == 0


def test_counts(spark, products, stores):
    counts = quality.table_counts({"p": products, "s": stores.limit(0)})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"p": 2, "s": 0}


def test_ids(spark):
    got = spark.range(7, 8).select(*[format_id(k, F.col("id")) for k in ("product", "store", "sale", "customer")])
    assert tuple(got.first()) == ("P007", "S007", "BATCH-000007", "CUST-000007")
    wide = spark.range(255, 256).select(format_id("stream_sale", F.col("id"))).first()[0]
    assert wide == "STREAM-0000000000FF"


def test_database_options():
    db = jdbc.Database("jdbc:postgresql://db/sales", user="u", options={"fetchsize": "1000"})
    assert db.settings() == {"url": "jdbc:postgresql://db/sales", "user": "u", "fetchsize": "1000"}
    assert jdbc.range_settings("n", 0, 100, 8) == {
        "partitionColumn": "n", "lowerBound": "0", "upperBound": "100", "numPartitions": "8"}


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut(spark.range(3)).count() == 3


def test_line_total_rounds_to_cents(spark):
    from tillwright.operators.enrich import total_differs, with_line_total

    df = spark.createDataFrame([(3, money("0.10"), money("0.31"))],
                               "quantity int, unit_price decimal(10,2), total_amount decimal(10,2)")
    assert df.select(total_differs()).first()[0]
    assert with_line_total(df).first().total_amount == money("0.30")
