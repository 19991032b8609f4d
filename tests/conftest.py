import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwright import schemas  # noqa: E402
from tillwright.session import CHECKPOINT_DIR, build_session  # noqa: E402

SPARK_ERRORS = (PySparkException, Py4JJavaError)
SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        CHECKPOINT_DIR: str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def money(text) -> Decimal:
    return Decimal(str(text)).quantize(Decimal("0.01"))


@pytest.fixture
def sale():
    """Builds one sale row in declared column order."""

    def build(sale_id="S-1", product_id="P001", store_id="S001", quantity=1, amount="10.00",
              price=None, when="2024-03-01 10:15:00", payment="card", ingested=None):
        row = (sale_id, product_id, store_id, "CUST-000001", quantity,
               money(price if price is not None else amount or 0),
               None if amount is None else money(amount), payment, at(when))
        return row if ingested is None else (*row, at(ingested))

    return build


@pytest.fixture
def sales_frame(spark):
    def build(rows, table=schemas.SALES_BATCH):
        rows = list(rows)
        only_fed = not rows or len(rows[0]) == len(table.fed)
        return spark.createDataFrame(rows, table.struct(only_fed=only_fed))

    return build


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("P001", "Lamp", "Home", money(10), 5), ("P002", "Jeans", "Fashion", money(20), 7)],
        schemas.PRODUCTS.struct(only_fed=True))


@pytest.fixture
def stores(spark):
    return spark.createDataFrame(
        [("S001", "Lyon Store", "Lyon", "Auvergne"), ("S002", "Thiès Store", "Thiès", "Thiès")],
        schemas.STORES.struct(only_fed=True))
