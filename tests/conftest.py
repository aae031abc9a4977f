from __future__ import annotations

import pytest

from tillstream import schemas
from tillstream.session import build_session

# order_id, customer, product, name, category, price, quantity, time, country
ORDERS = [
    ("O-1", "C-1", "P-1", 'Phone 6"', "Electronics", 1199.99, 1, "2024-01-15 09:23:45", "Canada"),
    ("O-2", "C-2", "P-2", "Boot", "Footwear", 150.0, 2, "2024-01-15 10:12:33", "Japan"),
    ("O-3", "C-1", "P-3", "Lamp", "Home", 19.99, 3, "2024-01-16 08:00:00", "Canada"),
    ("O-4", "C-3", "P-4", "Sofa", "Home", 480.03, 1, "2024-02-01 00:00:00", "France"),
    ("O-5", "C-2", "P-5", "Shoe", "Footwear", 300.0, 1, "2024-02-02 23:59:59", "France"),
    ("O-6", "C-4", "P-6", "Tablet", "Electronics", 59.97, 1, "2024-04-30 12:00:00", "Japan"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        options={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(ORDERS, schemas.CSV_ORDERS)


@pytest.fixture
def silver(orders):
    from pyspark.sql import functions as F

    from tillstream.functions.money import with_revenue
    from tillstream.functions.stamps import with_ingest_columns, with_order_date

    stamped = with_ingest_columns(orders, F.lit("2024-05-01 00:00:00").cast("timestamp"))
    return with_order_date(with_revenue(stamped))


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().toString()
