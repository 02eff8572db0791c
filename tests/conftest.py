import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clearbrook.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


SALES_SCHEMA = (
    "order_id string, date_parsed date, store_id string, product_id string, unit_price double, quantity int, "
    "customer_id string, channel_norm string, channel_raw string"
)


@pytest.fixture(scope="session")
def sales(spark):
    """Staged rows from short tuples; missing trailing fields are NULL."""
    import datetime

    def build(*rows):
        full = []
        for row in rows:
            row = list(row) + [None] * (9 - len(row))
            if isinstance(row[1], str):
                row[1] = datetime.date.fromisoformat(row[1])
            full.append(tuple(row))
        return spark.createDataFrame(full, SALES_SCHEMA)

    return build
