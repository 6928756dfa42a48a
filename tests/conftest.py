import os
import sys
import tempfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from books import BANK_ROWS, LEDGER_ROWS, PURCHASE_ROWS, SALES_ROWS, rows_of  # noqa: E402

from daybook.schemas import BANK, LEDGERS, PURCHASES, SALES  # noqa: E402
from daybook.session import with_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        with_settings(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daybook-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ledgers(spark):
    return spark.createDataFrame([tuple(r) for r in rows_of(LEDGER_ROWS)], LEDGERS.schema)


def _invoices(spark, text, schema):
    return spark.createDataFrame(
        [
            (date.fromisoformat(d), no, party, Decimal(amount), Decimal(gst), mode, "ERP")
            for d, no, party, amount, gst, mode in rows_of(text)
        ],
        schema,
    )


@pytest.fixture(scope="session")
def sales(spark):
    return _invoices(spark, SALES_ROWS, SALES.schema)


@pytest.fixture(scope="session")
def purchases(spark):
    return _invoices(spark, PURCHASE_ROWS, PURCHASES.schema)


@pytest.fixture(scope="session")
def bank(spark):
    return spark.createDataFrame(
        [
            (date.fromisoformat(d), no, text, Decimal(amount), kind, mode)
            for d, no, text, amount, kind, mode in rows_of(BANK_ROWS)
        ],
        BANK.schema,
    )
