"""Reports over the small books, against figures worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from books import tuples
from pyspark.sql import functions as F

from daybook.operators.cleaning import clean, trim_strings
from daybook.operators.references import validate_references
from daybook.plans import reports
from daybook.schemas import BANK, LEDGERS, SALES

OUTSTANDING = [
    ("Harbour Bakery", "Customer", 1500.0, 1500.0, 0.0),
    ("Millstone Flour", "Supplier", 500.0, 1350.0, -850.0),
    ("Nordlicht Cafe", "Customer", 1800.0, 2000.0, -200.0),
    ("Olive & Vine", "Customer", 2500.0, 3000.0, -500.0),
    ("Paper Lantern", "Customer", 450.0, 0.0, 450.0),
    ("Ridge Dairy", "Supplier", 400.0, 400.0, 0.0),
    ("Tin & Twine", "Supplier", 200.0, 90.0, 110.0),
]


@pytest.fixture(scope="module")
def outstanding(sales, purchases, bank, ledgers):
    return reports.party_outstanding(sales, purchases, trim_strings(bank), ledgers)


def test_monthly_trend(sales, purchases):
    trend = reports.monthly_trend(sales, purchases)
    assert tuples(trend) == [("2023-05", 2300.0, 1100.0), ("2023-06", 3950.0, 740.0)]
    assert tuples(reports.trend_gap(trend)) == [("2023-05", 1200.0), ("2023-06", 3210.0)]


def test_monthly_trend_fills_months_of_one_side_and_keeps_null_months_apart(spark, sales, purchases):
    odd = spark.createDataFrame(
        [
            (date(2022, 12, 31), "INV900", "Harbour Bakery", Decimal(5), None, None, None),
            (None, "INV901", "Harbour Bakery", Decimal(7), None, None, None),
        ],
        SALES.schema,
    )
    late = purchases.limit(1).withColumn("date", F.lit(None).cast("date"))
    trend = reports.monthly_trend(sales.unionByName(odd), purchases.unionByName(late))
    rows = {(r.month, r.total_sales > 0): r for r in trend.collect()}
    assert rows["2022-12", True].total_purchases == 0.0
    assert rows[None, True].total_purchases == 0.0 and rows[None, False].total_sales == 0.0
    assert trend.count() == 5


def test_party_outstanding(outstanding):
    assert tuples(outstanding) == OUTSTANDING


def test_outstanding_sums_up_to_debit_minus_credit(outstanding):
    total = outstanding.agg(F.sum("outstanding"), F.sum(F.col("total_debit") - F.col("total_credit"))).first()
    assert total[0] == total[1]


def test_unregistered_party_keeps_null_type(spark, sales, purchases, bank, ledgers):
    few = ledgers.filter("name <> 'Tin & Twine'")
    rows = reports.party_outstanding(sales, purchases, trim_strings(bank), few).filter("party_type is null")
    assert tuples(rows) == [("Tin & Twine", None, 200.0, 90.0, 110.0)]
    assert [r.total for r in reports.net_position(rows).collect()] == [0.0, 0.0]


def test_ledger_name_held_twice_counts_once(spark, sales, purchases, bank, ledgers):
    twice = ledgers.unionByName(spark.createDataFrame([("L099", "Harbour Bakery", "Customer")], LEDGERS.schema))
    rows = reports.party_outstanding(sales, purchases, trim_strings(bank), twice).filter("party_name = 'Harbour Bakery'")
    assert tuples(rows) == [("Harbour Bakery", "Customer", 1500.0, 1500.0, 0.0)]


def test_party_billed(sales, purchases, ledgers):
    rows = {r.party_name: tuple(r)[2:] for r in reports.party_billed(sales, purchases, ledgers).collect()}
    assert rows["Millstone Flour"] == (0.0, 1350.0, -1350.0)
    assert rows["Harbour Bakery"] == (1500.0, 0.0, 1500.0)
    assert len(rows) == 7


def test_cash_flow(bank):
    expected = [("2023-05", 2400.0, 500.0, 1900.0), ("2023-06", 4100.0, 600.0, 3500.0)]
    assert tuples(reports.cash_flow(bank)) == expected
    assert tuples(reports.cash_flow(bank.withColumn("type", F.initcap("type")))) == expected


def test_top_customers(outstanding):
    assert [tuple(r) for r in reports.top_customers(outstanding).collect()] == [
        ("Olive & Vine", 500.0),
        ("Nordlicht Cafe", 200.0),
    ]
    assert reports.top_customers(outstanding, 1).count() == 1


def test_net_position(outstanding):
    assert tuples(reports.net_position(outstanding)) == [
        ("Payables (Suppliers)", 740.0, 74.7),
        ("Receivables (Customers)", 250.0, 25.3),
    ]


def test_nature_mismatch(spark, bank):
    odd = spark.createDataFrame([(date(2024, 1, 1), "TX900", "Harbour Bakery payment", Decimal(1), "debit", None)], BANK.schema)
    assert reports.nature_mismatch(trim_strings(bank)).count() == 0
    assert [r.txn_id for r in reports.nature_mismatch(bank.unionByName(odd)).collect()] == ["K-7", "TX900"]


def test_ledger_statement(sales, purchases, bank):
    postings = reports.entries(sales, purchases, trim_strings(bank))
    statement = reports.ledger_statement(postings, "Nordlicht Cafe", "2023-05-09", "2023-06-30")
    assert tuples(statement.select("nature", "amount")) == [
        ("credit", 1100.0),
        ("credit", 900.0),
        ("debit", 1000.0),
        ("debit", 800.0),
    ]
    assert reports.ledger_statement(postings, "Nordlicht Cafe", "2023-05-10", "2023-05-27").count() == 0


def test_totals_beyond_double_keep_every_paisa(spark, bank, ledgers, purchases):
    big = Decimal("99999999.99")
    many = spark.range(20_000_000).select(
        F.lit(date(2023, 5, 1)).alias("date"), F.lit("X").alias("invoice_no"), F.lit("Paper Lantern").alias("party"),
        F.lit(big).cast("decimal(10,2)").alias("amount"), F.lit(None).cast("decimal(10,2)").alias("gst"),
        F.lit("Wire").alias("mode"), F.lit("ERP").alias("source"),
    )
    want = big * 20_000_000
    held = reports.party_balances(many, purchases, bank.limit(0), ledgers).filter("party_name = 'Paper Lantern'")
    assert want > 10**15 and held.first().outstanding == want
    gap = reports.trend_gap(reports.monthly_sums(many, purchases.limit(0)))
    assert gap.first().gap == float(want)


def test_books_are_clean_and_valid(sales, purchases, bank, ledgers):
    for df, column, kind in ((sales, "party", "sales"), (purchases, "supplier", "purchases"), (bank, "description", "bank")):
        cleaned = clean(df, as_of="2024-12-31")
        valid, invalid = validate_references(cleaned, ledgers, column, kind)
        assert valid.count() == df.count() and invalid.count() == 0
    valid, _ = validate_references(sales, ledgers, "party", "sales")
    assert valid.columns == [*sales.columns, "ledger_id", "name", "type"]
