"""Cleaning rules on rows chosen to break them."""

from collections import Counter
from decimal import Decimal

import pytest
from books import tuples
from pyspark.sql import functions as F

from daybook.functions import text
from daybook.operators import cleaning as C
from daybook.operators import constraints as K
from daybook.schemas import BANK, LEDGERS, external_type

AS_OF = "2024-06-30"

DATES = [
    ("2024-01-05", "2024-01-05"), ("2024-02-29", "2024-02-29"), ("2023-02-29", None), ("2024-13-45", None),
    ("", None), ("2024-1-5", None), ("24-01-05", None), ("2024-01-05 10:00", None), ("2024-01-05T", None),
    ("2024-01-05\n", None), ("12024-01-05", None), ("abc", None), (None, None), ("0001-01-01", "0001-01-01"),
]

AMOUNTS = [
    ("₹1,23,456.50", "123456.50"), ("0", "0.00"), ("-1", "-1.00"), ("1.005", "1.01"), ("abc", None), ("", None),
    ("123456789012.5", None), ("1e3", "1000.00"), (".5", "0.50"), (None, None), ("₹", None), ("99999999.994", "99999999.99"),
    ("99999999.995", None), (" 7 ", "7.00"),
]


@pytest.mark.parametrize("column", ["date", "amount"])
def test_parsing(spark, column):
    cases = DATES if column == "date" else AMOUNTS
    df = spark.createDataFrame(list(enumerate(v for v, _ in cases)), f"i int, {column} string")
    parsed = C.parse_dates(df) if column == "date" else C.parse_amounts(df)
    got = [None if r[1] is None else str(r[1]) for r in parsed.orderBy("i").collect()]
    assert got == [want for _, want in cases]


def test_date_parsing_agrees_with_the_strict_format(spark):
    df = spark.createDataFrame([(v,) for v, _ in DATES], "v string")
    same = F.equal_null(text.parse_date(F.col("v"), df.schema["v"].dataType), F.try_to_date("v", "yyyy-MM-dd"))
    assert df.filter(~same).count() == 0


def test_trim_keeps_other_types_and_inner_blanks(spark):
    df = spark.createDataFrame([("  a  b ", 1), (None, 2)], "s string, n int")
    assert tuples(C.trim_strings(df)) == [("a  b", 1), (None, 2)]


def test_future_and_null_dates_go_zero_amount_stays(spark):
    df = spark.createDataFrame(
        [("2024-06-30", "0"), ("2024-07-01", "1"), ("x", "1"), ("2024-01-01", "-0.01"), ("2024-01-01", None)],
        "date string, amount string",
    )
    assert [str(r.date) for r in C.datatypes_cleaning(df, AS_OF).collect()] == ["2024-06-30"]
    assert C.filter_valid_date(C.parse_dates(df)).count() >= 4 - 1  # default cutoff is today


def test_frames_without_the_columns_pass_through(spark):
    df = spark.createDataFrame([(1,)], "n int")
    for rule in (C.clean, C.drop_nulls, C.standardize_text, C.parse_dates, C.parse_amounts, C.filter_amount_nonneg):
        assert tuples(rule(df)) == [(1,)]
    assert C.rejects(df).count() == 0


def test_standardize_is_off_by_default(spark):
    df = spark.createDataFrame([("ABC Corp", "UPI ")], "name string, mode string")
    assert tuples(C.clean(df)) == [("ABC Corp", "UPI")]
    assert tuples(C.clean(df, standardize=True)) == [("Abc Corp", "Upi")]


def test_clean_and_rejects_split_the_input(spark):
    rows = [
        (f"{d or ''}", a, t)
        for d in ("2024-01-05", " 2024-01-05 ", "2999-01-01", "bad", None)
        for a in ("1", "-1", "x", None, "₹2,000")
        for t in ("credit", None)
    ]
    df = spark.createDataFrame(rows, "date string, amount string, type string")
    good, bad = C.split_clean(df, AS_OF)
    assert good.count() + bad.count() == df.count() == len(rows)
    assert good.count() == 2 * 2
    assert tuples(C.clean(good, AS_OF)) == tuples(good)  # cleaning twice changes nothing
    reasons = Counter(r for row in bad.collect() for r in row.reasons)
    assert reasons["null_type"] == 25 and reasons["future_date"] == 10 and reasons["negative_amount"] == 10
    assert set(bad.columns) == {"date", "amount", "type", "reasons"}
    # a refused row is kept as it came
    assert Counter(r.date for r in bad.collect())[" 2024-01-05 "] > 0


SPLITS = [
    ("ABC Corp payment", "ABC Corp", "payment"), ("Cash", "", "Cash"), ("a\tb", "", "a\tb"), ("x  y", "x", "y"),
    ("trail ", "trail", ""), (" ab payment", "ab", "payment"), ("", "", ""), (" ", "", ""), (None, None, None),
    ("no\xa0 gap", "no", "gap"), ("tab\t payment", "tab", "payment"), ("é₹ 𝄞", "é₹", "𝄞"),
]


def test_split_description(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _, _ in SPLITS)), "i int, d string")
    split = text.split_description(F.col("d"))
    rows = df.select("i", split.alias("s")).select("i", "s.party", "s.type").orderBy("i").collect()
    assert [(r.party, r.type) for r in rows] == [(p, k) for _, p, k in SPLITS]
    # the plain definition: partition at the last space, blanks stripped
    for source, party, kind in SPLITS:
        if source is not None:
            left, _, right = source.rpartition(" ")
            assert (left.strip(), right.strip()) == (party, kind)


def test_constraints(spark):
    ledgers = spark.createDataFrame(
        [("L1", "Ann", "Customer"), ("L1", "Ann", "customer"), (None, None, None), ("L" * 11, "n" * 101, "Supplier")],
        LEDGERS.schema,
    )
    assert tuples(K.check_primary_key(ledgers, "ledger_id")) == [("L1", 2), (None, 1)]
    assert tuples(K.check_unique(ledgers, "name")) == [("Ann", 2)]
    assert [r.null_columns for r in K.check_not_null(ledgers, LEDGERS).collect()] == [["ledger_id", "name", "type"]]
    assert [r.type for r in K.check_enum(ledgers, LEDGERS).collect()] == ["customer"]
    assert [r.long_columns for r in K.check_varchar_len(ledgers, LEDGERS).collect()] == [["ledger_id", "name"]]
    sales = spark.createDataFrame([("Ann",), ("Bob",), (None,)], "party string")
    assert tuples(K.check_foreign_key(sales, "party", ledgers)) == [("Bob",)]
    wide = spark.createDataFrame([("1", Decimal("1.5")), ("123456789", Decimal(1))], "a string, b decimal(20,4)")
    assert [r.a for r in K.check_decimal_range(wide, ["a", "b"]).collect()] == ["123456789"]
    assert K.check_enum(sales, BANK.__class__("x", sales.schema, "party")).count() == 0


def test_external_types():
    assert external_type("decimal", 12, 3).simpleString() == "decimal(12,3)"
    assert external_type("bigint  unsigned").simpleString() == "decimal(20,0)"
    assert external_type("TINYINT", 1).simpleString() == "boolean"
    assert external_type("tinyint").simpleString() == "int"
    with pytest.raises(ValueError):
        external_type("MONEY")


def test_signs_of_amounts_are_searched_for(spark):
    """As translate takes them out, without looking every character up in a map."""
    odd = ["₹1,23,456.50", ",,₹,1", "₹", ",", "", " ₹ 1", "1₹2,3", "é₹1", "-₹,5", "１", None]
    rows = spark.createDataFrame([(v,) for v in odd], "v string").repartition(1)
    both = rows.select(text.parse_amount(F.col("v")).alias("a"), F.translate("v", "₹,", "").try_cast("decimal(10,2)").alias("b"))
    assert all(r.a == r.b for r in both.collect())
    parsed = rows.select(text.parse_amount(F.col("v")))
    assert "translate" not in parsed._jdf.queryExecution().toString()
