"""Bookkeeping reports.

Money is summed as DECIMAL and turned into DOUBLE only in the result, so totals
do not depend on the order of the rows.  Every report reduces the postings to one
row per month or party before anything is joined: a party holding a third of all
rows leaves each map task as a single partial sum.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text
from daybook.functions.text import CREDIT, DEBIT
from daybook.operators.references import one_per_name

#: Totals of many postings; wide enough for 10^13 postings of the largest amount.
TOTAL = "decimal(38,2)"


def _sum_where(condition: Column, amount: str = "amount") -> Column:
    return F.sum(F.when(condition, F.col(amount)).otherwise(F.lit(0)))


def _by_month(df: DataFrame, *measures: Column) -> DataFrame:
    """Aggregate per month; the label is formatted once per group, not per row."""
    start = F.trunc("date", "MM").alias("_start")
    grouped = df.groupBy(start).agg(*measures)
    rest = [c for c in grouped.columns if c != "_start"]
    return grouped.select(text.month_bucket(F.col("_start")).alias("month"), *rest)


def monthly_total(df: DataFrame, out: str) -> DataFrame:
    return _by_month(df, F.sum("amount").alias(out))


def monthly_sums(sales: DataFrame, purchases: DataFrame) -> DataFrame:
    """``monthly_trend`` with DECIMAL totals."""
    joined = monthly_total(sales, "total_sales").join(
        monthly_total(purchases, "total_purchases"), "month", "full_outer"
    )
    return joined.select(
        "month",
        *[F.coalesce(F.col(c), F.lit(0)).cast(TOTAL).alias(c) for c in ("total_sales", "total_purchases")],
    )


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def monthly_trend(sales: DataFrame, purchases: DataFrame) -> DataFrame:
    """month, total_sales, total_purchases; a side without postings counts 0."""
    return _as_double(monthly_sums(sales, purchases), "total_sales", "total_purchases")


def entries(sales: DataFrame, purchases: DataFrame, bank: DataFrame) -> DataFrame:
    """All postings as party_name, date, amount, nature (a bag)."""
    description = F.col("description")
    return (
        sales.select(F.col("party").alias("party_name"), "date", "amount", F.lit(DEBIT).alias("nature"))
        .unionByName(
            purchases.select(F.col("supplier").alias("party_name"), "date", "amount", F.lit(CREDIT).alias("nature"))
        )
        .unionByName(
            bank.select(
                text.description_party(description).alias("party_name"),
                "date",
                "amount",
                text.nature_of(description).alias("nature"),
            )
        )
    )


def _party_totals(postings: DataFrame) -> DataFrame:
    return postings.groupBy("party_name").agg(
        _sum_where(F.col("nature") == DEBIT).alias("_debit"),
        _sum_where(F.col("nature") == CREDIT).alias("_credit"),
    )


def _balances(totals: DataFrame, type_column: str) -> DataFrame:
    return totals.select(
        "party_name",
        type_column,
        F.col("_debit").cast(TOTAL).alias("total_debit"),
        F.col("_credit").cast(TOTAL).alias("total_credit"),
        (F.col("_debit") - F.col("_credit")).cast(TOTAL).alias("outstanding"),
    )


_BALANCE = ("total_debit", "total_credit", "outstanding")


def balances_of(postings: DataFrame, ledgers: DataFrame) -> DataFrame:
    """``party_balances`` of postings (party_name, nature, amount) or of their sums."""
    types = one_per_name(ledgers).select(F.col("name").alias("party_name"), F.col("type").alias("party_type"))
    return _balances(_party_totals(postings).join(types, "party_name", "left"), "party_type")


def outstanding_of(postings: DataFrame, ledgers: DataFrame) -> DataFrame:
    """``party_outstanding`` of postings (party_name, nature, amount) or of their sums."""
    return _as_double(balances_of(postings, ledgers), *_BALANCE)


def party_balances(sales: DataFrame, purchases: DataFrame, bank: DataFrame, ledgers: DataFrame) -> DataFrame:
    """``party_outstanding`` with DECIMAL totals."""
    return balances_of(entries(sales, purchases, bank), ledgers)


def party_outstanding(
    sales: DataFrame, purchases: DataFrame, bank: DataFrame, ledgers: DataFrame
) -> DataFrame:
    """Balance per party over all postings; unregistered parties keep a NULL type, a name held twice counts once."""
    return _as_double(party_balances(sales, purchases, bank, ledgers), *_BALANCE)


def party_billed(sales: DataFrame, purchases: DataFrame, ledgers: DataFrame) -> DataFrame:
    """Balance per registered party over invoices and bills only, bank left out."""
    billed = sales.select(F.col("party").alias("party_name"), "amount", F.lit(DEBIT).alias("nature")).unionByName(
        purchases.select(F.col("supplier").alias("party_name"), "amount", F.lit(CREDIT).alias("nature"))
    )
    types = one_per_name(ledgers).select(F.col("name").alias("party_name"), "type")
    return _as_double(_balances(_party_totals(billed).join(types, "party_name"), "type"), *_BALANCE)


def cash_flow(bank: DataFrame) -> DataFrame:
    """month, total_inflow, total_outflow, net_cash_flow by the recorded type."""
    kind = F.lower("type")
    monthly = _by_month(
        bank, _sum_where(kind == CREDIT).alias("_in"), _sum_where(kind == DEBIT).alias("_out")
    )
    return monthly.select(
        "month",
        F.col("_in").cast("double").alias("total_inflow"),
        F.col("_out").cast("double").alias("total_outflow"),
        (F.col("_in") - F.col("_out")).cast("double").alias("net_cash_flow"),
    )


def top_customers(outstanding: DataFrame, k: int = 5) -> DataFrame:
    """The k customers with the most negative balance, shown positive.

    ``outstanding`` may be ``party_outstanding`` or the exact ``party_balances``.
    """
    return (
        outstanding.filter((F.col("party_type") == "Customer") & (F.col("outstanding") < 0))
        .orderBy("outstanding", "party_name")
        .limit(k)
        .select("party_name", (-F.col("outstanding")).cast("double").alias("dues"))
    )


def net_position(outstanding: DataFrame) -> DataFrame:
    """Absolute totals of both party types and their share; two rows.

    ``outstanding`` may be ``party_outstanding``, or ``party_balances`` for totals that keep every paisa.
    """
    money = F.col("outstanding").cast("decimal(28,2)")

    def side(kind: str) -> Column:
        return F.abs(F.coalesce(F.sum(F.when(F.col("party_type") == kind, money)), F.lit(0)))

    totals = outstanding.agg(side("Customer").alias("c"), side("Supplier").alias("s"))
    both = F.col("c") + F.col("s")

    def row(label: str, value: str) -> Column:
        share = F.try_divide(F.col(value).cast("double") * 100, both.cast("double"))  # of exact totals
        return F.struct(
            F.lit(label).alias("side"),
            F.col(value).cast("double").alias("total"),
            F.round(share, 1).alias("share_pct"),
        )

    # The labels of the chart.
    return totals.select(
        F.inline(F.array(row("Receivables (Customers)", "c"), row("Payables (Suppliers)", "s")))
    )


def trend_gap(trend: DataFrame) -> DataFrame:
    """Sales minus purchases by month, of ``monthly_trend`` or the exact ``monthly_sums``."""
    gap = F.col("total_sales").cast("decimal(28,2)") - F.col("total_purchases").cast("decimal(28,2)")
    return trend.select("month", gap.cast("double").alias("gap"))


def nature_mismatch(bank: DataFrame) -> DataFrame:
    """Bank rows whose last word and recorded type name different sides."""
    nature = text.nature_of(F.col("description"))
    return bank.withColumn("nature", nature).filter(~F.equal_null(F.col("nature"), F.lower("type")))


def ledger_statement(
    postings: DataFrame, party: str, start: date | str, end: date | str
) -> DataFrame:
    """Postings of one ledger between two days, both included."""
    days = [F.lit(str(d)).cast("date") for d in (start, end)]
    return postings.filter((F.col("party_name") == party) & F.col("date").between(*days)).select(
        "date", "party_name", "nature", F.col("amount").cast("double").alias("amount")
    )
