"""Composite analyses over the accounting tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import text
from daybook.operators.references import match_bank, match_party
from daybook.plans import reports
from daybook.suite.registry import query

OUTSTANDING = "select party_name, party_type, total_debit, total_credit, outstanding from party_outstanding"


def outstanding(t):
    return reports.party_outstanding(t.sales, t.purchases, t.bank, t.ledgers)


def balances(t):
    return reports.party_balances(t.sales, t.purchases, t.bank, t.ledgers)


def entries(t):
    return reports.entries(t.sales, t.purchases, t.bank)


@query("monthly_trend", "select month, total_sales, total_purchases from monthly_trend")
def monthly_trend(t):
    return reports.monthly_trend(t.sales, t.purchases)


@query("party_outstanding", OUTSTANDING)
def party_outstanding(t):
    return outstanding(t)


@query(
    "party_billed",
    """
select party_name, l.type as type, cast(sum(d) as double) as total_debit, cast(sum(c) as double) as total_credit,
       cast(sum(d) - sum(c) as double) as outstanding
from (select party as party_name, amount as d, 0 as c from sales
      union all select supplier, 0, amount from purchases) join ledgers l on party_name = l.name
group by 1, 2""",
)
def party_billed(t):
    return reports.party_billed(t.sales, t.purchases, t.ledgers)


@query(
    "cash_flow",
    """
select strftime(date,'%Y-%m') as month,
       cast(sum(case when type='credit' then amount else 0 end) as double) as total_inflow,
       cast(sum(case when type='debit' then amount else 0 end) as double) as total_outflow,
       cast(sum(case when type='credit' then amount else -amount end) as double) as net_cash_flow
from bank group by 1""",
)
def cash_flow(t):
    return reports.cash_flow(t.bank)


@query(
    "top_customers",
    """
select party_name, -outstanding as dues from party_outstanding
where party_type = 'Customer' and outstanding < 0 order by outstanding, party_name limit 5""",
)
def top_customers(t):
    return reports.top_customers(balances(t))


@query(
    "net_position",
    """
select side, cast(total as double) as total, round(cast(total as double) * 100 / cast(whole as double), 1) as share_pct
from (select case party_type when 'Customer' then 'Receivables (Customers)' else 'Payables (Suppliers)' end as side,
             abs(sum(cast(outstanding as decimal(28,2)))) as total,
             sum(abs(sum(cast(outstanding as decimal(28,2))))) over () as whole
      from party_outstanding where party_type is not null group by party_type)""",
)
def net_position(t):
    return reports.net_position(balances(t))


@query(
    "trend_gap",
    """
select month, cast(cast(total_sales as decimal(28,2)) - cast(total_purchases as decimal(28,2)) as double) as gap
from monthly_trend""",
)
def trend_gap(t):
    return reports.trend_gap(reports.monthly_sums(t.sales, t.purchases))


@query(
    "nature_mismatch",
    """
select txn_id, description, type, nature from (
  select *, case when split_part(trim(description),' ',-1) = 'payment' and description not like '% '
                 then 'credit' else 'debit' end as nature from raw_bank)
where nature is distinct from lower(type)""",
)
def nature_mismatch(t):
    return reports.nature_mismatch(t.raw_bank).select("txn_id", "description", "type", "nature")


@query(
    "ledger_statement",
    """
select cast(date as varchar) as date, party_name, nature, cast(amount as double) as amount from entries
where party_name = 'Customer#000000100' and date between date '1996-04-01' and date '1999-03-31'""",
)
def ledger_statement(t):
    statement = reports.ledger_statement(entries(t), "Customer#000000100", "1996-04-01", "1999-03-31")
    return statement.withColumn("date", F.col("date").cast("string"))


_INVOICE = "cast(date as varchar) as date, invoice_no, party, cast(amount as double) as amount, cast(gst as double) as gst, mode, source"
_BILL = "cast(date as varchar) as date, bill_no, supplier, cast(amount as double) as amount, cast(gst as double) as gst, mode, source"
_TXN = "cast(date as varchar) as date, txn_id, description, cast(amount as double) as amount, type, mode"


def _plain(df, *columns):
    """Dates as text and money as double, so that both engines spell values alike."""
    shown = {"date": F.col("date").cast("string"), **{c: F.col(c).cast("double") for c in ("amount", "gst")}}
    return df.select(*[shown[c].alias(c) if c in shown else c for c in columns])


SALES_OUT = ("date", "invoice_no", "party", "amount", "gst", "mode", "source")
PURCHASES_OUT = ("date", "bill_no", "supplier", "amount", "gst", "mode", "source")
BANK_OUT = ("date", "txn_id", "description", "amount", "type", "mode")


@query("validate_sales", f"select {_INVOICE}, ledger_id, name, type from sales join ledgers on party = name")
def validate_sales(t):
    valid, _ = match_party(t.sales, t.ledgers, "party")
    return _plain(valid, *SALES_OUT, "ledger_id", "name", "type")


@query("invalid_sales", f"select {_INVOICE} from sales where party not in (select name from ledgers)")
def invalid_sales(t):
    return _plain(match_party(t.sales, t.ledgers, "party")[1], *SALES_OUT)


@query("validate_purchases", f"select {_BILL}, ledger_id, name, type from purchases join ledgers on supplier = name")
def validate_purchases(t):
    valid, _ = match_party(t.purchases, t.ledgers, "supplier")
    return _plain(valid, *PURCHASES_OUT, "ledger_id", "name", "type")


@query("invalid_purchases", f"select {_BILL} from purchases where supplier not in (select name from ledgers)")
def invalid_purchases(t):
    return _plain(match_party(t.purchases, t.ledgers, "supplier")[1], *PURCHASES_OUT)


_HIT = "exists (select 1 from ledgers where contains({0}, name))"


@query("validate_bank", f"select {_TXN} from bank where {_HIT.format('description')}")
def validate_bank(t):
    return _plain(match_bank(t.bank, t.ledgers)[0], *BANK_OUT)


@query("invalid_bank", f"select {_TXN} from bank where not {_HIT.format('description')}")
def invalid_bank(t):
    return _plain(match_bank(t.bank, t.ledgers)[1], *BANK_OUT)


@query("valid_ledgers", "select ledger_id, name, type from ledgers")
def valid_ledgers(t):
    return t.ledgers


@query(
    "split_description",
    """
select txn_id, case when description is null then null when not contains(description, ' ') then ''
       else trim(left(description, length(description)-length(split_part(description,' ',-1))-1)) end as party,
       split_part(description,' ',-1) as kind
from raw_bank""",
)
def split_description(t):
    split = text.split_description(F.col("description"))
    return t.raw_bank.select("txn_id", split.alias("split")).select(
        "txn_id", F.col("split.party").alias("party"), F.col("split.type").alias("kind")
    )


@query("month_bucket", "select invoice_no, strftime(date,'%Y-%m') as month from sales")
def month_bucket(t):
    return t.sales.select("invoice_no", text.month_bucket(F.col("date")).alias("month"))


_FLOW = "strftime(date,'%Y-%m') as label, null as kind, '{0}' as measure, cast(sum({1}) as double) as value from bank group by 2"


ANALYSIS_SQL = f"""
select 'monthly_trend' as report, month as label, null as kind, 'total_sales' as measure, total_sales as value from monthly_trend
union all select 'monthly_trend', month, null, 'total_purchases', total_purchases from monthly_trend
union all select 'party_outstanding', party_name, party_type, 'total_debit', total_debit from party_outstanding
union all select 'party_outstanding', party_name, party_type, 'total_credit', total_credit from party_outstanding
union all select 'party_outstanding', party_name, party_type, 'outstanding', outstanding from party_outstanding
union all select 'cash_flow', {_FLOW.format("total_inflow", "case when type='credit' then amount else 0 end")}
union all select 'cash_flow', {_FLOW.format("total_outflow", "case when type='debit' then amount else 0 end")}
union all select 'cash_flow', {_FLOW.format("net_cash_flow", "case when type='credit' then amount else -amount end")}"""


def long_reports(done):
    """The three reports of an analysis as one table: a row per report, label and measure."""

    def long(name, label, *measures, kind=None):
        frame = done[name]
        cells = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures]))
        kind = F.lit(None).cast("string") if kind is None else F.col(kind)
        return frame.select(F.lit(name).alias("report"), F.col(label).alias("label"), kind.alias("kind"), cells)

    return (
        long("monthly_trend", "month", "total_sales", "total_purchases")
        .unionByName(
            long("party_outstanding", "party_name", "total_debit", "total_credit", "outstanding", kind="party_type")
        )
        .unionByName(long("cash_flow", "month", "total_inflow", "total_outflow", "net_cash_flow"))
    )


@query("analysis", ANALYSIS_SQL)
def analysis(t):
    from daybook.plans.jobs import analysis as run

    return long_reports(run({"sales": t.sales, "purchases": t.purchases, "bank": t.bank, "ledgers": t.ledgers}))
