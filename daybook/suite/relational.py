"""The single relational steps the analyses are made of."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import text
from daybook.functions.exprs import any_of
from daybook.operators import references as R
from daybook.operators.cleaning import columns_by_type, columns_present
from daybook.plans import reports
from daybook.sources.files import empty_relation
from daybook.suite.registry import query
from daybook.suite.reporting import balances, entries, outstanding

_KIND = "split_part(description,' ',-1)"


def dbl(name):
    return F.col(name).cast("double").alias(name)


# -- projections and expressions ---------------------------------------------


@query("project_columns", "select invoice_no, party, mode from sales")
def project_columns(t):
    return t.sales.select("invoice_no", "party", "mode")


@query("add_column", "select bill_no, cast(amount + gst as double) as gross from purchases")
def add_column(t):
    gross = (F.col("amount") + F.col("gst")).cast("double")
    return t.purchases.withColumn("gross", gross).select("bill_no", "gross")


@query("rename_column", "select name as party_name, type as party_type, ledger_id from ledgers")
def rename_column(t):
    return t.ledgers.withColumnsRenamed({"name": "party_name", "type": "party_type"})


@query("alias_expr", "select invoice_no, upper(party) as party_upper, length(party) as party_len from sales")
def alias_expr(t):
    return t.sales.select(
        "invoice_no", F.upper("party").alias("party_upper"), F.length("party").alias("party_len")
    )


@query(
    "literal_column",
    "select invoice_no as ref, 'debit' as nature from sales union all select bill_no, 'credit' from purchases",
)
def literal_column(t):
    return t.sales.select(F.col("invoice_no").alias("ref"), F.lit(text.DEBIT).alias("nature")).unionByName(
        t.purchases.select(F.col("bill_no").alias("ref"), F.lit(text.CREDIT).alias("nature"))
    )


@query(
    "case_when",
    f"select txn_id, case when {_KIND} = 'payment' then 'credit' else 'debit' end as nature from bank",
)
def case_when(t):
    return t.bank.select("txn_id", text.nature_of(F.col("description")).alias("nature"))


@query("cast_double", "select txn_id, cast(amount as double) as amount from bank")
def cast_double(t):
    return t.bank.select("txn_id", dbl("amount"))


@query(
    "struct_field",
    f"""
select txn_id, trim(left(description, length(description)-length({_KIND})-1)) as party, {_KIND} as kind from bank""",
)
def struct_field(t):
    split = t.bank.withColumn("split", text.split_description(F.col("description")))
    return split.select(
        "txn_id", F.col("split").getField("party").alias("party"), F.col("split").getField("type").alias("kind")
    )


@query(
    "columns_present",
    """
select 'ledgers' as table_name, count(name) as n_name, count(type) as n_type, cast(null as bigint) as n_amount
from raw_ledgers
union all select 'bank', null, count(type), count(amount) from raw_bank
union all select 'sales', null, null, count(amount) from raw_sales""",
)
def columns_present_(t):
    parts = []
    for name, df in (("ledgers", t.raw_ledgers), ("bank", t.raw_bank), ("sales", t.raw_sales)):
        have = columns_present(df, ["name", "type", "amount"])
        counts = [
            (F.count(c) if c in have else F.lit(None).cast("bigint")).alias(f"n_{c}") for c in ("name", "type", "amount")
        ]
        parts.append(df.agg(F.count("*").alias("_n"), *counts).select(F.lit(name).alias("table_name"), "n_name", "n_type", "n_amount"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "columns_by_type",
    "select concat_ws('|', bill_no, supplier, mode, source) as texts from purchases",
)
def columns_by_type_(t):
    return t.purchases.select(F.concat_ws("|", *columns_by_type(t.purchases, T.StringType)).alias("texts"))


@query("arith_subtract", "select invoice_no, cast(amount - gst as double) as net from sales")
def arith_subtract(t):
    return t.sales.select("invoice_no", (F.col("amount") - F.col("gst")).cast("double").alias("net"))


@query("arith_negate", "select txn_id, cast(-amount as double) as amount from bank")
def arith_negate(t):
    return t.bank.select("txn_id", (-F.col("amount")).cast("double").alias("amount"))


@query("abs", "select party_name, abs(outstanding) as balance from party_outstanding")
def abs_(t):
    return outstanding(t).select("party_name", F.abs("outstanding").alias("balance"))


@query(
    "percent_share",
    """
select party_type, round(cast(total as double) * 100 / cast(sum(total) over () as double), 1) as share_pct
from (select party_type, sum(cast(total_debit as decimal(28,2))) as total from party_outstanding group by 1)""",
)
def percent_share(t):
    totals = outstanding(t).groupBy("party_type").agg(F.sum(F.col("total_debit").cast("decimal(28,2)")).alias("total"))
    whole = totals.agg(F.sum("total").cast("double").alias("whole")).scalar()
    share = F.try_divide(F.col("total").cast("double") * 100, whole)
    return totals.select("party_type", F.round(share, 1).alias("share_pct"))


# -- filters -----------------------------------------------------------------


@query("filter_eq", "select ledger_id, name from ledgers where type = 'Supplier'")
def filter_eq(t):
    return t.ledgers.filter(F.col("type") == "Supplier").select("ledger_id", "name")


@query(
    "filter_range",
    """
select invoice_no, cast(amount as double) as amount from sales
where date >= date '1997-01-01' and date < date '1998-01-01' and amount <= 200000""",
)
def filter_range(t):
    day = F.col("date")
    year = (day >= F.lit("1997-01-01").cast("date")) & (day < F.lit("1998-01-01").cast("date"))
    return t.sales.filter(year & (F.col("amount") <= 200000)).select("invoice_no", dbl("amount"))


@query(
    "filter_and",
    "select party_name, outstanding from party_outstanding where party_type = 'Customer' and outstanding > 0",
)
def filter_and(t):
    return (
        outstanding(t)
        .filter((F.col("party_type") == "Customer") & (F.col("outstanding") > 0))
        .select("party_name", "outstanding")
    )


@query("filter_not_null", "select txn_id, description from raw_bank where description is not null")
def filter_not_null(t):
    return t.raw_bank.filter(F.col("description").isNotNull()).select("txn_id", "description")


@query("filter_contains", "select txn_id, description from bank where contains(description, 'Supplier')")
def filter_contains(t):
    return t.bank.filter(F.col("description").contains("Supplier")).select("txn_id", "description")


_ANY = "contains(description, 'purchase') or contains(description, '00012') or contains(description, '777')"


@query("filter_any_of", f"select txn_id, description from bank where {_ANY}")
def filter_any_of(t):
    words = ["purchase", "00012", "777"]
    return t.bank.filter(any_of(*[F.col("description").contains(w) for w in words])).select("txn_id", "description")


@query("filter_not", f"select txn_id, description from raw_bank where not ({_ANY})")
def filter_not(t):
    words = ["purchase", "00012", "777"]
    hit = any_of(*[F.col("description").contains(w) for w in words])
    return t.raw_bank.filter(~hit).select("txn_id", "description")


# -- joins -------------------------------------------------------------------


@query(
    "join_inner",
    "select invoice_no, party, ledger_id, type from sales join ledgers on party = name",
)
def join_inner(t):
    return R.match_party(t.sales, t.ledgers, "party")[0].select("invoice_no", "party", "ledger_id", "type")


@query("join_left_anti", "select bill_no, supplier from purchases where supplier not in (select name from ledgers)")
def join_left_anti(t):
    return R.match_party(t.purchases, t.ledgers, "supplier")[1].select("bill_no", "supplier")


@query(
    "join_left",
    "select invoice_no, party as party_name, l.type as party_type from sales left join ledgers l on party = name",
)
def join_left(t):
    types = t.ledgers.select(F.col("name").alias("party_name"), F.col("type").alias("party_type"))
    return t.sales.withColumnRenamed("party", "party_name").join(types, "party_name", "left").select(
        "invoice_no", "party_name", "party_type"
    )


@query(
    "join_full_outer",
    """
select month, cast(s as double) as inflow, cast(p as double) as total_purchases
from (select strftime(date,'%Y-%m') as month, sum(amount) as s from bank group by 1)
full join (select strftime(date,'%Y-%m') as month, sum(amount) as p from purchases group by 1) using (month)""",
)
def join_full_outer(t):
    left, right = reports.monthly_total(t.bank, "inflow"), reports.monthly_total(t.purchases, "total_purchases")
    return left.join(right, "month", "full_outer").select("month", dbl("inflow"), dbl("total_purchases"))


_HIT = "exists (select 1 from ledgers where contains(description, name))"


@query("semi_contains", f"select txn_id, description from raw_bank where {_HIT}")
def semi_contains(t):
    return R.semi_contains(t.raw_bank, "description", t.ledgers, "name").select("txn_id", "description")


@query("anti_contains", f"select txn_id, description from raw_bank where not {_HIT}")
def anti_contains(t):
    return R.anti_contains(t.raw_bank, "description", t.ledgers, "name").select("txn_id", "description")


@query("match_bank_raw", f"select txn_id, description, {_HIT} as valid from raw_bank")
def match_bank_raw(t):
    return R.flag_bank(t.raw_bank, t.ledgers).select("txn_id", "description", "valid")


# -- aggregation -------------------------------------------------------------


@query("agg_sum_by_month", "select strftime(date,'%Y-%m') as month, cast(sum(amount) as double) as total from sales group by 1")
def agg_sum_by_month(t):
    return reports.monthly_total(t.sales, "total").select("month", dbl("total"))


@query(
    "agg_conditional_sum",
    """
select mode, cast(sum(case when type='credit' then amount else 0 end) as double) as credit,
       cast(sum(case when type='debit' then amount else 0 end) as double) as debit
from bank group by mode""",
)
def agg_conditional_sum(t):
    def side(kind):
        return F.sum(F.when(F.col("type") == kind, F.col("amount")).otherwise(0)).cast("double").alias(kind)

    return t.bank.groupBy("mode").agg(side("credit"), side("debit"))


@query(
    "agg_multi_key",
    """
select party_name, l.type as party_type, count(*) as n_entries
from entries left join ledgers l on party_name = l.name group by 1, 2""",
)
def agg_multi_key(t):
    counts = entries(t).groupBy("party_name").agg(F.count("*").alias("n"))
    types = t.ledgers.select(F.col("name").alias("party_name"), F.col("type").alias("party_type"))
    return counts.join(types, "party_name", "left").groupBy("party_name", "party_type").agg(F.sum("n").alias("n_entries"))


@query(
    "agg_group_total",
    """
select party_type, cast(sum(cast(outstanding as decimal(28,2))) as double) as total
from party_outstanding where party_type is not null group by 1""",
)
def agg_group_total(t):
    known = balances(t).filter(F.col("party_type").isNotNull())
    total = F.sum(F.col("outstanding").cast("decimal(28,2)")).cast("double").alias("total")
    return known.groupBy("party_type").agg(total)


@query(
    "fill_zero",
    f"""
select txn_id, cast(coalesce(case when type = 'credit' then amount end, 0) as double) as credit from raw_bank""",
)
def fill_zero(t):
    credit = F.when(F.col("type") == "credit", F.col("amount")).cast("double")
    return t.raw_bank.select("txn_id", credit.alias("credit")).fillna(0, subset=["credit"])


# -- sort, limit, set operations ---------------------------------------------


@query("sort_asc", "select month, total_sales, total_purchases from monthly_trend order by month")
def sort_asc(t):
    return reports.monthly_trend(t.sales, t.purchases).orderBy("month")


@query(
    "top_k",
    "select party_name, outstanding from party_outstanding order by outstanding, party_name limit 5",
)
def top_k(t):
    return outstanding(t).orderBy("outstanding", "party_name").limit(5).select("party_name", "outstanding")


@query("union_all", "select party_name, cast(date as varchar) as date, cast(amount as double) as amount, nature from entries")
def union_all(t):
    return entries(t).select("party_name", F.col("date").cast("string").alias("date"), dbl("amount"), "nature")


@query(
    "empty_relation",
    """
select party_name, nature from entries where false
union all select 'rows', cast(count(*) as varchar) from entries""",
)
def empty_relation_(t):
    # beside the empty relation, a row that counts the full one
    full = entries(t).select("party_name", "nature")
    counted = full.agg(F.count("*").cast("string").alias("nature")).select(F.lit("rows").alias("party_name"), "nature")
    return empty_relation(full).unionByName(counted)


@query("collect_column", "select distinct name from ledgers")
def collect_column(t):
    # the names stay distributed; nothing is pulled to the driver
    return t.ledgers.select("name").distinct()
