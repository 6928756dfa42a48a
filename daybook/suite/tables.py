"""Table statements over the accounting tables."""

from __future__ import annotations

import uuid
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import tables as B
from daybook.suite.registry import query
from daybook.suite.relational import dbl


@query(
    "table_select",
    "select invoice_no, cast(amount + gst as double) as gross, upper(mode) as mode from sales",
)
def table_select(t):
    return B.select(t.sales, "invoice_no", "cast(amount + gst as double) as gross", "upper(mode) as mode")


@query("table_where", "select bill_no, mode from purchases where mode in ('A','R') and amount > 50000")
def table_where(t):
    return B.where(t.purchases, "mode in ('A','R') and amount > 50000").select("bill_no", "mode")


@query(
    "table_group_having",
    """
select party, count(*) as n, cast(sum(amount) as double) as total from sales group by party having count(*) > 10""",
)
def table_group_having(t):
    return B.group_having(
        t.sales, ["party"], {"n": "count(*)", "total": "cast(sum(amount) as double)"}, having="n > 10"
    )


@query("table_order", "select ledger_id, type, name from ledgers order by type desc, length(name), name")
def table_order(t):
    return B.order(t.ledgers, "type DESC", "length(name)", "name").select("ledger_id", "type", "name")


@query(
    "table_limit_offset",
    "select invoice_no, cast(amount as double) as amount from sales order by sales.amount desc, invoice_no limit 25 offset 50",
)
def table_limit_offset(t):
    return B.page(t.sales, ["amount DESC", "invoice_no"], limit=25, offset=50).select("invoice_no", dbl("amount"))


@query("table_count", "select count(*) as n from purchases")
def table_count(t):
    return B.count(t.purchases)


@query(
    "table_insert",
    """
select invoice_no, party, cast(amount as double) as amount, mode from sales
union all select concat('GST-', invoice_no), party, cast(gst as double), null from sales where gst > 50000""",
)
def table_insert(t):
    rows = t.sales.filter("gst > 50000").select(
        F.concat(F.lit("GST-"), "invoice_no").alias("invoice_no"), "party", F.col("gst").alias("amount")
    )
    return B.insert(t.sales, rows).select("invoice_no", "party", dbl("amount"), "mode")


@query(
    "table_update",
    """
select txn_id, case when type = 'credit' and amount > 100000 then 'LARGE' else mode end as mode,
       case when type = 'credit' and amount > 100000 then upper(type) else type end as type
from raw_bank""",
)
def table_update(t):
    changed = B.update(t.raw_bank, {"mode": "'LARGE'", "type": "upper(type)"}, "type = 'credit' and amount > 100000")
    return changed.select("txn_id", "mode", "type")


_FIRST = "(select invoice_no from sales where mode = '1-URGENT' order by sales.amount desc, invoice_no limit 100)"


@query(
    "table_update_topn",
    f"""
select invoice_no, case when invoice_no in {_FIRST} then 'checked' else source end as source,
       cast(amount as double) as amount from sales""",
)
def table_update_topn(t):
    changed = B.update_topn(
        t.sales, "invoice_no", {"source": "'checked'"}, ["amount DESC"], 100, condition="mode = '1-URGENT'"
    )
    return changed.select("invoice_no", "source", dbl("amount"))


@query("table_delete", "select txn_id, type from raw_bank where not coalesce(type = 'debit', false)")
def table_delete(t):
    return B.delete(t.raw_bank, "type = 'debit'").select("txn_id", "type")


@query("table_delete_topn", f"select invoice_no, mode from sales where invoice_no not in {_FIRST}")
def table_delete_topn(t):
    kept = B.delete_topn(t.sales, "invoice_no", ["amount DESC"], 100, condition="mode = '1-URGENT'")
    return kept.select("invoice_no", "mode")


@query("bind_params", "select invoice_no, party from sales where amount > 250000.50 and mode = '2-HIGH'")
def bind_params(t):
    named = B.free_sql(
        t.spark,
        "select invoice_no, party, mode from {sales} where amount > :least and mode = :mode",
        {"least": 250000.50, "mode": "2-HIGH"},
        sales=t.sales,
    )
    return B.free_sql(t.spark, "select invoice_no, party from {named} where mode = ?", ["2-HIGH"], named=named)


@query(
    "bind_statements",
    """
select invoice_no, source, cast(amount as double) as amount from (
  select invoice_no, amount, case when mode = '1-URGENT' and amount between 1000.50 and 300000 then 'it''s :x?' else source end as source from sales)
where not (source = 'ERP' and invoice_no in ('INV1', 'INV2', 'INV3') or amount > 450000)""",
)
def bind_statements(t):
    """Parameters of an update and of a delete, by name and by place."""
    values = {"mode": "1-URGENT", "low": Decimal("1000.50"), "high": 300000}
    changed = B.update(t.sales, {"source": B.bind("?", ["it's :x?"])}, B.bind("mode = :mode and amount between :low and :high", values))
    gone = B.bind("source = ? and array_contains(?, invoice_no) or amount > ?", ["ERP", ["INV1", "INV2", "INV3"], 450000.0])
    return B.delete(changed, gone).select("invoice_no", "source", dbl("amount"))


@query(
    "free_sql",
    """
select type, count(distinct party) as n_parties, cast(sum(amount) as double) as total
from sales join ledgers on party = name group by type""",
)
def free_sql(t):
    return B.free_sql(
        t.spark,
        """select type, count(distinct party) as n_parties, cast(sum(amount) as double) as total
           from {sales} join {ledgers} on party = name group by type""",
        sales=t.sales,
        ledgers=t.ledgers,
    )


@query(
    "list_tables",
    """
select 'daybook_bank' as name, count(*) as n from bank union all select 'daybook_ledgers', count(*) from ledgers
union all select 'daybook_purchases', count(*) from purchases union all select 'daybook_sales', count(*) from sales""",
)
def list_tables(t):
    # names of its own: views of the caller's are neither listed nor replaced
    own = uuid.uuid4().hex
    names = [f"daybook_{name}" for name in ("ledgers", "sales", "purchases", "bank")]
    for name in names:
        getattr(t, name.removeprefix("daybook_")).createOrReplaceTempView(f"{own}_{name}")
    try:
        counts = [
            B.count(t.spark.table(f"`{name}`")).select(F.lit(name.removeprefix(f"{own}_")).alias("name"), "n")
            for name in B.list_tables(t.spark, f"{own}_daybook_%")
        ]
    finally:
        for name in names:
            t.spark.catalog.dropTempView(f"{own}_{name}")
    return reduce(DataFrame.unionByName, counts)


@query(
    "table_page_after",
    """
select invoice_no, cast(amount as double) as amount from sales
where sales.amount < 100000.00 or (sales.amount = 100000.00 and invoice_no > 'INV9')
order by sales.amount desc, invoice_no limit 25""",
)
def table_page_after(t):
    page = B.page_after(t.sales, ["amount DESC", "invoice_no"], 25, after=[Decimal("100000.00"), "INV9"])
    return page.select("invoice_no", dbl("amount"))


_DEEP = "select invoice_no from sales order by sales.amount desc, invoice_no"


@query(
    "table_deep_page",
    "select invoice_no, cast(amount as double) as amount from sales order by sales.amount desc, invoice_no limit 6000 offset 7000",
)
def table_deep_page(t):
    return B.page(t.sales, ["amount DESC", "invoice_no"], limit=6000, offset=7000).select("invoice_no", dbl("amount"))


@query(
    "table_update_many",
    f"""
select invoice_no, case when invoice_no in ({_DEEP} limit 12000) then 'checked' else source end as source,
       cast(amount as double) as amount from sales""",
)
def table_update_many(t):
    changed = B.update_topn(t.sales, "invoice_no", {"source": "'checked'"}, ["amount DESC"], 12000)
    return changed.select("invoice_no", "source", dbl("amount"))


@query("table_delete_many", f"select invoice_no, mode from sales where invoice_no not in ({_DEEP} limit 12000)")
def table_delete_many(t):
    return B.delete_topn(t.sales, "invoice_no", ["amount DESC"], 12000).select("invoice_no", "mode")
