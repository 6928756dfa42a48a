"""The accounting tables as the queries see them, derived from the given tables.

Each table is defined twice: as a DataFrame for Spark and as SQL for the checking
engine.  All parties are in the ledger, but those deep in debit are recorded in
capitals, so that reference checks find postings without a ledger.

The ``raw_*`` tables are text with the defects cleaning has to deal with, spread
over whole tables by amounts and keys.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERDRAWN = -450

# Columns of the given tables.  Declared, so that opening a table
# does not start a job to read a footer.
GIVEN_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def money(expr):
    return expr.cast("decimal(10,2)")


class Tables:
    """Lazy access to the given and derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            path = f"{self.sf_dir}/{name}.parquet"
            self._given[name] = self.spark.read.schema(GIVEN_SCHEMAS[name]).parquet(path)
        return self._given[name]

    @cached_property
    def ledgers(self) -> DataFrame:
        def side(table: str, key: str, name: str, balance: str, kind: str) -> DataFrame:
            return self.given(table).select(
                F.concat(F.lit(kind[0]), F.col(key)).alias("ledger_id"),
                F.when(F.col(balance) < OVERDRAWN, F.upper(name)).otherwise(F.col(name)).alias("name"),
                F.lit(kind).alias("type"),
            )

        return side("customer", "c_custkey", "c_name", "c_acctbal", "Customer").unionByName(
            side("supplier", "s_suppkey", "s_name", "s_acctbal", "Supplier")
        )

    @cached_property
    def _invoiced(self) -> DataFrame:
        return self.given("orders").join(
            self.given("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
        )

    @cached_property
    def _billed(self) -> DataFrame:
        return self.given("lineitem").join(
            self.given("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")
        )

    @cached_property
    def sales(self) -> DataFrame:
        return self.sales_priced.drop("price")

    @cached_property
    def bank(self) -> DataFrame:
        return self.bank_priced.drop("price")

    @cached_property
    def sales_priced(self) -> DataFrame:
        """Sales with the price as given, a plain column to spread defects by."""
        amount = money(F.col("o_totalprice"))
        return self._invoiced.select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat(F.lit("INV"), "o_orderkey").alias("invoice_no"),
            F.col("c_name").alias("party"),
            amount.alias("amount"),
            money(amount * F.expr("0.18")).alias("gst"),
            F.col("o_orderpriority").alias("mode"),
            F.lit("ERP").alias("source"),
            F.col("o_totalprice").alias("price"),
        )

    @cached_property
    def purchases(self) -> DataFrame:
        amount = money(F.col("l_extendedprice"))
        return self._billed.select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.concat(F.lit("PUR"), "l_orderkey", F.lit("-"), "l_linenumber").alias("bill_no"),
            F.col("s_name").alias("supplier"),
            amount.alias("amount"),
            money(amount * F.expr("0.18")).alias("gst"),
            F.col("l_returnflag").alias("mode"),
            F.lit("ERP").alias("source"),
        )

    @cached_property
    def bank_priced(self) -> DataFrame:
        price, bill = money(F.col("o_totalprice")), money(F.col("l_extendedprice"))
        # all orders are received and all line items paid; the mode tells their status
        received = self._invoiced.select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat(F.lit("TXCINV"), "o_orderkey").alias("txn_id"),
            F.concat("c_name", F.lit(" payment")).alias("description"),
            money(price + money(price * F.expr("0.18"))).alias("amount"),
            F.lit("credit").alias("type"),
            F.concat("o_orderstatus", F.lit(" "), "o_orderpriority").alias("mode"),
            F.col("o_totalprice").alias("price"),
        )
        paid = self._billed.select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.concat(F.lit("TXD"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey").alias("txn_id"),
            F.concat("s_name", F.lit(" purchase")).alias("description"),
            money(bill * F.expr("1.18")).alias("amount"),
            F.lit("debit").alias("type"),
            F.concat("l_linestatus", F.lit(" "), "l_returnflag").alias("mode"),
            F.col("l_extendedprice").alias("price"),
        )
        return received.unionByName(paid)

    @cached_property
    def raw_sales(self) -> DataFrame:
        return self.spark.sql(RAW_SALES_SELECT.format(source="{sales}"), sales=self.sales_priced)

    @cached_property
    def raw_bank(self) -> DataFrame:
        return self.spark.sql(RAW_BANK_SELECT.format(source="{bank}"), bank=self.bank_priced)

    @cached_property
    def raw_ledgers(self) -> DataFrame:
        return self.spark.sql(RAW_LEDGERS_SELECT.format(source="{ledgers}"), ledgers=self.ledgers)

    @cached_property
    def orders_docs(self) -> DataFrame:
        """One document per order: ``_id`` and a nested ``doc``."""
        rank = F.substring_index("o_orderpriority", "-", 1)
        label = F.substring("o_orderpriority", F.lit(3), F.length("o_orderpriority"))
        address = F.struct(
            F.concat(F.lit("Z"), F.col("o_custkey")).alias("zip"),
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("City "), F.col("o_custkey"))).alias("city"),
        )
        return self.given("orders").select(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.struct(
                F.concat(F.lit("Party "), F.col("o_custkey")).alias("name"),
                F.col("o_orderstatus").alias("status"),
                F.col("o_custkey").alias("rank"),
                address.alias("address"),
                F.array(F.col("o_orderstatus"), rank, label).alias("tags"),
            ).alias("doc"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """One document per order with its line items as an array of objects."""
        line = F.struct(
            F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag")
        )
        lines = self.given("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
        return self.given("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_orderkey").cast("string").alias("_id"),
            F.struct(
                F.col("o_orderstatus").alias("status"),
                F.array("o_orderstatus", F.col("o_custkey").cast("string")).alias("tags"),
                "lines",
            ).alias("doc"),
        )

    @cached_property
    def dirty_ledgers(self) -> DataFrame:
        return self.spark.sql(DIRTY_LEDGERS_SELECT.format(source="{ledgers}"), ledgers=self.ledgers)

    @cached_property
    def dirty_sales(self) -> DataFrame:
        return self.spark.sql(DIRTY_SALES_SELECT.format(source="{raw_sales}"), raw_sales=self.raw_sales)

    @cached_property
    def dirty_purchases(self) -> DataFrame:
        return self.spark.sql(DIRTY_PURCHASES_SELECT.format(source="{purchases}"), purchases=self.purchases)


# Text with defects.  The expressions below mean the same in Spark and DuckDB.
RAW_SALES_SELECT = """
select case when price > 440000 then concat(' ', cast(date as string), ' ')
            when price > 390000 then concat(substring(cast(date as string), 1, 4), '-13-45')
            when price > 330000 then '' when price > 280000 then '2999-01-01'
            else cast(date as string) end as date,
       concat(invoice_no, '  ') as invoice_no,
       case when price between 110000 and 140000 then concat('  ', party) else party end as party,
       case when price between 5000 and 28000 then concat('₹', cast(amount as string))
            when price between 28000 and 33000 then concat('-', cast(amount as string))
            when price between 33000 and 39000 then 'abc' when price between 39000 and 44000 then null
            when price between 44000 and 50000 then '123456789012.5'
            when price between 165000 and 220000
            then concat(' ₹', substring(cast(amount as string), 1, 1), ',', substring(cast(amount as string), 2, 20))
            else cast(amount as string) end as amount,
       gst, lower(mode) as mode, source
from {source}"""

RAW_BANK_SELECT = """
select date, txn_id,
       case when price > 430000 then null
            when price > 380000 then concat('  ', description, '  ')
            when price > 340000 then replace(description, ' ', '')
            when price < 17000 then concat('transfer to ', description)
            else description end as description,
       amount,
       case when price between 85000 and 127000 then 'CREDIT'
            when price between 127000 and 170000 then null else type end as type, mode
from {source}"""

RAW_LEDGERS_SELECT = """
select ledger_id, case when ledger_id like '%7' then null else concat(' ', name, '  ') end as name,
       case when ledger_id like '%3' then lower(type) else type end as type
from {source}"""

# names held twice, without a name, of an unknown type
DIRTY_LEDGERS_SELECT = """
select ledger_id, case when ledger_id like '%7' then null else concat(' ', name, '  ') end as name,
       case when ledger_id like '%31' then 'Other' when ledger_id like '%3' then lower(type) else type end as type
from {source}
union all select concat('X', ledger_id), name, type from {source} where ledger_id like '%9'"""

DIRTY_SALES_SELECT = """
select date, invoice_no, party, amount,
       case when gst > 40000 then concat('₹', cast(gst as string)) when gst > 35000 then 'abc' when gst > 30000 then ''
            when gst > 25000 then null else concat(' ', cast(gst as string)) end as gst, mode, source
from {source}"""

DIRTY_PURCHASES_SELECT = """
select cast(date as string) as date, bill_no, case when amount < 2000 then null else supplier end as supplier,
       case when amount between 2000 and 4000 then concat('-', cast(amount as string)) else cast(amount as string) end as amount,
       case when amount between 30000 and 40000 then '₹1x' else concat('₹', cast(gst as string)) end as gst, mode, source
from {source}"""


def _duck(sql: str) -> str:
    return sql.replace(" as string)", " as varchar)")


_GST = "cast(cast({0} as decimal(10,2))*0.18 as decimal(10,2))"

DERIVED_SQL = {
    "ledgers": f"""
select concat('C',c_custkey) as ledger_id,
       case when c_acctbal < {OVERDRAWN} then upper(c_name) else c_name end as name, 'Customer' as type from customer
union all
select concat('S',s_suppkey), case when s_acctbal < {OVERDRAWN} then upper(s_name) else s_name end, 'Supplier'
from supplier""",
    "sales_priced": f"""
select o_totalprice as price, cast(o_orderdate as date) as date, concat('INV',o_orderkey) as invoice_no, c_name as party,
       cast(o_totalprice as decimal(10,2)) as amount, {_GST.format('o_totalprice')} as gst,
       o_orderpriority as mode, 'ERP' as source
from orders join customer on o_custkey = c_custkey""",
    "sales": "select date, invoice_no, party, amount, gst, mode, source from sales_priced",
    "purchases": f"""
select cast(l_shipdate as date) as date, concat('PUR',l_orderkey,'-',l_linenumber) as bill_no, s_name as supplier,
       cast(l_extendedprice as decimal(10,2)) as amount, {_GST.format('l_extendedprice')} as gst,
       l_returnflag as mode, 'ERP' as source
from lineitem join supplier on l_suppkey = s_suppkey""",
    "bank_priced": f"""
select o_totalprice as price, cast(o_orderdate as date) as date, concat('TXCINV',o_orderkey) as txn_id,
       concat(c_name,' payment') as description,
       cast(cast(o_totalprice as decimal(10,2)) + {_GST.format('o_totalprice')} as decimal(10,2)) as amount,
       'credit' as type, concat(o_orderstatus,' ',o_orderpriority) as mode
from orders join customer on o_custkey = c_custkey
union all
select l_extendedprice, cast(l_shipdate as date), concat('TXD',l_orderkey,'-',l_linenumber,'-',l_partkey), concat(s_name,' purchase'),
       cast(cast(l_extendedprice as decimal(10,2))*1.18 as decimal(10,2)), 'debit', concat(l_linestatus,' ',l_returnflag)
from lineitem join supplier on l_suppkey = s_suppkey""",
    "bank": "select date, txn_id, description, amount, type, mode from bank_priced",
    "raw_sales": _duck(RAW_SALES_SELECT.format(source="sales_priced")),
    "raw_bank": _duck(RAW_BANK_SELECT.format(source="bank_priced")),
    "raw_ledgers": _duck(RAW_LEDGERS_SELECT.format(source="ledgers")),
    "dirty_ledgers": _duck(DIRTY_LEDGERS_SELECT.format(source="ledgers")),
    "dirty_sales": _duck(DIRTY_SALES_SELECT.format(source="raw_sales")),
    "dirty_purchases": _duck(DIRTY_PURCHASES_SELECT.format(source="purchases")),
    "order_lines": """
select cast(o_orderkey as varchar) as _id, o_orderstatus as status, [o_orderstatus, cast(o_custkey as varchar)] as tags, lines
from orders join (select l_orderkey, list({'n': l_linenumber, 'part': l_partkey, 'flag': l_returnflag}
                                          order by l_linenumber, l_partkey, l_returnflag) as lines
                  from lineitem group by 1) on o_orderkey = l_orderkey""",
    "orders_docs": """
select cast(o_orderkey as varchar) as _id, concat('Party ',o_custkey) as name, o_orderstatus as status,
       o_custkey as rank, concat('Z',o_custkey) as zip,
       case when o_orderstatus <> 'P' then concat('City ',o_custkey) end as city,
       [o_orderstatus, split_part(o_orderpriority,'-',1), substring(o_orderpriority,3)] as tags
from orders""",
    "entries": """
select party as party_name, date, amount, 'debit' as nature from sales
union all select supplier, date, amount, 'credit' from purchases
union all select trim(left(description, length(description)-length(split_part(description,' ',-1))-1)), date, amount,
       case when split_part(description,' ',-1) = 'payment' then 'credit' else 'debit' end from bank""",
    "monthly_trend": """
select month, cast(coalesce(s,0) as double) as total_sales, cast(coalesce(p,0) as double) as total_purchases
from (select strftime(date,'%Y-%m') as month, sum(amount) as s from sales group by 1)
full join (select strftime(date,'%Y-%m') as month, sum(amount) as p from purchases group by 1) using (month)""",
    "party_outstanding": """
select party_name, l.type as party_type,
       cast(sum(case when nature='debit' then amount else 0 end) as double) as total_debit,
       cast(sum(case when nature='credit' then amount else 0 end) as double) as total_credit,
       cast(sum(case when nature='debit' then amount else 0 end)
            - sum(case when nature='credit' then amount else 0 end) as double) as outstanding
from entries left join ledgers l on party_name = l.name group by 1, 2""",
}


def with_derived(body: str) -> str:
    """Prefix the statement with the derived tables it uses, in dependency order."""

    def uses(sql: str) -> set[str]:
        return {name for name in DERIVED_SQL if re.search(rf"\b{name}\b", sql)}

    needed: set[str] = set()
    todo = uses(body)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= uses(DERIVED_SQL[name]) - needed - {name}
    ctes = [f"{n} as ({DERIVED_SQL[n].strip()})" for n in DERIVED_SQL if n in needed]
    return (f"with {', '.join(ctes)}\n" if ctes else "") + body.strip()
