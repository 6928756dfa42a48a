"""Values as relational exports spell them, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import borders as N
from daybook.suite.registry import query

_TEXT = """case when gst > 60000 then '0000-00-00 00:00:00' when gst > 50000 then 'n/a'
       when gst > 45000 then concat(cast(date as {0}), 'garbage') when gst > 40000 then concat(cast(date as {0}), ' 12:30:01.25')
       when gst > 35000 then concat(cast(date as {0}), ' 1x') when gst > 30000 then cast(date as {0})
       when gst > 25000 then '0000-00-00x' else concat(cast(date as {0}), ' 00:00:00') end"""
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?"
_GIVEN = f"case when regexp_full_match(txt, '{_DAY}') then cast(try_cast(left(txt, 10) as date) as varchar) end"


@query(
    "norm_zero_date",
    f"""
select invoice_no, {_GIVEN} as as_null,
       case when txt like '0000%' and txt not like '%x' then '0001-01-01' else {_GIVEN} end as as_first
from (select invoice_no, {_TEXT.format('varchar')} as txt from sales)""",
)
def norm_zero_date(t):
    txt = F.expr(_TEXT.format("string"))
    return t.sales.select("invoice_no", txt.alias("txt")).select(
        "invoice_no",
        N.zero_date(F.col("txt")).cast("string").alias("as_null"),
        N.zero_date(F.col("txt"), "round").cast("string").alias("as_first"),
    )


@query(
    "norm_tinyint_bool",
    "select doc_id, quality <> 0 as quality, toxic <> 0 as toxic from labels",
)
def norm_tinyint_bool(t):
    return t.given("labels").select(
        "doc_id", N.tinyint_bool(F.col("quality")).alias("quality"), N.tinyint_bool(F.col("toxic")).alias("toxic")
    )


@query("norm_year", "select invoice_no, strftime(date, '%Y-01-01') as year_start from sales")
def norm_year(t):
    return t.sales.select("invoice_no", N.year_date(F.year("date")).cast("string").alias("year_start"))


@query(
    "norm_timezone",
    """
select event_id, strftime((ts at time zone 'America/New_York') at time zone 'UTC', '%Y-%m-%d %H:%M:%S') as instant
from events""",
)
def norm_timezone(t):
    instant = N.to_instant(F.col("ts").cast("timestamp"), "America/New_York")
    return t.given("events").select("event_id", F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query(
    "norm_set",
    """
select o_orderkey, len(members) as n, coalesce(members[1], '') as first from (
  select o_orderkey, case when txt = '' then [] else string_split(txt, ',') end as members
  from (select o_orderkey, case when o_orderstatus = 'P' then ''
               else concat(o_orderstatus, ',', replace(o_orderpriority, '-', ',')) end as txt from orders))""",
)
def norm_set(t):
    txt = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat("o_orderstatus", F.lit(","), F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(",")))
    )
    members = N.set_members(txt)
    return t.given("orders").select("o_orderkey", members.alias("members")).select(
        "o_orderkey",
        F.size("members").cast("bigint").alias("n"),
        F.coalesce(F.get("members", F.lit(0)), F.lit("")).alias("first"),
    )
