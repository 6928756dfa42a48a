"""Checks, reports and lookups of stores that grow by batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import documents as D
from daybook.plans import stores as S
from daybook.plans.reports import entries
from daybook.schemas import LEDGERS, PURCHASES
from daybook.sources.scratch import scratch_dir
from daybook.suite.documents import FLAT, flat
from daybook.suite.registry import query
from daybook.suite.reporting import ANALYSIS_SQL, long_reports


@query(
    "check_batch",
    """
select 'purchases' as table_name, 'primary_key' as constraint, bill_no as key, count(*) as n_rows from purchases
where bill_no in (select bill_no from purchases where mode = 'N') group by bill_no having count(*) > 1
union all
select 'purchases', 'reference:supplier', bill_no, 1 from purchases
where mode = 'N' and supplier not in (select name from ledgers)""",
)
def check_batch(t):
    """What the second of two batches breaks, by itself and together with the first."""
    store = scratch_dir(t.spark, "store")
    S.keep_values(t.ledgers, LEDGERS, store, "start")
    old, new = t.purchases.filter("mode <> 'N'"), t.purchases.filter("mode = 'N'")
    S.keep_values(old, PURCHASES, store, "old")
    S.keep_values(new, PURCHASES, store, "new")
    return S.batch_violations(t.spark, new, PURCHASES, store, "new")


@query("analysis_batches", ANALYSIS_SQL)
def analysis_batches(t):
    """The reports after two batches, one of them loaded twice, from their partial sums."""
    state = scratch_dir(t.spark, "state")
    halves = {"sales": "mode < '3'", "purchases": "mode = 'N'", "bank": "type = 'debit'"}
    for name, way in (("even", "({})"), ("odd", "not ({})"), ("even", "({})")):
        S.keep_sums({source: getattr(t, source).filter(way.format(half)) for source, half in halves.items()}, state, name)
    return long_reports(S.analysis_of_state(t.spark, state, t.ledgers))


@query(
    "statement_stored",
    """
select cast(date as varchar) as date, party_name, nature, cast(amount as double) as amount from entries
where party_name = 'Customer#000000100' and date between date '1996-04-15' and date '1999-03-31'""",
)
def statement_stored(t):
    path = scratch_dir(t.spark, "postings")
    S.keep_postings(entries(t.sales, t.purchases, t.bank), path, buckets=4)
    statement = S.stored_statement(t.spark, path, "Customer#000000100", "1996-04-15", "1999-03-31", buckets=4)
    return statement.withColumn("date", F.col("date").cast("string"))


@query("doc_get_stored", f"select {FLAT} from orders_docs where _id = '77'")
def doc_get_stored(t):
    path = scratch_dir(t.spark, "orders")
    D.keep(t.orders_docs, path)
    return flat(D.get_stored(t.spark, path, t.orders_docs.schema, "77"))
