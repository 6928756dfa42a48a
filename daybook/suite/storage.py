"""Scans, sinks and jobs as round trips through the shared scratch folder."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import cleaning as C
from daybook.plans.jobs import clean_all as run_clean
from daybook.plans.jobs import etl_batch as run_batch
from daybook.plans.jobs import etl_job as run_etl
from daybook.plans.jobs import load_raw as run_load
from daybook.plans.jobs import raw_rows, together
from daybook.plans.stores import stored_violations
from daybook.schemas import BANK, LEDGERS, PURCHASES, SALES
from daybook.sources import files, sinks
from daybook.sources.batches import BATCH, buckets_for
from daybook.sources.scratch import drop_dir, free_shuffles, scratch_dir
from daybook.suite.cleaning import _AMOUNT, _CLEAN, _DAY, AS_OF
from daybook.suite.registry import query
from daybook.suite.reporting import _BILL, _INVOICE, _TXN, ANALYSIS_SQL, BANK_OUT, PURCHASES_OUT, SALES_OUT, _plain, long_reports
from daybook.suite.views import DERIVED_SQL


def _csv(t, df, label: str) -> str:
    path = scratch_dir(t.spark, label)
    sinks.sink_csv_overwrite(df, path)
    return path


def _csvs(t, tables: dict[str, DataFrame]) -> dict[str, str]:
    """Tables as compressed CSV folders, by name; their jobs are submitted together, so that one's last tasks leave no core idle."""
    paths = {name: scratch_dir(t.spark, name) for name in tables}
    together(lambda name: sinks.sink_csv_overwrite(tables[name], paths[name], "gzip"), tables)
    free_shuffles(t.spark)
    return paths


def _dropping(t, paths: dict[str, str]):
    """For the last job that reads these folders: drops each as soon as it is read."""
    return lambda name: drop_dir(t.spark, paths[name])


@query("scan_csv", f"select {_TXN} from bank")
def scan_csv(t):
    return _plain(files.scan_csv(t.spark, _csv(t, t.bank, "bank"), BANK.schema), *BANK_OUT)


@query("scan_csv_pandas", "select ledger_id, name, type from raw_ledgers")
def scan_csv_pandas(t):
    return files.scan_csv(t.spark, _csv(t, t.raw_ledgers, "ledgers"))


@query("scan_part_dir", f"select {_BILL} from purchases")
def scan_part_dir(t):
    # several parts, all of them read
    path = _csv(t, t.purchases, "purchases")
    return _plain(files.scan_part_dir(t.spark, path, PURCHASES.schema), *PURCHASES_OUT)


@query(
    "sink_csv_overwrite",
    "select date, invoice_no, party, amount, cast(gst as varchar) as gst, mode, source from raw_sales",
)
def sink_csv_overwrite(t):
    path = scratch_dir(t.spark, "raw-sales")
    sinks.sink_csv_overwrite(t.sales, path)
    sinks.sink_csv_overwrite(t.raw_sales, path)
    return files.scan_csv(t.spark, path).select(*SALES_OUT)


@query("sink_single_csv", "select month, total_sales, total_purchases from monthly_trend")
def sink_single_csv(t):
    from daybook.plans.reports import monthly_trend

    path = scratch_dir(t.spark, "trend")
    sinks.sink_single_csv(monthly_trend(t.sales, t.purchases), path)
    if len(files.part_files(t.spark, path)) != 1:
        raise AssertionError("a single-file report has more than one part")
    return t.spark.read.schema("month string, total_sales double, total_purchases double").csv(path, header=True)


@query("sink_append", f"select {_INVOICE} from sales union all select {_INVOICE} from sales where gst > 50000")
def sink_append(t):
    path = scratch_dir(t.spark, "sales")
    large = t.sales.filter(F.col("gst") > 50000)
    sinks.sink_append(t.sales, path, "all")
    sinks.sink_append(t.sales, path, "large")
    sinks.sink_append(large, path, "large")  # a repeated batch takes the place of the first
    sinks.sink_append(t.sales, path, "all")
    return _plain(files.scan_parquet(t.spark, path, SALES.schema), *SALES_OUT)


@query("sink_replace", f"select {_INVOICE} from sales where gst > 50000")
def sink_replace(t):
    path = scratch_dir(t.spark, "sales")
    sinks.sink_replace(t.sales, path)
    sinks.sink_replace(t.sales.filter(F.col("gst") > 50000), path)
    return _plain(files.scan_parquet(t.spark, path, SALES.schema), *SALES_OUT)


def _raw_files(t) -> dict[str, str]:
    raw = {
        LEDGERS.name: t.ledgers,
        SALES.name: t.raw_sales,
        PURCHASES.name: t.purchases,
        BANK.name: t.raw_bank,
    }
    return _csvs(t, raw)


def _dirty_files(t) -> dict[str, str]:
    raw = {
        LEDGERS.name: t.dirty_ledgers,
        SALES.name: t.dirty_sales,
        PURCHASES.name: t.dirty_purchases,
        BANK.name: t.raw_bank,
    }
    return _csvs(t, raw)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in sorted(tables.items())
    )


def _whole(tables: dict[str, DataFrame]) -> DataFrame:
    """Whole rows of several tables as text: one line per row, its columns between bars."""
    return _union(
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns]).alias("line"),
        )
        for name, df in sorted(tables.items())
    )


def _line(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in columns) + ") as line"


def _repeated_keys(**tables: str) -> str:
    """Violations of the primary keys: entity=table."""
    keys = {e.name: e.key for e in (LEDGERS, SALES, PURCHASES, BANK)}
    return "".join(
        f"""
union all select '{name}_violations', concat('{name}|primary_key|', {keys[name]}, '|', count(*)) from {table}
          where {keys[name]} is not null group by {keys[name]} having count(*) > 1"""
        for name, table in tables.items()
    )


_LEDGER, _SALE, _BOUGHT, _BOOKED = (e.columns for e in (LEDGERS, SALES, PURCHASES, BANK))


@query(
    "load_raw",
    f"""
select 'ledgers' as table_name, {_line(*_LEDGER)} from dirty_ledgers
union all select 'sales', {_line(*_SALE)} from dirty_sales
union all select 'purchases', {_line(*_BOUGHT)} from dirty_purchases
union all select 'bank', {_line(*_BOOKED)} from raw_bank
union all select 'ledgers_violations', concat('ledgers|not_null:name|', ledger_id, '|1') from dirty_ledgers where name is null
union all select 'ledgers_violations', concat('ledgers|domain:type|', ledger_id, '|1') from dirty_ledgers where type = 'Other'
union all select 'ledgers_violations', concat('ledgers|unique:name|', name, '|', count(*)) from dirty_ledgers
          where name is not null group by name having count(*) > 1
union all select 'sales_violations', concat('sales|not_null:date|', invoice_no, '|1') from dirty_sales where date is null
union all select 'sales_violations', concat('sales|reference:party|', invoice_no, '|1') from dirty_sales
          where party not in (select name from dirty_ledgers where name is not null)
union all select 'purchases_violations', concat('purchases|reference:supplier|', bill_no, '|1') from dirty_purchases
          where supplier not in (select name from dirty_ledgers where name is not null)
union all select 'purchases_violations', concat('purchases|not_null:supplier|', bill_no, '|1') from dirty_purchases where supplier is null
union all select 'bank_violations', concat('bank|not_null:type|', txn_id, '|1') from raw_bank where type is null
{_repeated_keys(ledgers="dirty_ledgers", sales="dirty_sales", purchases="dirty_purchases", bank="raw_bank")}""",
)
def load_raw(t):
    paths, store = _dirty_files(t), scratch_dir(t.spark, "store")
    buckets = _buckets(t)
    run_load(t.spark, paths, store, buckets=buckets)
    stored = run_load(t.spark, paths, store, buckets=buckets, read=_dropping(t, paths))  # the same batches once more: nothing is added
    tables = {name: files.scan_parquet(t.spark, path).drop(BATCH) for name, path in stored.items() if not name.endswith("_violations")}
    for entity in (LEDGERS, SALES, PURCHASES, BANK):
        tables[f"{entity.name}_violations"] = stored_violations(t.spark, store, entity.name, buckets=buckets)
    return _whole(tables)


#: Buckets of these stores while their tables are small.
_FEW = 8


def _buckets(t) -> int:
    """Buckets for the bank, the largest table; the given tables' rows are counted by their footers."""
    return buckets_for(t.given("orders").count() + t.given("lineitem").count(), _FEW)


def _half(df: DataFrame, second: bool, first: str) -> DataFrame:
    chosen = F.coalesce(F.expr(first), F.lit(False))
    return df.filter(~chosen if second else chosen)


_FIRST_BATCH = {"sales": "mode < '3'", "purchases": "mode <> 'N'", "bank": "type = 'credit'"}


@query(
    "load_batches",
    f"""
select 'ledgers' as table_name, {_line(*_LEDGER)} from ledgers
union all select 'sales', {_line(*_SALE)} from sales
union all select 'purchases', {_line(*_BOUGHT)} from purchases
union all select 'bank', {_line(*_BOOKED)} from bank
union all select 'sales_violations', concat('sales|reference:party|', invoice_no, '|1') from sales
          where party not in (select name from ledgers)
union all select 'purchases_violations', concat('purchases|reference:supplier|', bill_no, '|1') from purchases
          where supplier not in (select name from ledgers)
{_repeated_keys(ledgers="ledgers", sales="sales", purchases="purchases", bank="bank")}""",
)
def load_batches(t):
    """Two loads under given names and the first once more; then the whole store and what it breaks."""
    store, buckets = scratch_dir(t.spark, "store"), _buckets(t)
    parts = []
    for second in (False, True):
        tables = {name: _half(getattr(t, name), second, first) for name, first in _FIRST_BATCH.items()}
        if not second:
            tables["ledgers"] = t.ledgers
        parts.append(_csvs(t, tables))
    for i, again in ((0, True), (1, False), (0, False)):
        run_load(t.spark, parts[i], store, dict.fromkeys(parts[i], f"part-{i}"), buckets, None if again else _dropping(t, parts[i]))
    out = {}
    for entity in (LEDGERS, SALES, PURCHASES, BANK):
        out[entity.name] = raw_rows(t.spark, store, entity.name)
        out[f"{entity.name}_violations"] = stored_violations(t.spark, store, entity.name, buckets=buckets)
    return _whole(out)


@query(
    "scan_csv_line_breaks",
    """
select cast(date as varchar) as date, txn_id, replace(description, ' ', chr(10)) as description, cast(amount as varchar) as amount, type, mode from raw_bank""",
)
def scan_csv_line_breaks(t):
    broken = t.raw_bank.withColumn("description", F.replace("description", F.lit(" "), F.lit("\n")))
    read = files.scan_csv(t.spark, _csv(t, broken, "broken"), keep_corrupt=True)
    return read.filter(F.col(files.CORRUPT).isNull()).select(BANK.columns)


_GOOD_BANK = f"(select * from raw_bank where date <= date '{AS_OF}' and amount >= 0 and type is not null)"
_GOOD_BILLS = f"(select * from purchases where date <= date '{AS_OF}')"
_NAMES = "(select name from ledgers)"
_CONTAINED = "coalesce(exists (select 1 from ledgers where contains(trim(description), name)), false)"


@query(
    "etl_job",
    f"""
select 'valid_ledgers' as table_name, count(*) as n_rows from ledgers
union all select 'ledgers_cleaned', count(*) from ledgers union all select 'ledgers_rejected', 0
union all select 'sales_cleaned', count(*) from ({_CLEAN})
union all select 'sales_rejected', (select count(*) from raw_sales) - count(*) from ({_CLEAN})
union all select 'purchases_cleaned', count(*) from {_GOOD_BILLS}
union all select 'purchases_rejected', (select count(*) from purchases) - count(*) from {_GOOD_BILLS}
union all select 'bank_cleaned', count(*) from {_GOOD_BANK}
union all select 'bank_rejected', (select count(*) from raw_bank) - count(*) from {_GOOD_BANK}
union all select 'valid_sales', count(*) from ({_CLEAN}) where party in {_NAMES}
union all select 'invalid_sales', count(*) from ({_CLEAN}) where party not in {_NAMES}
union all select 'valid_purchases', count(*) from {_GOOD_BILLS} where supplier in {_NAMES}
union all select 'invalid_purchases', count(*) from {_GOOD_BILLS} where supplier not in {_NAMES}
union all select 'valid_bank', count(*) from {_GOOD_BANK} where {_CONTAINED}
union all select 'invalid_bank', count(*) from {_GOOD_BANK} where not {_CONTAINED}""",
)
def etl_job(t):
    paths = _raw_files(t)
    stored = run_etl(t.spark, paths, scratch_dir(t.spark, "store"), AS_OF, _dropping(t, paths))
    return _counts({name: side.read(t.spark) for name, side in stored.items() if not name.endswith("_violations")})


# the dirty tables trimmed, parsed and judged, as the checking engine spells it
_GST = _AMOUNT.format("trim(gst)")
_BAD_GST = f"({_GST} is null and trim(gst) <> '')"
_JUDGED = {
    "jl": """
select *, trim(name) as t_name, concat_ws(',', case when name is null then 'null_name' end,
       case when type = 'Other' then 'domain_type' end) as reasons from dirty_ledgers""",
    "js": f"""
select *, concat_ws(',', case when day is null then 'bad_date' end, case when day > date '{AS_OF}' then 'future_date' end,
       case when amt is null then 'bad_amount' end, case when amt < 0 then 'negative_amount' end,
       case when {_BAD_GST} then 'bad_gst' end) as reasons
from (select *, {_DAY} as day, {_AMOUNT.format('trim(amount)')} as amt from dirty_sales)""",
    "jp": f"""
select *, concat_ws(',', case when cast(date as date) > date '{AS_OF}' then 'future_date' end,
       case when cast(amount as decimal(10,2)) < 0 then 'negative_amount' end, case when {_BAD_GST} then 'bad_gst' end,
       case when supplier is null then 'null_supplier' end) as reasons from dirty_purchases""",
    "jb": f"""
select *, concat_ws(',', case when date > date '{AS_OF}' then 'future_date' end,
       case when type is null then 'null_type' end) as reasons from raw_bank""",
    "cl": "select ledger_id, t_name as name, trim(type) as type from jl where reasons = ''",
    "cs": f"""
select day as date, trim(invoice_no) as invoice_no, trim(party) as party, amt as amount, {_GST} as gst, trim(mode) as mode,
       trim(source) as source from js where reasons = ''""",
    "cp": f"""
select cast(date as date) as date, bill_no, supplier, cast(amount as decimal(10,2)) as amount, {_GST} as gst, mode, source
from jp where reasons = ''""",
    "cb": """
select date, txn_id, trim(description) as description, amount, type, mode from jb where reasons = ''""",
    "ul": "select min(ledger_id) as ledger_id, name, arg_min(type, ledger_id) as type from cl group by name",
}


def _with_judged(body: str) -> str:
    """The statement after the judged tables it uses; derived tables are put before by the registry."""

    def uses(sql: str) -> set[str]:
        return {name for name in _JUDGED if re.search(rf"\b{name}\b", sql)}

    needed, todo = set(), uses(body)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= uses(_JUDGED[name]) - needed
    judged = ", ".join(f"{n} as materialized ({sql})" for n, sql in _JUDGED.items() if n in needed)
    return f"select * from (with {judged}{body if body.startswith(',') else ' ' + body})"


_CLEANED = f"""
select 'ledgers_cleaned' as table_name, {_line(*_LEDGER)} from cl
union all select 'sales_cleaned', {_line(*_SALE)} from cs
union all select 'purchases_cleaned', {_line(*_BOUGHT)} from cp
union all select 'bank_cleaned', {_line(*_BOOKED)} from cb
union all select 'ledgers_rejected', {_line(*_LEDGER, "reasons")} from jl where reasons <> ''
union all select 'sales_rejected', {_line(*_SALE, "reasons")} from js where reasons <> ''
union all select 'purchases_rejected', {_line(*_BOUGHT, "reasons")} from jp where reasons <> ''
union all select 'bank_rejected', {_line(*_BOOKED, "reasons")} from jb where reasons <> ''"""


def _opened(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rejected rows as the columns they came with and their reasons."""
    out = {}
    for name, df in tables.items():
        if name.endswith("_rejected"):
            df = df.select("raw.*", F.concat_ws(",", C.REASONS).alias(C.REASONS)).drop(files.CORRUPT)
        out[name] = df
    return out


@query("clean_all", _with_judged(_CLEANED))
def clean_all(t):
    paths = _dirty_files(t)
    stored = run_clean(t.spark, paths, scratch_dir(t.spark, "store"), AS_OF, _dropping(t, paths))
    return _whole(_opened({name: side.read(t.spark) for name, side in stored.items()}))


@query(
    "etl_rows",
    _with_judged(
        f"""
select 'valid_ledgers' as table_name, {_line(*_LEDGER)} from cl
union all select 'valid_sales', {_line(*_SALE, "ledger_id", "name", "type")} from cs join ul on party = name
union all select 'invalid_sales', {_line(*_SALE)} from cs where party not in (select name from cl)
union all select 'valid_purchases', {_line(*_BOUGHT, "ledger_id", "name", "type")} from cp join ul on supplier = name
union all select 'invalid_purchases', {_line(*_BOUGHT)} from cp where supplier not in (select name from cl)
union all select 'valid_bank', {_line(*_BOOKED)} from cb
          where coalesce(exists (select 1 from ul where contains(description, ul.name)), false)
union all select 'invalid_bank', {_line(*_BOOKED)} from cb
          where not coalesce(exists (select 1 from ul where contains(description, ul.name)), false)
union all select 'ledgers_violations', concat('ledgers|unique:name|', name, '|', count(*)) from cl group by name having count(*) > 1
union all select 'sales_violations', concat('sales|reference:party|', invoice_no, '|1') from cs
          where party not in (select name from cl)
union all select 'purchases_violations', concat('purchases|reference:supplier|', bill_no, '|1') from cp
          where supplier not in (select name from cl)
{_repeated_keys(ledgers="cl", sales="cs", purchases="cp", bank="cb")}"""
    ),
)
def etl_rows(t):
    paths = _dirty_files(t)
    stored = run_etl(t.spark, paths, scratch_dir(t.spark, "store"), AS_OF, _dropping(t, paths))
    return _whole(
        {n: side.read(t.spark) for n, side in stored.items() if not n.endswith(("_cleaned", "_rejected"))}
    )


# descriptions without a blank have no party
_PARTY = "trim(left(description, length(description)-length(split_part(description,' ',-1))-1))"
_VALID = {
    "ledgers": "select * from ul",
    "sales": "select cs.* from cs join ul on party = name",
    "purchases": "select cp.* from cp join ul on supplier = name",
    "bank": "select cb.* replace (lower(type) as type) from cb where coalesce(exists (select 1 from ul where contains(description, ul.name)), false)",
    "entries": DERIVED_SQL["entries"].replace(_PARTY, f"case when contains(description, ' ') then {_PARTY} else '' end"),
    **{name: DERIVED_SQL[name] for name in ("monthly_trend", "party_outstanding")},
}


@query("etl_batches", _with_judged(f", {', '.join(f'{n} as ({sql})' for n, sql in _VALID.items())} {ANALYSIS_SQL}"))
def etl_batches(t):
    """Dirty files in two batches, the first loaded twice; the reports after all."""
    store, parts = scratch_dir(t.spark, "store"), []
    for second in (False, True):
        tables = {name: _half(getattr(t, f"dirty_{name}"), second, test) for name, test in (("sales", "invoice_no < 'INV5'"), ("purchases", "bill_no < 'PUR5'"))}
        tables["bank"] = _half(t.raw_bank, second, "txn_id < 'TXD3'")
        if not second:
            tables["ledgers"] = t.dirty_ledgers
        parts.append(_csvs(t, tables))
    for i, again in ((0, True), (1, False), (0, False)):
        reports = run_batch(t.spark, parts[i], store, dict.fromkeys(parts[i], f"part-{i}"), AS_OF, None if again else _dropping(t, parts[i]))
    return long_reports(reports)
