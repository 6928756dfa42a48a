"""Declared constraints as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import constraints as K
from daybook.schemas import BANK, ENTITIES, LEDGERS, PURCHASES, SALES
from daybook.suite.registry import query


def _by_table(parts: dict[str, DataFrame], key: dict[str, str], out: str) -> DataFrame:
    rows = [
        df.select(F.lit(name).alias("table_name"), F.col(key[name]).alias("key"), F.col(out))
        for name, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _joined(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.concat_ws(",", column))


_PK = "select '{t}' as table_name, {k} as key, count(*) as n_rows from {t} group by {k} having count(*) > 1 or {k} is null"


@query(
    "check_primary_key",
    " union all ".join(
        _PK.format(t=t, k=k)
        for t, k in (("ledgers", "ledger_id"), ("sales", "invoice_no"), ("purchases", "bill_no"), ("bank", "txn_id"))
    ),
)
def check_primary_key(t):
    parts = {e.name: K.check_primary_key(getattr(t, e.name), e.key) for e in ENTITIES.values()}
    return _by_table(parts, {e.name: e.key for e in ENTITIES.values()}, "n_rows")


@query(
    "check_unique",
    """
select 'ledgers' as table_name, name as key, count(*) as n_rows from ledgers
where name is not null group by name having count(*) > 1
union all
select 'purchases', bill_no, count(*) from purchases where bill_no is not null group by bill_no having count(*) > 1""",
)
def check_unique(t):
    parts = {
        "ledgers": K.check_unique(t.ledgers, LEDGERS.unique[0]),
        "purchases": K.check_unique(t.purchases, PURCHASES.key),
    }
    return _by_table(parts, {"ledgers": "name", "purchases": "bill_no"}, "n_rows")


@query(
    "check_not_null",
    """
select 'ledgers' as table_name, ledger_id as key, concat_ws(',', case when name is null then 'name' end,
       case when type is null then 'type' end) as null_columns
from raw_ledgers where name is null or type is null
union all
select 'bank', txn_id, concat_ws(',', case when date is null then 'date' end, case when type is null then 'type' end)
from raw_bank where date is null or type is null""",
)
def check_not_null(t):
    parts = {
        "ledgers": _joined(K.check_not_null(t.raw_ledgers, LEDGERS), "null_columns"),
        "bank": _joined(K.check_not_null(t.raw_bank, BANK), "null_columns"),
    }
    return _by_table(parts, {"ledgers": "ledger_id", "bank": "txn_id"}, "null_columns")


@query(
    "check_enum",
    """
select 'ledgers' as table_name, ledger_id as key, 'type' as bad_columns from raw_ledgers
where type is not null and type not in ('Customer','Supplier')
union all
select 'bank', txn_id, 'type' from raw_bank where type is not null and type not in ('credit','debit')""",
)
def check_enum(t):
    parts = {
        "ledgers": _joined(K.check_enum(t.raw_ledgers, LEDGERS), "bad_columns"),
        "bank": _joined(K.check_enum(t.raw_bank, BANK), "bad_columns"),
    }
    return _by_table(parts, {"ledgers": "ledger_id", "bank": "txn_id"}, "bad_columns")


@query(
    "check_foreign_key",
    """
select 'sales' as table_name, invoice_no as key, party from sales
where party is not null and party not in (select name from ledgers)
union all
select 'purchases', bill_no, supplier from purchases
where supplier is not null and supplier not in (select name from ledgers)""",
)
def check_foreign_key(t):
    sales = K.check_foreign_key(t.sales, SALES.reference, t.ledgers)
    purchases = K.check_foreign_key(t.purchases, PURCHASES.reference, t.ledgers)
    parts = {"sales": sales, "purchases": purchases.withColumnRenamed("supplier", "party")}
    return _by_table(parts, {"sales": "invoice_no", "purchases": "bill_no"}, "party")


@query(
    "check_varchar_len",
    """
select key, long_columns from (
  select txn_id as key, concat_ws(',', case when length(txn_id) > 20 then 'txn_id' end,
         case when length(description) > 255 then 'description' end,
         case when length(mode) > 20 then 'mode' end) as long_columns
  from (select concat(txn_id, '-', date) as txn_id, repeat(description, 11) as description, mode from raw_bank))
where long_columns <> ''""",
)
def check_varchar_len(t):
    wide = t.raw_bank.select(
        F.concat("txn_id", F.lit("-"), F.col("date").cast("string")).alias("txn_id"),
        F.repeat("description", F.lit(11)).alias("description"),
        "mode",
    )
    return _joined(K.check_varchar_len(wide, BANK), "long_columns").select(F.col("txn_id").alias("key"), "long_columns")


@query(
    "check_decimal_range",
    """
select invoice_no, amount from raw_sales
where amount is not null and try_cast(amount as decimal(10,2)) is null""",
)
def check_decimal_range(t):
    return K.check_decimal_range(t.raw_sales, ["amount"]).select("invoice_no", "amount")


def _profile(e, df) -> DataFrame:
    """Per declared column: its type, and how many rows hold a value."""
    counts = [F.count(c).alias(c) for c in e.columns]
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("declared_type"),
            F.col(f.name).alias("n_values"),
        )
        for f in e.schema
    ]
    wide = df.select(e.columns).agg(F.count("*").alias("_n"), *counts)
    return wide.select(
        F.lit(e.name).alias("table_name"), F.col("_n").alias("n_rows"), F.inline(F.array(*cells))
    )


_DECLARED = [(e.name, f.name, f.dataType.simpleString()) for e in ENTITIES.values() for f in e.schema]


@query(
    "schema_ddl",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows, '{c}' as column_name, '{d}' as declared_type, "
        f"count({c}) as n_values from {t}"
        for t, c, d in _DECLARED
    ),
)
def schema_ddl(t):
    for e in ENTITIES.values():
        actual = {f.name: f.dataType for f in getattr(t, e.name).schema}
        wrong = {f.name for f in e.schema if actual.get(f.name) != f.dataType}
        if wrong:
            raise TypeError(f"{e.name}: columns {sorted(wrong)} do not have their declared type")
    return reduce(DataFrame.unionByName, [_profile(e, getattr(t, e.name)) for e in ENTITIES.values()])
