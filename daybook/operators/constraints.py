"""Declared constraints as queries that return the violating rows.

Key checks aggregate, so Spark combines partial counts before the shuffle and a
repeated key costs one row per map task however often it occurs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.labels import any_failed, failed
from daybook.schemas import MONEY, Entity


def check_primary_key(df: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row count."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n_rows"))
        .filter((F.col("n_rows") > 1) | F.col(key).isNull())
    )


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; NULLs do not collide with each other."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def _failing(df: DataFrame, tests: dict, out: str) -> DataFrame:
    """Rows failing any test, with the names of the failed columns; one pass."""
    return df.filter(any_failed(tests)).withColumn(out, failed(tests))


def check_not_null(df: DataFrame, entity: Entity) -> DataFrame:
    required = dict.fromkeys((entity.key, *entity.required))
    return _failing(df, {c: F.col(c).isNull() for c in required}, "null_columns")


def check_enum(df: DataFrame, entity: Entity) -> DataFrame:
    return _failing(df, {c: ~F.col(c).isin(*domain) for c, domain in entity.domains.items()}, "bad_columns")


def check_varchar_len(df: DataFrame, entity: Entity) -> DataFrame:
    return _failing(df, {c: F.length(c) > n for c, n in entity.max_length.items()}, "long_columns")


def check_decimal_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value that DECIMAL(10,2) cannot hold."""
    tests = {c: F.col(c).isNotNull() & F.col(c).try_cast(MONEY).isNull() for c in columns}
    return _failing(df, tests, "wide_columns")


def check_foreign_key(df: DataFrame, column: str, ledgers: DataFrame) -> DataFrame:
    """Rows whose non-NULL reference has no ledger."""
    names = ledgers.select(F.col("name").alias("_ledger_name"))
    return df.filter(F.col(column).isNotNull()).join(
        names, F.col(column) == F.col("_ledger_name"), "left_anti"
    )


def row_rules(df: DataFrame | Iterable[str], entity: Entity) -> dict[str, Column]:
    """Constraint -> condition under which a row breaks it, for the columns that ``df`` (a frame or their names) has.

    Domains are compared without regard to case, as the declaring database does.
    """
    have = set(df.columns if isinstance(df, DataFrame) else df)
    rules = {f"not_null:{c}": F.col(c).isNull() for c in dict.fromkeys((entity.key, *entity.required)) if c in have}
    for c, domain in entity.domains.items():
        if c in have:
            rules[f"domain:{c}"] = ~F.lower(F.col(c)).isin(*[d.lower() for d in domain])
    rules |= {f"length:{c}": F.length(c) > n for c, n in entity.max_length.items() if c in have}
    return rules


def row_rule_violations(df: DataFrame, entity: Entity) -> DataFrame:
    """(table_name, constraint, key, n_rows): a line per row and row rule that it breaks."""
    rules = row_rules(df, entity)
    key = F.col(entity.key).cast("string").alias("key")
    name, one = F.lit(entity.name).alias("table_name"), F.lit(1).cast("bigint").alias("n_rows")
    return df.filter(any_failed(rules)).select(name, F.explode(failed(rules)).alias("constraint"), key, one)


def violations(df: DataFrame, entity: Entity, ledgers: DataFrame | None = None) -> DataFrame:
    """(table_name, constraint, key, n_rows): every broken constraint of a table, by name.

    Row rules give a line per row and rule; ``primary_key`` and ``unique:<column>`` one per repeated value; with
    ``ledgers``, ``reference:<column>`` one per row whose reference has no ledger.
    """
    name, key = F.lit(entity.name).alias("table_name"), F.col(entity.key).cast("string").alias("key")
    one = F.lit(1).cast("bigint").alias("n_rows")
    out = row_rule_violations(df, entity)
    repeated = [("primary_key", check_unique(df, entity.key), entity.key)]
    repeated += [(f"unique:{c}", check_unique(df, c), c) for c in entity.unique]
    for constraint, found, column in repeated:
        out = out.unionByName(
            found.select(name, F.lit(constraint).alias("constraint"), F.col(column).cast("string").alias("key"), "n_rows")
        )
    if ledgers is not None and entity.reference in ("party", "supplier"):
        broken = check_foreign_key(df, entity.reference, ledgers)
        out = out.unionByName(broken.select(name, F.lit(f"reference:{entity.reference}").alias("constraint"), key, one))
    return out
