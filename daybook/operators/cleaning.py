"""Cleaning rules, each usable alone and chained by ``clean``.

The chain order is trim, (optional) standardise, types, nulls.  ``split_clean``
evaluates the same rules once and keeps what they would drop, with the reasons.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import text
from daybook.functions.labels import any_failed, failed
from daybook.operators.constraints import row_rules
from daybook.schemas import Entity

# Which columns the text and null rules look at.
STANDARD_COLUMNS = ("type", "mode", "category", "source", "party", "name", "supplier")
NEVER_NULL = ("name", "amount", "type")

REASONS = "reasons"


def columns_present(df: DataFrame, names: tuple[str, ...] | list[str]) -> list[str]:
    have = set(df.columns)
    return [name for name in names if name in have]


def columns_by_type(df: DataFrame, dtype: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, dtype)]


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    # one projection: a withColumn per column re-analyses the plan each time
    return df.withColumns(new) if new else df


def trim_strings(df: DataFrame) -> DataFrame:
    return _replace(df, {c: F.trim(F.col(c)) for c in columns_by_type(df, T.StringType)})


def standardize_text(df: DataFrame) -> DataFrame:
    """Title-case the descriptive columns.

    Not part of the default chain: it rewrites ledger names (``ABC Corp`` becomes
    ``Abc Corp``) while bank descriptions keep theirs, so references break.
    """
    return _replace(df, {c: text.standardized(F.col(c)) for c in columns_present(df, STANDARD_COLUMNS)})


def parse_dates(df: DataFrame) -> DataFrame:
    if "date" not in df.columns:
        return df
    return df.withColumn("date", text.parse_date(F.col("date"), df.schema["date"].dataType))


def filter_valid_date(df: DataFrame, as_of: date | str | None = None) -> DataFrame:
    if "date" not in df.columns:
        return df
    # a NULL date does not compare, so it goes as well
    return df.filter(F.col("date") <= text.cutoff(as_of))


def parse_amounts(df: DataFrame, columns: tuple[str, ...] | list[str] = ("amount",)) -> DataFrame:
    return _replace(df, {c: text.parse_amount(F.col(c)) for c in columns_present(df, columns)})


def filter_amount_nonneg(df: DataFrame) -> DataFrame:
    return df.filter(F.col("amount") >= 0) if "amount" in df.columns else df


def datatypes_cleaning(df: DataFrame, as_of: date | str | None = None) -> DataFrame:
    return (
        df.transform(parse_dates)
        .transform(filter_valid_date, as_of)
        .transform(parse_amounts)
        .transform(filter_amount_nonneg)
    )


def drop_nulls(df: DataFrame) -> DataFrame:
    subset = columns_present(df, NEVER_NULL)
    return df.dropna(how="any", subset=subset) if subset else df


def clean(df: DataFrame, as_of: date | str | None = None, standardize: bool = False) -> DataFrame:
    trimmed = trim_strings(df)
    if standardize:
        trimmed = standardize_text(trimmed)
    return trimmed.transform(datatypes_cleaning, as_of).transform(drop_nulls)


def _rules(df: DataFrame, as_of: date | str | None) -> dict[str, Column]:
    """Reason -> condition under which a trimmed and parsed row is dropped, in chain order."""
    rules: dict[str, Column] = {}
    if "date" in df.columns:
        rules["bad_date"] = F.col("date").isNull()
        rules["future_date"] = F.col("date") > text.cutoff(as_of)
    if "amount" in df.columns:
        rules["bad_amount"] = F.col("amount").isNull()
        rules["negative_amount"] = F.col("amount") < 0
    for name in columns_present(df, NEVER_NULL):
        if name != "amount":
            rules[f"null_{name}"] = F.col(name).isNull()
    return rules


def _entity_rules(df: DataFrame, entity: Entity, malformed: str | None) -> dict[str, Column]:
    """What a declared table refuses beyond the cleaning rules: values that did not survive parsing, broken row
    constraints, lines with missing or surplus cells."""
    rules: dict[str, Column] = {}
    if malformed:
        rules["malformed_line"] = F.col(malformed).isNotNull()
    for c in columns_present(df, entity.money):
        if c != "amount":
            given = F.trim(F.col("raw")[c].cast("string"))
            rules[f"bad_{c}"] = F.col(c).isNull() & given.isNotNull() & (given != "")
    for name, broken in row_rules(df, entity).items():
        kind, _, column = name.partition(":")
        if kind != "not_null":
            rules[f"{kind}_{column}"] = broken
        elif column == entity.key:
            rules["null_key"] = broken
        elif column != "date" and column not in NEVER_NULL:  # these have reasons of their own
            rules[f"null_{column}"] = broken
    return rules


def judge(
    df: DataFrame, as_of: date | str | None = None, entity: Entity | None = None, malformed: str | None = None
) -> DataFrame:
    """Every row trimmed and parsed, with the row as it came (``raw``) and the rules it breaks.

    ``reasons`` is empty for a row that ``clean`` keeps.  With ``entity``, all its money columns are
    parsed and its row constraints count too, so that a row without reasons lost no value;
    ``malformed`` names the column with lines that did not have the header's cells.
    """
    parsed = (
        df.withColumn("raw", F.struct(*df.columns))
        .transform(trim_strings)
        .transform(parse_dates)
        .transform(parse_amounts, ("amount", *(entity.money if entity else ())))
    )
    rules = _rules(parsed, as_of)
    if entity:
        rules |= _entity_rules(parsed, entity, malformed)
    return parsed.withColumn(REASONS, failed(rules))


def rejects(df: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """The rows ``clean`` would drop, as they came, with the reasons."""
    judged = judge(df, as_of)
    return judged.filter(any_failed(_rules(judged, as_of))).select("raw.*", REASONS)


def split_clean(df: DataFrame, as_of: date | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects); together they hold every input row exactly once."""
    return clean(df, as_of), rejects(df, as_of)
