"""Relational tables over JDBC.

A plain JDBC read is one connection and one task.  ``scan_jdbc`` reads in
parallel: over equal ranges of a numeric or date column, or over predicates.  Ranges of
the primary key between its quantiles use its index and stay even when one party or day
owns a third of the table; hash predicates need no quantiles, but each of them
reads the whole table in the database.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from daybook.schemas import ENTITIES, Entity


@dataclass(frozen=True)
class JdbcTarget:
    """Connection settings; credentials come from the caller, never from here."""

    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000
    batch_size: int = 10_000
    #: Connections a sink opens at most.
    connections: int = 16

    def options(self, **extra: object) -> dict[str, str]:
        merged = {
            "url": self.url,
            "driver": self.driver,
            "fetchsize": self.fetch_size,
            "batchsize": self.batch_size,
            **self.properties,
            **extra,
        }
        return {k: str(v) for k, v in merged.items()}


@dataclass(frozen=True)
class Ranges:
    """Split a read into equal ranges of one numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, object]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": self.partitions,
        }


def hash_predicates(key: str, partitions: int, hash_expr: str = "MOD(CRC32({key}), {n})") -> list[str]:
    """One WHERE clause per partition; together they cover each row exactly once.

    ``hash_expr`` spells a bucket number of the key in the database's dialect.
    Rows with a NULL key go with bucket 0.
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    bucket = hash_expr.format(key=key, n=partitions)
    return [
        f"{bucket} = {i}" + (f" OR {key} IS NULL" if i == 0 else "") for i in range(partitions)
    ]


def _quoted(value: object) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def key_ranges(key: str, bounds: list) -> list[str]:
    """One WHERE clause per range of an indexed key between ascending bounds; NULL keys go with the first."""
    bounds = list(dict.fromkeys(bounds))
    if not bounds:
        return ["1 = 1"]
    low = [f"{key} >= {_quoted(b)}" for b in bounds]
    high = [f"{key} < {_quoted(b)}" for b in bounds]
    middle = [f"{a} AND {b}" for a, b in zip(low, high[1:])]
    return [f"{high[0]} OR {key} IS NULL", *middle, low[-1]]


def quantiles_query(table: str, key: str, partitions: int) -> str:
    """A statement, run in the database over its index, for the first key of each of n equal parts but the first."""
    return (
        f"(SELECT MIN({key}) AS bound FROM (SELECT {key}, NTILE({partitions}) OVER (ORDER BY {key}) AS part "
        f"FROM {table} WHERE {key} IS NOT NULL) parts WHERE part > 1 GROUP BY part) bounds"
    )


def key_bounds(spark: SparkSession, target: JdbcTarget, table: str, key: str, partitions: int) -> list:
    """The bounds themselves: at most ``partitions`` values."""
    found = spark.read.format("jdbc").options(**target.options(dbtable=quantiles_query(table, key, partitions))).load()
    return sorted(row[0] for row in found.collect())


def scan_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    ranges: Ranges | None = None,
    predicates: list[str] | None = None,
    entity: Entity | None = None,
) -> DataFrame:
    """A table, with the declared types of ``entity`` if one is given."""
    if ranges and predicates:
        raise ValueError("give ranges or predicates, not both")
    declared = typed_options(entity) if entity else {}
    if predicates:
        properties = {k: v for k, v in target.options(**declared).items() if k != "url"}
        return spark.read.jdbc(target.url, table, predicates=predicates, properties=properties)
    extra = ranges.options() if ranges else {}
    return spark.read.format("jdbc").options(**target.options(dbtable=table, **extra, **declared)).load()


def typed_options(entity: Entity) -> dict[str, str]:
    """The reader's own types replaced by the declared ones."""
    return {"customSchema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entity.schema)}


def read_entities(
    spark: SparkSession,
    target: JdbcTarget,
    partitions: int = 64,
    suffix: str = "_cleaned",
    bounds: dict[str, list] | None = None,
) -> dict[str, DataFrame]:
    """The four accounting tables with declared types, each read in parallel over ranges of its primary key.

    ``bounds``: table -> ascending keys to cut at; without them the database is asked for quantiles.
    """

    def read(name: str, entity: Entity) -> DataFrame:
        table = f"{name}{suffix}"
        cuts = bounds[name] if bounds else key_bounds(spark, target, table, entity.key, partitions)
        return scan_jdbc(spark, target, table, predicates=key_ranges(entity.key, cuts), entity=entity)

    return {name: read(name, entity) for name, entity in ENTITIES.items()}
