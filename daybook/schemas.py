"""Declared shapes of the accounting entities.

Types are always declared, never inferred: inference costs an extra pass and may
type an id such as ``T1`` as a time of day.  Keys, domains and references are not
enforced by Spark; ``daybook.operators.constraints`` turns them into queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Entity:
    """One declared table: column types plus the constraints that go with them."""

    name: str
    schema: T.StructType
    key: str
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    reference: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def money(self) -> list[str]:
        return [f.name for f in self.schema if f.dataType == MONEY]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


LEDGERS = Entity(
    name="ledgers",
    schema=_struct(ledger_id=T.StringType(), name=T.StringType(), type=T.StringType()),
    key="ledger_id",
    required=("name", "type"),
    unique=("name",),
    domains={"type": ("Customer", "Supplier")},
    max_length={"ledger_id": 10, "name": 100},
)

SALES = Entity(
    name="sales",
    schema=_struct(
        date=T.DateType(),
        invoice_no=T.StringType(),
        party=T.StringType(),
        amount=MONEY,
        gst=MONEY,
        mode=T.StringType(),
        source=T.StringType(),
    ),
    key="invoice_no",
    required=("date", "party"),
    max_length={"invoice_no": 20, "party": 100, "mode": 20, "source": 20},
    reference="party",
)

PURCHASES = Entity(
    name="purchases",
    schema=_struct(
        date=T.DateType(),
        bill_no=T.StringType(),
        supplier=T.StringType(),
        amount=MONEY,
        gst=MONEY,
        mode=T.StringType(),
        source=T.StringType(),
    ),
    key="bill_no",
    required=("date", "supplier"),
    max_length={"bill_no": 20, "supplier": 100, "mode": 20, "source": 20},
    reference="supplier",
)

BANK = Entity(
    name="bank",
    schema=_struct(
        date=T.DateType(),
        txn_id=T.StringType(),
        description=T.StringType(),
        amount=MONEY,
        type=T.StringType(),
        mode=T.StringType(),
    ),
    key="txn_id",
    required=("date", "type"),
    domains={"type": ("credit", "debit")},
    max_length={"txn_id": 20, "description": 255, "mode": 20},
    reference="description",
)

ENTITIES: dict[str, Entity] = {e.name: e for e in (LEDGERS, SALES, PURCHASES, BANK)}


def entity(name: str) -> Entity:
    try:
        return ENTITIES[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; expected one of {sorted(ENTITIES)}") from None


# How a relational column type arrives in Spark.  Types that carry
# a precision are spelled by ``external_type``.
EXTERNAL_TYPES: dict[str, T.DataType] = {
    "TINYINT": T.IntegerType(),
    "TINYINT UNSIGNED": T.IntegerType(),
    "SMALLINT": T.IntegerType(),
    "SMALLINT UNSIGNED": T.IntegerType(),
    "MEDIUMINT": T.IntegerType(),
    "MEDIUMINT UNSIGNED": T.IntegerType(),
    "INT": T.IntegerType(),
    "INT UNSIGNED": T.LongType(),
    "BIGINT": T.LongType(),
    "BIGINT UNSIGNED": T.DecimalType(20, 0),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BIT": T.BinaryType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "TIME": T.StringType(),
    "YEAR": T.IntegerType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "TINYTEXT": T.StringType(),
    "TEXT": T.StringType(),
    "MEDIUMTEXT": T.StringType(),
    "LONGTEXT": T.StringType(),
    "BINARY": T.BinaryType(),
    "VARBINARY": T.BinaryType(),
    "TINYBLOB": T.BinaryType(),
    "BLOB": T.BinaryType(),
    "MEDIUMBLOB": T.BinaryType(),
    "LONGBLOB": T.BinaryType(),
    "JSON": T.StringType(),
    "ENUM": T.StringType(),
    "SET": T.StringType(),
    "GEOMETRY": T.BinaryType(),
    "VECTOR": T.BinaryType(),
}


def external_type(name: str, precision: int | None = None, scale: int = 0) -> T.DataType:
    """Spark type for a relational column type name."""
    kind = " ".join(name.upper().split())
    if kind.removesuffix(" UNSIGNED") == "DECIMAL":
        return T.DecimalType(min(precision or 10, 38), scale)
    if kind in ("BIT", "TINYINT") and precision == 1:
        return T.BooleanType()
    try:
        return EXTERNAL_TYPES[kind]
    except KeyError:
        raise ValueError(f"no Spark type for external type {name!r}") from None
