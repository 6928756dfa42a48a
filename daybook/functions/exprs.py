"""Expression operators by name, over Columns.

Comparison, LIKE and REGEXP are case-sensitive, as in Spark.
"""

from __future__ import annotations

import json
import operator
import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def all_of(*conditions: Column) -> Column:
    return reduce(operator.and_, conditions)


def any_of(*conditions: Column) -> Column:
    """OR of the conditions; false where there is none."""
    return reduce(operator.or_, conditions, F.lit(False))


def negate(condition: Column) -> Column:
    return ~condition


# Operator spellings.
COMPARISONS: dict[str, Callable] = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
}

ARITHMETIC: dict[str, Callable] = {
    "+": operator.add,
    "-": operator.sub,
    "*": operator.mul,
    "/": F.try_divide,
    "div": F.try_divide,
    "%": F.try_mod,
}

BITS: dict[str, Callable] = {
    "&": Column.bitwiseAND,
    "|": Column.bitwiseOR,
    "^": Column.bitwiseXOR,
    "<<": lambda a, n: F.call_function("shiftleft", a, n),
    ">>": lambda a, n: F.call_function("shiftright", a, n),
}


def compare(op: str, left: object, right: object) -> Column:
    return COMPARISONS[op](_column(left), _column(right))


def arith(op: str, left: object, right: object) -> Column:
    """Division and remainder by zero give NULL."""
    return ARITHMETIC[op](_column(left), _column(right))


def sign(op: str, value: object) -> Column:
    """Unary ``+`` and ``-``."""
    return {"+": _column(value), "-": -_column(value)}[op]


def bits(op: str, left: object, right: object) -> Column:
    return BITS[op](_column(left), _column(right))


def bit_not(value: Column) -> Column:
    return F.bitwise_not(value)


def is_(value: Column, what: bool | None) -> Column:
    """IS NULL / IS TRUE / IS FALSE; never unknown."""
    return F.equal_null(value, F.lit(what).cast("boolean")) if what is not None else value.isNull()


def is_not(value: Column, what: bool | None) -> Column:
    return ~is_(value, what)


def in_list(value: Column, *options: object) -> Column:
    return value.isin(*options)


def contained_in(value: object, container: Column, dtype: T.DataType | None = None) -> Column:
    """``value in container``: an element of an array, or equal to a scalar.

    ``dtype`` is the container's type where it is not an array.  A NULL container or value makes
    the result NULL, except that a NULL element of an array contains a NULL value.
    """
    wanted = _column(value)
    if dtype is not None and not isinstance(dtype, T.ArrayType):
        return container == wanted
    held = F.when(wanted.isNull(), F.exists(container, lambda x: x.isNull()))
    return F.when(container.isNotNull(), held.otherwise(F.coalesce(F.array_contains(container, wanted), F.lit(False))))


def json_contained_in(value: object, json_text: Column, path: str, dtype: str = "string") -> Column:
    """``value in $.path`` of a JSON text whose member may be an array or a scalar; NULL where it is missing."""
    member = F.try_variant_get(F.try_parse_json(json_text), path, "variant")
    items = F.try_variant_get(F.try_parse_json(json_text), path, "array<variant>")
    wanted = _column(value)
    is_null = F.schema_of_variant(member) == "VOID"
    inside = F.exists(items, lambda x: F.when(wanted.isNull(), F.schema_of_variant(x) == "VOID").otherwise(F.coalesce(F.try_variant_get(x, "$", dtype) == wanted, F.lit(False))))
    equal = F.when(wanted.isNull(), is_null).otherwise(F.coalesce(F.try_variant_get(member, "$", dtype) == wanted, F.lit(False)))
    return F.when(member.isNotNull(), F.when(items.isNotNull(), inside).otherwise(equal))


def array_contained_in(inner: Column, outer: Column) -> Column:
    """Every element of one array in another."""
    return F.size(F.array_except(inner, outer)) == 0


def like(value: Column, pattern: object, escape: str | None = None) -> Column:
    """The pattern may be a text or any Column."""
    return F.like(value, _column(pattern), F.lit(escape)) if escape else F.like(value, _column(pattern))


def between(value: Column, low: object, high: object) -> Column:
    return value.between(low, high)


def regexp(value: Column, pattern: object) -> Column:
    """The pattern may be a text or any Column."""
    return F.rlike(value, _column(pattern))


def overlaps(left: Column, right: Column) -> Column:
    """Two arrays sharing an element; NULL elements do not count."""
    return F.arrays_overlap(F.array_compact(left), F.array_compact(right))


# -- dates -------------------------------------------------------------------

# Interval units.
SIMPLE_UNITS = ("MICROSECOND", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")
_CLOCK = ("DAY", "HOUR", "MINUTE", "SECOND", "MICROSECOND")


def interval_add(when: Column, amount: object, unit: str) -> Column:
    """Date plus INTERVAL amount unit; a negative amount subtracts."""
    if unit.upper() not in SIMPLE_UNITS:
        raise ValueError(f"unknown interval unit {unit!r}")
    return F.timestamp_add(unit.upper(), _column(amount), when)


def _composite_units(unit: str) -> tuple[str, ...]:
    """Units of a composite interval, largest first."""
    first, _, last = unit.upper().partition("_")
    ladder = ("YEAR", "MONTH") if (first, last) == ("YEAR", "MONTH") else _CLOCK
    if first not in ladder or last not in ladder or ladder.index(first) >= ladder.index(last):
        raise ValueError(f"unknown interval unit {unit!r}")
    return ladder[ladder.index(first) : ladder.index(last) + 1]


def _composite_parts(unit: str, text: str) -> dict[str, int]:
    """Numbers of a composite interval such as ``10:20``, last number to last unit."""
    units = _composite_units(unit)
    numbers = re.findall(r"\d+", text)
    if not numbers or len(numbers) > len(units):
        raise ValueError(f"{text!r} is not an interval of {unit}")
    if units[-1] == "MICROSECOND":
        numbers[-1] = numbers[-1].ljust(6, "0")
    sign = -1 if text.lstrip().startswith("-") else 1
    return {u: sign * int(n) for u, n in zip(units[-len(numbers) :], numbers)}


def _composite_columns(unit: str, text: Column) -> dict[str, Column]:
    """The same numbers of a text known only row by row; NULL where it is no such interval."""
    units = _composite_units(unit)
    numbers = F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))
    fits = F.size(numbers).between(1, len(units))
    sign = F.when(F.ltrim(text).startswith("-"), -1).otherwise(1)
    parts = {}
    for place, name in enumerate(reversed(units)):
        number = F.try_element_at(numbers, F.lit(-1 - place))
        if name == "MICROSECOND":
            number = F.when(F.length(number) < 6, F.rpad(number, 6, "0")).otherwise(number)
        parts[name] = F.when(fits, F.coalesce(number.try_cast("int"), F.when(F.size(numbers) <= place, F.lit(0))) * sign)
    return dict(reversed(parts.items()))


def interval_composite(when: Column, text: str | Column, unit: str, sign: int = 1) -> Column:
    """Date plus (or, with sign -1, minus) a composite interval, e.g. MINUTE_SECOND '10:20'.

    A text that is no such interval is an error, or NULL where it is a Column.
    """
    parts = _composite_columns(unit, text) if isinstance(text, Column) else _composite_parts(unit, text)
    return reduce(lambda day, part: interval_add(day, F.lit(sign) * part[1], part[0]), parts.items(), when)


# -- casts -------------------------------------------------------------------


def cast_as(value: Column, target: str) -> Column:
    """CAST by the relational type names; a value that does not fit is NULL.

    SIGNED and UNSIGNED round numbers and numeric text half away from zero; UNSIGNED is 0 to 2^64 - 1.
    """
    # The names of the cast targets.
    kind, *size = re.findall(r"[A-Za-z]+|\d+", target.upper())
    numbers = [int(n) for n in size if n.isdigit()]
    if kind == "DECIMAL":
        precision, scale = (numbers + [10, 0][len(numbers) :])[:2]
        return value.try_cast(T.DecimalType(precision, scale))
    if kind == "CHAR":
        text = value.cast("string")
        return F.left(text, F.lit(numbers[0])) if numbers else text
    if kind == "BINARY":
        raw = value.cast("string").cast("binary")
        return F.substring(raw, 1, numbers[0]) if numbers else raw
    if kind == "SIGNED":
        return F.round(value.try_cast(T.DecimalType(38, 10))).try_cast("bigint")
    if kind == "UNSIGNED":
        whole = F.round(value.try_cast(T.DecimalType(38, 10))).try_cast(T.DecimalType(20, 0))
        return F.when(whole.between(F.lit(0), F.lit(str(2**64 - 1)).cast(T.DecimalType(20, 0))), whole)
    if kind == "DATE":
        return value.try_cast("date")
    if kind == "DATETIME":
        return value.try_cast("timestamp_ntz")
    if kind == "TIME":
        # by text: formatting would move wall clock times the session's zone skips
        return F.substring(value.try_cast("timestamp_ntz").cast("string"), 12, 8)
    if kind == "JSON":
        return F.try_parse_json(value)
    raise ValueError(f"unknown cast target {target!r}")


# -- JSON --------------------------------------------------------------------


def json_object(members: Mapping[str, object]) -> Column:
    return F.to_json(F.struct(*[_column(v).alias(k) for k, v in members.items()]))


def json_array(*values: object) -> Column:
    return F.array(*[_column(v) for v in values])


# How Spark names the types inside a VARIANT, and what JSON calls them.
_KINDS = {
    "OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "BIGINT": "number", "INT": "number",
    "SMALLINT": "number", "TINYINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number", "DATE": "string",
    "TIMESTAMP": "string", "TIMESTAMP_NTZ": "string", "BINARY": "string",
}


def kind_of(variant: Column) -> Column:
    """object, array, string, boolean, number or null for a VARIANT; NULL where there is none."""
    names = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.try_element_at(names, F.regexp_extract(F.schema_of_variant(variant), "^[A-Z_]+", 0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def variant_step(step: str | int) -> str:
    """One step of a VARIANT path."""
    if isinstance(step, int):
        return f"[{step}]"
    if "'" in step and '"' in step:
        raise ValueError(f"no path leads to a member named {step!r}")
    return f"['{step}']" if "'" not in step else f'["{step}"]'


def json_literal(value: object) -> Column:
    """A VARIANT of a plain value: None, numbers, texts, lists, mappings with text keys."""
    return F.parse_json(F.lit(json.dumps(value, ensure_ascii=False, default=str)))


def doc_path(json_text: Column, path: str, dtype: str = "string") -> Column:
    """``column->'$.path'`` with a type; NULL where the path is missing."""
    return F.try_variant_get(F.try_parse_json(json_text), path, dtype)


def doc_path_elements(json_text: Column, path: str) -> Column:
    """``path[*]`` or ``path[*].member``: all matches, as text; NULL where the first array is missing.

    Each ``[*]`` opens one array; elements without what follows it are left out.
    """
    first, *rest = path.split("[*]")
    items = T.ArrayType(T.StringType())

    def member(step: str, opened: bool) -> Callable[[Column], Column]:
        def of(x: Column) -> Column:
            found = F.get_json_object(x, "$" + step) if step else x
            return F.from_json(found, items) if opened else found

        return of

    found = F.from_json(F.get_json_object(json_text, first), items)
    for i, step in enumerate(rest):
        opened = i < len(rest) - 1
        if step or opened:
            found = F.array_compact(F.transform(found, member(step, opened)))
            found = F.flatten(found) if opened else found
    return found


def doc_path_members(json_text: Column) -> Column:
    """``$.*``: all member values of an object, as text."""
    return F.map_values(F.from_json(json_text, T.MapType(T.StringType(), T.StringType())))


def doc_path_anywhere(root: Column, schema: T.StructType, member: str) -> Column:
    """``**.member``: the values of a member at any depth of a typed document, arrays included, as text."""
    none = F.array().cast("array<string>")

    def walk(value: Column, dtype: T.DataType) -> Column | None:
        """Array of the values found below; None where the type has no such member."""
        if isinstance(dtype, T.ArrayType):
            if walk(F.lit(None).cast(dtype.elementType), dtype.elementType) is None:
                return None
            return F.coalesce(F.flatten(F.transform(value, lambda x: walk(x, dtype.elementType))), none)
        if not isinstance(dtype, T.StructType):
            return None
        found = []
        for f in dtype:
            child = value.getField(f.name)
            if f.name == member:
                found.append(F.array(child.cast("string")))
            below = walk(child, f.dataType)
            if below is not None:
                found.append(below)
        return F.concat(*found) if found else None

    hits = walk(root, schema)
    return none if hits is None else F.array_compact(hits)


def func(name: str, *args: object) -> Column:
    """Call a function by name, schema-qualified or not."""
    return F.call_function(name, *[_column(a) for a in args])
