"""JSON schemas compiled to expressions over VARIANT.

``violations`` turns a schema into one expression that lists what a document breaks, as ``keyword:path`` with
paths such as ``$.lines[2].qty``.  Nothing is interpreted per row: nested objects and list items become nested
expressions when the plan is made.  A keyword that is not known is an error, not ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.exprs import json_literal, kind_of, let, variant_step

# The keywords, by the kind of value they speak about; the last only describe.
_ANY = ("type", "enum", "const", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref")
_OBJECT = ("properties", "required", "additionalProperties", "patternProperties", "minProperties", "maxProperties", "dependencies")
_ARRAY = ("items", "additionalItems", "minItems", "maxItems", "uniqueItems")
_NUMBER = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")
_STRING = ("minLength", "maxLength", "pattern")
_SILENT = ("title", "description", "default", "examples", "$schema", "$id", "id", "$comment", "definitions", "$defs")
_KINDS = ("object", "array", "string", "number", "boolean", "null", "integer")

_NONE = "array<string>"


def _exact(value: Column) -> tuple[Column, Column]:
    """A number as DECIMAL, NULL if it does not fit, and as DOUBLE."""
    return F.try_variant_get(value, "$", "decimal(38,9)"), F.try_variant_get(value, "$", "double")


def _compared(value: Column, test, bound) -> Column:
    exact, double = _exact(value)
    return F.coalesce(test(exact, F.lit(Decimal(str(bound)))), test(double, F.lit(float(bound))))


def _whole(value: Column) -> Column:
    exact, double = _exact(value)
    return F.coalesce(exact == F.floor(exact), double == F.floor(double))


def _equals(value: Column, kind: Column, wanted: object) -> Column:
    if isinstance(wanted, (int, float)) and not isinstance(wanted, bool):
        return (kind == "number") & _compared(value, lambda a, b: a == b, wanted)
    return F.to_json(value) == F.to_json(json_literal(wanted))


class _Compiler:
    """One schema document: resolves references into it and compiles its parts."""

    def __init__(self, root: Mapping):
        self.root = root

    def _resolve(self, ref: str, seen: tuple[str, ...]) -> object:
        if not ref.startswith("#"):
            raise ValueError(f"reference {ref!r} leads out of the schema")
        if ref in seen:
            raise ValueError(f"reference {ref!r} leads back to itself: such a schema has no finite expression")
        part: object = self.root
        for step in [s for s in ref[1:].split("/") if s]:
            step = step.replace("~1", "/").replace("~0", "~")
            if not isinstance(part, Mapping) or step not in part:
                raise ValueError(f"reference {ref!r} leads nowhere")
            part = part[step]
        return part

    def of(self, schema: object, value: Column, path: Column, seen: tuple[str, ...] = ()) -> Column:
        """Array of the violations of ``schema`` by a value that is there."""
        none = F.array().cast(_NONE)
        if schema is True:
            return none
        if schema is False:
            return F.array(F.concat(F.lit("never:"), path))
        if not isinstance(schema, Mapping):
            raise ValueError(f"not a schema: {schema!r}")
        unknown = [k for k in schema if k not in (*_ANY, *_OBJECT, *_ARRAY, *_NUMBER, *_STRING, *_SILENT)]
        if unknown:
            raise ValueError(f"unknown keywords {unknown}")
        if "$ref" in schema:  # what stands beside a reference does not count
            return self.of(self._resolve(schema["$ref"], seen), value, path, (*seen, schema["$ref"]))
        kind = kind_of(value)
        found: list[Column] = []

        def refuse(keyword: str, broken: Column) -> None:
            found.append(F.when(F.coalesce(broken, F.lit(False)), F.array(F.concat(F.lit(keyword + ":"), path))).otherwise(none))

        self._any(schema, value, kind, path, seen, refuse, found)
        self._numbers_and_texts(schema, value, kind, refuse)
        if any(k in schema for k in _OBJECT):
            self._object(schema, value, kind, path, seen, refuse, found)
        if any(k in schema for k in _ARRAY):
            self._array(schema, value, kind, path, seen, refuse, found)
        return F.concat(*found) if len(found) > 1 else found[0] if found else none

    def _any(self, schema, value, kind, path, seen, refuse, found) -> None:
        if "type" in schema:
            types = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
            wrong = [t for t in types if t not in _KINDS]
            if wrong:
                raise ValueError(f"unknown types {wrong}")
            fits = [(kind == "number") & _whole(value) if t == "integer" else kind == t for t in types]
            refuse("type", ~F.coalesce(reduce(or_, fits, F.lit(False)), F.lit(False)))
        for keyword, options in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
            if options is not None:
                refuse(keyword, ~F.coalesce(reduce(or_, [_equals(value, kind, o) for o in options], F.lit(False)), F.lit(False)))

        def holds(part: object) -> Column:
            return F.size(self.of(part, value, path, seen)) == 0

        for part in schema.get("allOf", ()):
            found.append(self.of(part, value, path, seen))
        if "anyOf" in schema:
            refuse("anyOf", ~reduce(or_, [holds(p) for p in schema["anyOf"]]))
        if "oneOf" in schema:
            refuse("oneOf", reduce(lambda a, b: a + b, [holds(p).cast("int") for p in schema["oneOf"]]) != 1)
        if "not" in schema:
            refuse("not", holds(schema["not"]))
        if "if" in schema:
            ways = [self.of(schema.get(way, True), value, path, seen) for way in ("then", "else")]
            found.append(F.when(holds(schema["if"]), ways[0]).otherwise(ways[1]))

    def _numbers_and_texts(self, schema, value, kind, refuse) -> None:
        number, text = kind == "number", kind == "string"
        bounds = {
            "minimum": lambda a, b: a < b,
            "maximum": lambda a, b: a > b,
            "exclusiveMinimum": lambda a, b: a <= b,
            "exclusiveMaximum": lambda a, b: a >= b,
        }
        for keyword, test in bounds.items():
            bound = schema.get(keyword)
            if keyword.startswith("exclusive") and isinstance(bound, bool):  # the older spelling: it sharpens the plain bound
                bound = schema.get(keyword[len("exclusive") :].lower()) if bound else None
            if bound is not None:
                refuse(keyword, number & _compared(value, test, bound))
        if "multipleOf" in schema:
            step = schema["multipleOf"]
            if step <= 0:
                raise ValueError("multipleOf must be above 0")
            refuse("multipleOf", number & _compared(value, lambda a, b: F.try_mod(a, b) != 0, step))
        held = F.try_variant_get(value, "$", "string")
        if "minLength" in schema:
            refuse("minLength", text & (F.length(held) < schema["minLength"]))
        if "maxLength" in schema:
            refuse("maxLength", text & (F.length(held) > schema["maxLength"]))
        if "pattern" in schema:
            refuse("pattern", text & ~held.rlike(schema["pattern"]))

    def _object(self, schema, value, kind, path, seen, refuse, found) -> None:
        is_object, none = kind == "object", F.array().cast(_NONE)
        members = F.when(is_object, F.try_variant_get(value, "$", "map<string,variant>"))  # opened for the keywords about all members
        properties, patterns = schema.get("properties", {}), schema.get("patternProperties", {})

        def below(name: str) -> Column:
            return F.concat(path, F.lit("." + name))

        def member(name: str) -> Column:
            return F.try_variant_get(value, "$" + variant_step(name), "variant")

        def of_member(part: object, name: str) -> Column:
            there = lambda m: F.when(m.isNotNull(), self.of(part, m, below(name), seen)).otherwise(none)
            return let(member(name), there)

        for name in schema.get("required", ()):
            missing = is_object & member(name).isNull()
            found.append(F.when(F.coalesce(missing, F.lit(False)), F.array(F.concat(F.lit("required:"), below(name)))).otherwise(none))
        for name, part in properties.items():
            found.append(of_member(part, name))
        for name, needed in schema.get("dependencies", {}).items():
            if isinstance(needed, Sequence) and not isinstance(needed, str):
                for other in needed:
                    missing = member(name).isNotNull() & member(other).isNull()
                    found.append(F.when(missing, F.array(F.concat(F.lit("dependencies:"), below(other)))).otherwise(none))
            else:
                found.append(F.when(member(name).isNotNull(), self.of(needed, value, path, seen)).otherwise(none))
        entries = F.map_entries(members)

        def each(part: object, chosen) -> Column:
            picked = F.filter(entries, chosen)
            judged = F.transform(picked, lambda e: self.of(part, e["value"], F.concat(path, F.lit("."), e["key"]), seen))
            return F.coalesce(F.flatten(judged), none)

        def matching(pattern: str):
            return lambda e: e["key"].rlike(pattern)

        for pattern, part in patterns.items():
            found.append(each(part, matching(pattern)))
        more = schema.get("additionalProperties", True)
        if more is not True:

            def other(entry: Column) -> Column:
                known = reduce(or_, [entry["key"].rlike(p) for p in patterns], F.lit(False))
                return ~(known | (entry["key"].isin(*properties) if properties else F.lit(False)))

            if more is False:
                names = F.transform(F.filter(entries, other), lambda e: F.concat(F.lit("additionalProperties:"), path, F.lit("."), e["key"]))
                found.append(F.coalesce(names, none))
            else:
                found.append(each(more, other))
        if "minProperties" in schema:
            refuse("minProperties", F.size(members) < schema["minProperties"])
        if "maxProperties" in schema:
            refuse("maxProperties", F.size(members) > schema["maxProperties"])

    def _spot(self, part: object, path: Column, seen: tuple[str, ...]):
        return lambda x: F.when(x.isNotNull(), self.of(part, x, path, seen)).otherwise(F.array().cast(_NONE))

    def _array(self, schema, value, kind, path, seen, refuse, found) -> None:
        none = F.array().cast(_NONE)
        elements = F.when(kind == "array", F.try_variant_get(value, "$", "array<variant>"))
        items, more = schema.get("items", True), schema.get("additionalItems", True)

        def each(part: object, first: int = 0) -> Column:
            judged = F.transform(
                elements,
                lambda x, i: F.when(i >= first, self.of(part, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), seen)).otherwise(none),
            )
            return F.coalesce(F.flatten(judged), none)

        if isinstance(items, Sequence) and not isinstance(items, str):  # one schema for each place
            for i, part in enumerate(items):
                found.append(let(F.get(elements, F.lit(i)), self._spot(part, F.concat(path, F.lit(f"[{i}]")), seen)))
            if more is not True:
                found.append(each(more, len(items)))
        elif items is not True:
            found.append(each(items))
        if "minItems" in schema:
            refuse("minItems", F.size(elements) < schema["minItems"])
        if "maxItems" in schema:
            refuse("maxItems", F.size(elements) > schema["maxItems"])
        if schema.get("uniqueItems"):
            refuse("uniqueItems", F.size(F.array_distinct(F.transform(elements, lambda x: F.to_json(x)))) < F.size(elements))


def violations(schema: Mapping, doc: Column) -> Column:
    """Array of what a VARIANT document breaks of a schema, as ``keyword:path``; NULL for a NULL document."""
    return let(doc, lambda d: F.when(d.isNotNull(), _Compiler(schema).of(schema, d, F.lit("$"))))


def judge(df: DataFrame, text: str, schema: Mapping) -> DataFrame:
    """Add ``violations`` of a column of JSON texts; a text that is not JSON, or NULL, is ``malformed``."""
    parsed = df.withColumn("_json", F.try_parse_json(text))
    return parsed.withColumn("violations", F.coalesce(violations(schema, F.col("_json")), F.array(F.lit("malformed")))).drop("_json")


def validate(df: DataFrame, text: str, schema: Mapping, level: str = "STRICT") -> tuple[DataFrame, DataFrame]:
    """(accepted, refused with ``violations``); level OFF accepts everything."""
    judged = judge(df, text, schema)
    if level.upper() == "OFF":
        return df, judged.filter(F.lit(False))
    if level.upper() != "STRICT":
        raise ValueError(f"unknown validation level {level!r}")
    broken = F.size("violations") > 0
    return judged.filter(~broken).drop("violations"), judged.filter(broken)
