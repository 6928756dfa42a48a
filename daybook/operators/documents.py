"""Document collections: a DataFrame of ``_id`` (text) and ``doc`` (struct).

Paths are relative to the document (``address.zip``, ``tags[0]``).  A NULL field
stands for a missing member; fields of one name have one type in all documents.
Changes are struct expressions built when the plan is made, so they run row by
row inside the scan stage and never shuffle; only statements that match ids
(upsert, replace, the first n by an order) join.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.labels import failed
from daybook.operators import tables
from daybook.operators.tables import Expr
from daybook.sources.batches import BUCKETS, Bucketed

ID, DOC = "_id", "doc"

#: One member step with array positions behind it.
_STEP = re.compile(r"^([^\[\]]+)((?:\[\d+\])*)$")


def at(path: str, root: Column | None = None) -> Column:
    """The value at a path; NULL when any step of it is missing."""
    value = F.col(DOC) if root is None else root
    for step in path.split("."):
        found = _STEP.match(step)
        if not found:
            raise ValueError(f"invalid document path {path!r}")
        value = value.getField(found.group(1))
        for index in re.findall(r"\d+", found.group(2)):
            value = F.get(value, F.lit(int(index)))
    return value


def steps(path: str) -> list[str | int]:
    """``lines[0].n`` as ``["lines", 0, "n"]``; anything that is no member or position is an error."""
    out: list[str | int] = []
    for step in path.split("."):
        found = _STEP.match(step)
        if not found or "*" in step:
            raise ValueError(f"invalid document path {path!r}")
        out.append(found.group(1))
        out += [int(i) for i in re.findall(r"\d+", found.group(2))]
    return out


def type_at(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at a path of the document schema, None where there is no such member or array."""
    return _type_below(schema, steps(path))


def _type_below(dtype: T.DataType | None, path: Sequence[str | int]) -> T.DataType | None:
    for step in path:
        if isinstance(step, int):
            dtype = dtype.elementType if isinstance(dtype, T.ArrayType) else None
        else:
            dtype = dtype[step].dataType if isinstance(dtype, T.StructType) and step in dtype.fieldNames() else None
    return dtype


def _doc_type(coll: DataFrame) -> T.StructType:
    return coll.schema[DOC].dataType


def _value(value: object) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (list, tuple)):
        return F.array(*[_value(v) for v in value])
    if isinstance(value, Mapping):
        return F.struct(*[_value(v).alias(k) for k, v in value.items()])
    return F.lit(value)


# -- reading -----------------------------------------------------------------


def find(coll: DataFrame, condition: Expr) -> DataFrame:
    return tables.where(coll, condition)


def fields(coll: DataFrame, wanted: Mapping[str, str | Column]) -> DataFrame:
    """Project alias -> path or expression."""
    return coll.select(*[(at(p) if isinstance(p, str) else p).alias(alias) for alias, p in wanted.items()])


def fields_object(coll: DataFrame, wanted: Mapping[str, str | Column], out: str = DOC) -> DataFrame:
    """Project one JSON object per document."""
    members = [(at(p) if isinstance(p, str) else p).alias(name) for name, p in wanted.items()]
    return coll.select(F.to_json(F.struct(*members)).alias(out))


def group_having(
    coll: DataFrame, keys: Mapping[str, str], measures: Mapping[str, Expr], having: Expr | None = None
) -> DataFrame:
    grouped = coll.groupBy(*[at(p).alias(k) for k, p in keys.items()]).agg(
        *[tables.expression(e).alias(name) for name, e in measures.items()]
    )
    return grouped if having is None else grouped.filter(tables.expression(having))


def sort_page(coll: DataFrame, by: Sequence[Expr], limit: int, offset: int = 0) -> DataFrame:
    return tables.page(coll, [*by, ID], limit, offset)


def get_one(coll: DataFrame, doc_id: str) -> DataFrame:
    return coll.filter(F.col(ID) == doc_id)


def count(coll: DataFrame) -> DataFrame:
    return tables.count(coll)


def as_table(coll: DataFrame) -> DataFrame:
    """The collection as rows of JSON text and id."""
    return coll.select(F.to_json(DOC).alias(DOC), ID)


# -- adding and replacing ----------------------------------------------------


def duplicate_ids(coll: DataFrame, new: DataFrame) -> DataFrame:
    """Ids that adding ``new`` would hold twice."""
    twice = new.groupBy(ID).agg(F.count("*").alias("_n")).filter("_n > 1").select(ID)
    return twice.union(new.join(coll.select(ID), ID, "left_semi").select(ID)).distinct()


def _refused(rows: DataFrame, clash: Column, message: str) -> DataFrame:
    """``rows`` where no clash is found; the first clash fails the query when it runs."""
    stop = F.raise_error(F.concat(F.lit(f"{message}: "), F.col(ID))).cast("boolean")
    return rows.filter(F.when(clash, stop).otherwise(F.lit(True)))


def once(changes: DataFrame, message: str = "changes hold a document twice") -> DataFrame:
    """``changes``, refused when the query runs if an id comes more than once (NULL ids do not collide)."""
    counted = changes.groupBy(ID).agg(F.count("*").alias("_n"), F.first(DOC).alias(DOC))
    whole = counted.filter(F.col(ID).isNotNull()).unionByName(
        changes.filter(F.col(ID).isNull()).select(ID, F.lit(1).cast("bigint").alias("_n"), DOC)
    )
    return _refused(whole, F.col("_n") > 1, message).select(ID, DOC)


def add(coll: DataFrame, new: DataFrame) -> DataFrame:
    """Append documents; an id that is there already, or comes twice, fails the query when it runs."""
    there = coll.select(ID).distinct().withColumn("_there", F.lit(True))
    message = f"document contains a duplicate {ID}"
    checked = once(new.select(ID, DOC), message).join(there, ID, "left")
    return coll.unionByName(_refused(checked, F.col("_there").isNotNull(), message).select(coll.columns))


def latest(changes: DataFrame, sequence: str) -> DataFrame:
    """One document per id: the last by ``sequence``, of several the one whose text sorts last."""
    return changes.groupBy(ID).agg(F.max_by(DOC, F.struct(F.col(sequence), F.to_json(DOC))).alias(DOC))


def add_or_replace(coll: DataFrame, changes: DataFrame) -> DataFrame:
    """Upsert; ``changes`` holds one document per id (see ``latest``), or the query fails."""
    changes = once(changes.select(ID, DOC))
    kept = coll.join(changes.select(ID), ID, "left_anti")
    return kept.unionByName(changes.select(coll.columns)).select(coll.columns)


def add_or_replace_one(coll: DataFrame, doc_id: str, one: DataFrame) -> DataFrame:
    """Upsert a single document; its own id, if it has one, must be ``doc_id``."""
    new_id = F.lit(doc_id)
    if ID in one.columns:
        same = F.coalesce(F.col(ID) == doc_id, F.lit(True))
        new_id = F.when(same, new_id).otherwise(F.raise_error(F.lit("document id does not match")))
    return add_or_replace(coll, one.select(new_id.alias(ID), DOC))


def replace(coll: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace documents that are there; ids that are not are left alone, repeated ones fail the query."""
    new = once(changes.select(ID, DOC)).select(ID, F.col(DOC).alias("_new"))
    joined = coll.join(new, ID, "left")
    return joined.select(ID, F.coalesce("_new", DOC).alias(DOC))


def replace_one(coll: DataFrame, doc_id: str, one: DataFrame) -> DataFrame:
    """As ``replace`` for one id; the new document's own id does not matter."""
    return replace(coll, one.select(F.lit(doc_id).alias(ID), DOC))


def remove(coll: DataFrame, condition: Expr) -> DataFrame:
    return tables.delete(coll, condition)


def remove_first(coll: DataFrame, by: Sequence[Expr], n: int, condition: Expr | None = None) -> DataFrame:
    return tables.delete_topn(coll, ID, by, n, condition)


def remove_one(coll: DataFrame, doc_id: str) -> DataFrame:
    return coll.filter(~F.equal_null(F.col(ID), F.lit(doc_id)))


# -- modifying ---------------------------------------------------------------


def _put(value: Column, dtype: T.DataType, path: Sequence[str | int], new, append: bool) -> Column:
    """``value`` with ``new(old)`` at the path below it; arrays are rebuilt around the position.

    A missing parent stays missing.  ``append``: the position just behind an array's end, or any
    further one, adds an element.
    """
    step, rest = path[0], path[1:]
    if isinstance(step, str):
        old = value.getField(step) if step in dtype.fieldNames() else None
        inner = new(old) if not rest else _put(old, dtype[step].dataType, rest, new, append)
        # a missing object does not come into being because a member below it is set
        return F.when(value.isNotNull(), value.withField(step, inner))
    element = dtype.elementType
    change = (lambda x: new(x).cast(element)) if not rest else (lambda x: _put(x, element, rest, new, append))
    changed = F.transform(value, lambda x, i: F.when(i == step, change(x)).otherwise(x))
    if append and not rest:
        added = F.array_append(value, new(F.lit(None).cast(element)).cast(element))
        return F.when(F.size(value) > step, changed).when(value.isNotNull(), added)
    return changed


def _write(coll: DataFrame, path: str, value: Column, condition: Expr | None, append: bool = False) -> DataFrame:
    """Put a value at a path; rows not chosen keep theirs."""
    if path == ID or path.startswith((ID + ".", ID + "[")):
        raise ValueError(f"{ID} cannot be changed")
    old_type = type_at(_doc_type(coll), path)
    hit = None if condition is None else F.coalesce(tables.expression(condition), F.lit(False))
    # the value and the condition see the document as it was, outside of any array's lambda
    held = coll.withColumn("_value", value if old_type is None or hit is None else value.cast(old_type))
    if hit is not None:
        held = held.withColumn("_chosen", hit)

    def new(old: Column | None) -> Column:
        if hit is None:
            return F.col("_value")
        kept = F.lit(None).cast(held.schema["_value"].dataType) if old is None else old
        return F.when(F.col("_chosen"), F.col("_value")).otherwise(kept)

    where = steps(path)
    if not any(isinstance(step, int) for step in where):
        out = F.col(DOC).withField(path, new(None if old_type is None else at(path)))
    else:
        out = _put(F.col(DOC), _doc_type(coll), where, new, append)
        if hit is not None:  # an element must not be appended to a row left alone
            out = F.when(F.col("_chosen"), out).otherwise(F.col(DOC))
    return held.withColumn(DOC, out).select(coll.columns)


def _has_parent(coll: DataFrame, path: str) -> bool:
    *parent, last = steps(path)
    dtype = _type_below(_doc_type(coll), parent)
    return isinstance(dtype, T.ArrayType if isinstance(last, int) else T.StructType)


def set_path(coll: DataFrame, path: str, value: object, condition: Expr | None = None) -> DataFrame:
    """Set a member or array element, creating it if missing; nothing happens below a missing parent.

    An element behind the array's end is appended.
    """
    if not _has_parent(coll, path):
        return coll
    return _write(coll, path, _value(value), condition, append=True)


def change_path(coll: DataFrame, path: str, value: object, condition: Expr | None = None) -> DataFrame:
    """Set a member or array element only in the documents that have it."""
    if type_at(_doc_type(coll), path) is None:
        return coll
    present = at(path).isNotNull()
    hit = present if condition is None else present & tables.expression(condition)
    return _write(coll, path, _value(value), hit)


def _without_element(coll: DataFrame, path: str, hit: Column | None) -> DataFrame:
    """The array at the path before its last position, without that element; later ones move up."""
    array, _, index = path.rpartition("[")
    position = int(index[:-1])
    left = F.filter(at(array), lambda _, i: i != position)
    return _write(coll, array, left, hit)


def unset(coll: DataFrame, *paths: str, condition: Expr | None = None) -> DataFrame:
    """Remove members and array elements; elements behind a removed one move up.

    Members go from all documents; with a condition, or inside an array, they become missing where it
    holds.  Paths that lead nowhere are left alone.
    """
    if ID in paths:
        raise ValueError(f"{ID} cannot be changed")
    present = [p for p in paths if type_at(_doc_type(coll), p) is not None]
    plain = [p for p in present if not any(isinstance(step, int) for step in steps(p))]
    if condition is None and len(plain) == len(present):
        return coll.withColumn(DOC, F.col(DOC).dropFields(*plain)) if plain else coll
    # the condition is judged on the document as it was
    chosen = F.lit(True) if condition is None else tables.expression(condition)
    flagged = coll.withColumn("_hit", F.coalesce(chosen, F.lit(False)))
    for path in present:
        if isinstance(steps(path)[-1], int):
            flagged = _without_element(flagged, path, F.col("_hit"))
        elif condition is not None or path not in plain:
            flagged = _write(flagged, path, F.lit(None), F.col("_hit"))
        else:
            flagged = flagged.withColumn(DOC, F.col(DOC).dropFields(path))
    return flagged.drop("_hit")


def _merged(current: Column | None, dtype: T.DataType | None, patch: Mapping) -> Column:
    """Struct expression of a document after a merge patch.

    Objects merge member by member, None removes, everything else replaces.
    """
    known = dtype.fieldNames() if isinstance(dtype, T.StructType) else []
    members = []
    for name in [*known, *[n for n in patch if n not in known]]:
        old = current.getField(name) if name in known else None
        old_type = dtype[name].dataType if name in known else None
        if name not in patch:
            members.append(old.alias(name))
            continue
        change = patch[name]
        if change is None:
            if old_type is not None:
                members.append(F.lit(None).cast(old_type).alias(name))
        elif isinstance(change, Mapping):
            members.append(_merged(old, old_type, change).alias(name))
        else:
            members.append(_value(change).alias(name))
    return F.struct(*members)


def patch(coll: DataFrame, change: Mapping, condition: Expr | None = None) -> DataFrame:
    """JSON merge patch; values may be Columns over the document (see ``at``).

    A member that changes its type can only be patched in all documents at once.
    """
    if ID in change:
        raise ValueError(f"{ID} cannot be changed")
    merged = _merged(F.col(DOC), _doc_type(coll), change)
    if condition is None:
        return coll.withColumn(DOC, merged)
    # rows left alone take the shape of the patched ones: an empty patch of the
    # new members only
    out = coll.withColumn("_new", merged)
    target = out.schema["_new"].dataType
    kept = F.col(DOC) if target == _doc_type(coll) else _fit(F.col(DOC), _doc_type(coll), target)
    hit = F.coalesce(tables.expression(condition), F.lit(False))
    return out.withColumn(DOC, F.when(hit, F.col("_new")).otherwise(kept)).drop("_new")


def _fit(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Old value in the wider shape; members it never had are NULL."""
    if not (isinstance(have, T.StructType) and isinstance(want, T.StructType)):
        return value.cast(want)
    members = []
    for f in want:
        if f.name in have.fieldNames():
            member = _fit(value.getField(f.name), have[f.name].dataType, f.dataType)
        else:
            member = F.lit(None).cast(f.dataType)
        members.append(member.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*members))


def _array_path(path: str) -> tuple[str, int | None]:
    found = re.match(r"^(.*)\[(\d+)\]$", path)
    return (found.group(1), int(found.group(2))) if found else (path, None)


def array_append(coll: DataFrame, path: str, value: object, condition: Expr | None = None) -> DataFrame:
    if not isinstance(type_at(_doc_type(coll), path), T.ArrayType):
        return coll
    return _write(coll, path, F.array_append(at(path), _value(value)), condition)


def array_insert(coll: DataFrame, path: str, value: object, condition: Expr | None = None) -> DataFrame:
    """Insert before ``path[n]``; past the end the value goes last."""
    member, index = _array_path(path)
    if index is None:
        raise ValueError(f"array_insert needs an array position, got {path!r}")
    if not isinstance(type_at(_doc_type(coll), member), T.ArrayType):
        return coll
    new = _value(value)
    inserted = F.when(F.size(at(member)) >= index, F.array_insert(at(member), index + 1, new)).otherwise(
        F.array_append(at(member), new)
    )
    return _write(coll, member, inserted, condition)


def modify_first(
    coll: DataFrame, change, by: Sequence[Expr], n: int, condition: Expr | None = None
) -> DataFrame:
    """Apply ``change(coll, condition)`` to the first n matching documents."""
    flagged = tables.flag_first(coll, ID, by, n, condition)
    return change(flagged, F.coalesce(F.col(tables._PICKED), F.lit(False))).select(coll.columns)


# -- validation --------------------------------------------------------------

# JSON types and what Spark calls them inside a VARIANT.
_JSON_TYPES = {
    "integer": "^BIGINT",
    "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)",
    "string": "^STRING",
    "boolean": "^BOOLEAN",
    "array": "^ARRAY",
    "object": "^OBJECT",
}


def judge(df: DataFrame, text: str, types: Mapping[str, str], required: Sequence[str] = ()) -> DataFrame:
    """Add ``violations``: malformed text, missing or mistyped members of each document.

    Members may be paths (``user.id``).  An integer is any number without a fraction, of any size.
    """
    parsed = F.col("_json")
    tests = {"malformed": parsed.isNull()}
    for name in dict.fromkeys([*required, *types]):
        member = F.try_variant_get(parsed, f"$.{name}", "variant")
        kind = F.schema_of_variant(member)
        if name in required:
            tests[f"missing:{name}"] = parsed.isNotNull() & kind.isNull()
        if name in types:
            fits = kind.rlike(_JSON_TYPES[types[name]])
            if types[name] == "integer":
                spelled = F.get_json_object(F.col(text), f"$.{name}")
                fits = fits | (kind.rlike(_JSON_TYPES["number"]) & spelled.rlike(r"^-?[0-9]+([.]0*)?([eE][+]?[0-9]+)?\z"))
            tests[f"type:{name}"] = ~fits
    return df.withColumn("_json", F.try_parse_json(text)).withColumn("violations", failed(tests)).drop("_json")


def validate(
    df: DataFrame, text: str, types: Mapping[str, str], required: Sequence[str] = (), level: str = "STRICT"
) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused with ``violations``); level OFF accepts everything."""
    judged = judge(df, text, types, required)
    if level.upper() == "OFF":
        return df, judged.filter(F.lit(False))
    if level.upper() != "STRICT":
        raise ValueError(f"unknown validation level {level!r}")
    broken = F.size("violations") > 0
    return judged.filter(~broken).drop("violations"), judged.filter(broken)


# -- stored collections -------------------------------------------------------


def stored(path: str, schema: T.StructType, buckets: int = BUCKETS) -> Bucketed:
    """A collection stored in buckets of its ids."""
    return Bucketed(path, T.StructType([schema[ID], schema[DOC]]), ID, buckets=buckets)


def keep(coll: DataFrame, path: str, batch: str = "all", buckets: int = BUCKETS) -> None:
    """Store a collection, or one batch of it, by id; a repeated batch replaces its own documents."""
    stored(path, coll.schema, buckets).put(coll, batch)


def get_stored(spark: SparkSession, path: str, schema: T.StructType, doc_id: str, buckets: int = BUCKETS) -> DataFrame:
    """``get_one`` of a stored collection: reads the one bucket that can hold the id."""
    return get_one(stored(path, schema, buckets).read(spark), doc_id).select(ID, DOC)
