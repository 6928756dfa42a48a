"""Document statements over a collection without a fixed shape: ``_id`` (text) and ``doc`` (VARIANT).

A member may be missing, JSON null or of another type in every document.  Changes open the object or array on
the way to the path as a map or list of VARIANTs, put the new value in and close it again, so they are
expressions of the scan stage as those of ``daybook.operators.documents`` are.  Paths are ``a.b[0].c``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.exprs import json_literal, kind_of, let, variant_step
from daybook.operators import tables
from daybook.operators.documents import DOC, ID, steps
from daybook.operators.tables import Expr
from daybook.sources.scratch import scratch_dir

MEMBERS, ELEMENTS = "map<string,variant>", "array<variant>"


def from_json(df: DataFrame, text: str, doc_id: str = ID) -> DataFrame:
    """A collection of the JSON texts of a column; texts that are not JSON are NULL documents."""
    return df.select(F.col(doc_id).cast("string").alias(ID), F.try_parse_json(text).alias(DOC))


def to_json(coll: DataFrame, out: str = DOC) -> DataFrame:
    """The collection as rows of id and JSON text, members by name."""
    return coll.select(ID, F.to_json(DOC).alias(out))


def _jsonpath(path: str | Sequence[str | int]) -> str:
    found = steps(path) if isinstance(path, str) else path
    return "$" + "".join(map(variant_step, found))


def at(path: str, dtype: str = "variant") -> Column:
    """The value at a path of the document: NULL where it is missing or does not have the type."""
    return F.try_variant_get(F.col(DOC), _jsonpath(path), dtype)


def kind(path: str) -> Column:
    """object, array, string, number, boolean, null - or NULL where the path is missing."""
    return kind_of(at(path))


def value(new: object) -> Column:
    """A VARIANT of a plain Python value (None is JSON null) or of a Column."""
    return new.cast("variant") if isinstance(new, Column) else json_literal(new)


def _members(doc: Column) -> Column:
    """The members of an object, NULL for anything else."""
    return F.when(kind_of(doc) == "object", F.try_variant_get(doc, "$", MEMBERS))


def _elements(doc: Column) -> Column:
    return F.when(kind_of(doc) == "array", F.try_variant_get(doc, "$", ELEMENTS))


def _without(members: Column, name: str) -> Column:
    return F.map_filter(members, lambda k, _: k != F.lit(name))


def _with(members: Column, name: str, new: Column) -> Column:
    return F.to_variant_object(F.map_concat(_without(members, name), F.create_map(F.lit(name), new)))


def _has(members: Column, name: str) -> Column:
    return F.coalesce(F.map_contains_key(members, F.lit(name)), F.lit(False))


def _put(doc: Column, path: Sequence[str | int], new: Column, create: bool) -> Column:
    """``doc`` with ``new`` at a path; unchanged where something on the way is missing or of another kind."""
    step, rest = path[0], path[1:]

    def member(members: Column) -> Column:
        put = _put(F.try_element_at(members, F.lit(step)), rest, new, create) if rest else new
        there = members.isNotNull() if create and not rest else _has(members, step)
        return F.when(there, _with(members, step, put))

    def element(elements: Column) -> Column:
        put = F.transform(elements, lambda x, i: F.when(i == step, _put(x, rest, new, create) if rest else new).otherwise(x))
        out = F.when(F.size(elements) > step, F.to_variant_object(put))
        return out.when(elements.isNotNull(), F.to_variant_object(F.array_append(elements, new))) if create and not rest else out

    if isinstance(step, str):
        return let(doc, lambda d: F.coalesce(let(_members(d), member), d))
    return let(doc, lambda d: F.coalesce(let(_elements(d), element), d))


def _drop(doc: Column, path: Sequence[str | int]) -> Column:
    step, rest = path[0], path[1:]

    def member(members: Column) -> Column:
        if rest:
            left = _with(members, step, _drop(F.try_element_at(members, F.lit(step)), rest))
        else:
            left = F.to_variant_object(_without(members, step))
        return F.when(_has(members, step), left)

    def element(elements: Column) -> Column:
        if rest:
            left = F.transform(elements, lambda x, i: F.when(i == step, _drop(x, rest)).otherwise(x))
        else:
            left = F.filter(elements, lambda _, i: i != step)
        return F.when(F.size(elements) > step, F.to_variant_object(left))

    if isinstance(step, str):
        return let(doc, lambda d: F.coalesce(let(_members(d), member), d))
    return let(doc, lambda d: F.coalesce(let(_elements(d), element), d))


def _changed(coll: DataFrame, new: Column, condition: Expr | None) -> DataFrame:
    if condition is not None:
        new = F.when(F.coalesce(tables.expression(condition), F.lit(False)), new).otherwise(F.col(DOC))
    return coll.withColumn(DOC, new)


def _path(path: str) -> list[str | int]:
    found = steps(path)
    if found[0] == ID:
        raise ValueError(f"{ID} cannot be changed")
    return found


def set_path(coll: DataFrame, path: str, new: object, condition: Expr | None = None) -> DataFrame:
    """Set a member or element, creating it if missing; documents without its parent stay as they are.

    An element behind the array's end is appended.  What was there may be of any type.
    """
    return _changed(coll, _put(F.col(DOC), _path(path), value(new), True), condition)


def change_path(coll: DataFrame, path: str, new: object, condition: Expr | None = None) -> DataFrame:
    """Set a member or element only in the documents that have it; JSON null counts as there."""
    return _changed(coll, _put(F.col(DOC), _path(path), value(new), False), condition)


def unset(coll: DataFrame, *paths: str, condition: Expr | None = None) -> DataFrame:
    """Remove members and array elements, in the documents that have them, one path after the other.

    Elements behind a removed one move up.  The condition is judged on the document as it was.
    """
    doc = F.col(DOC)
    for path in paths:
        doc = _drop(doc, _path(path))
    return _changed(coll, doc, condition)


def _merged(doc: Column, change: Mapping) -> Column:
    """Merge patch: objects member by member, None removes, everything else replaces."""

    def merge(members: Column) -> Column:
        kept = F.map_filter(members, lambda k, _: ~k.isin(*change)) if change else members
        put = []
        for name, new in change.items():
            if new is not None:
                old = F.try_element_at(members, F.lit(name))
                put += [F.lit(name), _merged(old, new) if isinstance(new, Mapping) else value(new)]
        return F.to_variant_object(F.map_concat(kept, F.create_map(*put)) if put else kept)

    return let(doc, lambda d: let(F.coalesce(_members(d), F.create_map().cast(MEMBERS)), merge))


def patch(coll: DataFrame, change: Mapping, condition: Expr | None = None) -> DataFrame:
    """JSON merge patch, in the documents for which the condition holds; members may change their type.

    Values may be Columns over the document (see ``at``).  A patched member that is no object becomes one
    if the patch has an object for it.
    """
    if ID in change:
        raise ValueError(f"{ID} cannot be changed")
    return _changed(coll, _merged(F.col(DOC), change), condition)


def array_append(coll: DataFrame, path: str, new: object, condition: Expr | None = None) -> DataFrame:
    """Add an element at the end of the array at a path; documents without such an array stay as they are."""
    elements = _elements(at(path))
    hit = elements.isNotNull()
    if condition is not None:
        hit = hit & tables.expression(condition)
    return _changed(coll, _put(F.col(DOC), _path(path), F.to_variant_object(F.array_append(elements, value(new))), False), hit)


def array_insert(coll: DataFrame, path: str, new: object, condition: Expr | None = None) -> DataFrame:
    """Insert before the element at a path; past the end the value goes last."""
    *parent, index = _path(path)
    if not isinstance(index, int) or not parent:
        raise ValueError(f"array_insert needs an array position, got {path!r}")
    elements = _elements(F.try_variant_get(F.col(DOC), _jsonpath(parent), "variant"))
    spot = F.least(F.lit(index), F.size(elements))
    put = F.concat(F.slice(elements, F.lit(1), spot), F.array(value(new)), F.slice(elements, spot + 1, F.greatest(F.size(elements) - spot, F.lit(0))))
    hit = elements.isNotNull()
    if condition is not None:
        hit = hit & tables.expression(condition)
    return _changed(coll, _put(F.col(DOC), parent, F.to_variant_object(put), False), hit)


def anywhere(coll: DataFrame, member: str) -> DataFrame:
    """``**.member``: (``_id``, path, value) for each value of a member at any depth of the documents.

    Each round opens one level of all objects and arrays left and keeps only those below, until none is: the
    documents need no schema and may be nested as deep as they like.  Rounds are written to the scratch folder.
    Runs when called.
    """
    spark = coll.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    nested = kind_of(F.col("value")).isin("object", "array")
    frontier = coll.select(ID, F.lit("$").alias("path"), F.col(DOC).alias("value")).filter(nested)
    found = None
    while True:
        opened = frontier.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).select("pos", "key", F.col("value").alias("inner")))
        name = F.when(F.col("key").isNull(), F.concat(F.lit("["), "pos", F.lit("]"))).otherwise(F.concat(F.lit("."), "key"))
        level = written(opened.select(ID, F.concat("path", name).alias("path"), "key", F.col("inner").alias("value")), "anywhere")
        hits = level.filter(F.col("key") == member).select(ID, "path", "value")
        found = hits if found is None else found.unionByName(hits)
        frontier = level.filter(nested).select(ID, "path", "value")
        if frontier.isEmpty():
            return found
