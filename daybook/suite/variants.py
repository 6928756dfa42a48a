"""Statements over documents of mixed shape, made of the events' texts and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators import jsonschema
from daybook.operators import variants as V
from daybook.suite.registry import query

# The same text in both engines: objects, texts, numbers, lists, JSON null or nothing under one name.
_TEXT = """
case when value > 150 then concat('{"user":{"id":', user_id, ',"tags":["', event_type, '","x"]},"note":null,"k":', event_id, '}')
     when value > 100 then concat('{"user":"', event_type, '","k":"', event_id, '"}')
     when value > 50 then concat('{"user":null,"note":"', event_type, '","k":[', event_id, ',{"n":', user_id, '}]}')
     when value > 20 then concat('{"note":{"user":{"id":', event_id, '},"note":{"deep":[{"note":', user_id, '}]}},"user":{"id":"', user_id, '"}}')
     else concat('{"k":', event_id, '.5,"user":{}}') end"""
_DOCS = f"(select cast(event_id as varchar) as _id, cast({_TEXT} as json) as j from events)"


def mixed(t) -> DataFrame:
    return V.from_json(t.given("events").select("event_id", F.expr(_TEXT).alias("txt")), "txt", "event_id")


# Kind and text of a place in both engines; numbers are spelled as they came.
_KIND = """case json_type({0}, '$.{1}') when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'string'
 when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' when 'UBIGINT' then 'number' when 'BIGINT' then 'number' when 'DOUBLE' then 'number' end"""
_PLACES = ("user", "user.id", "user.tags[0]", "user.tags[1]", "note", "note.user.id", "note.note", "k", "k[0]", "k[1].n", "extra", "extra.a")


def _name(path: str) -> str:
    return "p_" + "".join(c if c.isalnum() else "_" for c in path)


def _shown(coll: DataFrame) -> DataFrame:
    """Kind and, for texts and whole numbers, value of every place looked at."""
    out = [F.col("_id")]
    for path in _PLACES:
        kind = V.kind(path)
        text = F.when(kind.isin("string", "number"), V.at(path, "string"))
        out.append(F.concat_ws(":", F.coalesce(kind, F.lit("-")), text).alias(_name(path)))
    return coll.select(*out)


def _places(doc: str, source: str) -> str:
    """The same of JSON ``doc`` in SQL."""
    cells = []
    for path in _PLACES:
        kind = _KIND.format(doc, path)
        text = f"case when json_type({doc}, '$.{path}') in ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') then {doc}->>'$.{path}' end"
        cells.append(f"concat_ws(':', coalesce({kind}, '-'), {text}) as {_name(path)}")
    return f"select _id, {', '.join(cells)} from {source}"


@query("variant_find", _places("j", f"{_DOCS} where json_type(j, '$.note') = 'NULL' or json_type(j, '$.user') = 'VARCHAR'"))
def variant_find(t):
    coll = mixed(t)
    return _shown(coll.filter((V.kind("note") == "null") | (V.kind("user") == "string")))


# A patch that turns texts and nulls into objects, objects into numbers, and removes a member.
_PATCH = '{"user":{"id":1,"tags":null},"note":[1,"a"],"k":null,"extra":{"a":{"b":null,"c":2}}}'


@query(
    "variant_patch",
    _places(
        "m",
        f"""(select _id, case when json_type(j, '$.k') in ('UBIGINT', 'VARCHAR') or json_type(j, '$.note') = 'OBJECT'
                              then json_merge_patch(j, '{_PATCH}') else j end as m from {_DOCS})""",
    ),
)
def variant_patch(t):
    change = {"user": {"id": 1, "tags": None}, "note": [1, "a"], "k": None, "extra": {"a": {"b": None, "c": 2}}}
    whole = (V.kind("k") == "string") | ((V.kind("k") == "number") & ~V.at("k", "string").contains("."))
    return _shown(V.patch(mixed(t), change, whole | (V.kind("note") == "object")))


@query(
    "variant_set",
    _places(
        "m",
        f"""(select _id, case when json_type(j, '$.user') = 'OBJECT' and json_type(j, '$.note') is not null
                              then json_merge_patch(j, json_object('user', json_object('id', json_object('was', json_type(j, '$.user.id') is not null))))
                              when json_type(j, '$.user') = 'OBJECT' then json_merge_patch(j, '{{"user":{{"id":[]}}}}') else j end as m from {_DOCS})""",
    ),
)
def variant_set(t):
    """A member of objects only, made where it is missing, to values of two types."""
    coll = V.set_path(mixed(t), "user.id", [], V.kind("note").isNull())
    return _shown(V.set_path(coll, "user.id", {"was": True}, V.kind("note").isNotNull()))


@query(
    "variant_change",
    _places(
        "m",
        f"""(select _id, case when json_type(j, '$.note') is not null
                              then json_merge_patch(j, json_object('note', concat('was ', json_type(j, '$.note')))) else j end as m from {_DOCS})""",
    ),
)
def variant_change(t):
    """JSON null is there to be changed, a missing member is not."""
    was = F.when(V.kind("note") == "string", "VARCHAR").otherwise(F.upper(V.kind("note")))
    return _shown(V.change_path(mixed(t), "note", F.concat(F.lit("was "), was)))


@query(
    "variant_unset",
    _places("m", f"""(select _id, json_merge_patch(j, '{{"note":{{"note":null}},"k":null}}') as m from {_DOCS} where json_type(j, '$.note') = 'OBJECT')
union all {_places('m', f'''(select _id, json_merge_patch(j, '{{"k":null}}') as m from {_DOCS} where json_type(j, '$.note') is distinct from 'OBJECT')''')}"""),
)
def variant_unset(t):
    return _shown(V.unset(mixed(t), "note.note", "k"))


@query(
    "variant_elements",
    f"""
select _id, case when json_type(j, '$.user.tags') = 'ARRAY' then concat('new|', j->>'$.user.tags[0]', '|', j->>'$.user.tags[1]', '|last') end as tags,
       case when json_type(j, '$.k') = 'ARRAY' then concat('put|', j->>'$.k[1].n') end as k
from {_DOCS}""",
)
def variant_elements(t):
    coll = V.array_append(V.array_insert(mixed(t), "user.tags[0]", "new"), "user.tags", "last")
    coll = V.set_path(coll, "k[0]", "put")
    tags = V.at("user.tags", "array<string>")
    k = F.when(V.kind("k") == "array", F.concat_ws("|", V.at("k[0]", "string"), V.at("k[1].n", "string")))
    return coll.select("_id", F.when(tags.isNotNull(), F.concat_ws("|", tags)).alias("tags"), k.alias("k"))


_NOTES = f"""
select _id, '$.note' as path, json_type(j, '$.note') as kind from {_DOCS} where json_type(j, '$.note') is not null
union all select _id, '$.note.note', 'OBJECT' from {_DOCS} where json_type(j, '$.note.note') = 'OBJECT'
union all select _id, '$.note.note.deep[0].note', 'UBIGINT' from {_DOCS} where json_type(j, '$.note.note') = 'OBJECT'"""


@query("variant_anywhere", f"select _id, path, case kind when 'VARCHAR' then 'string' when 'UBIGINT' then 'number' else lower(kind) end as kind from ({_NOTES})")
def variant_anywhere(t):
    found = V.anywhere(mixed(t), "note")
    return found.select("_id", "path", V.kind_of(F.col("value")).alias("kind"))


_SCHEMA = {
    "type": "object",
    "required": ["k", "user"],
    "additionalProperties": False,
    "properties": {
        "k": {"anyOf": [{"type": "integer", "minimum": 100}, {"type": "array", "minItems": 2, "items": {"type": ["integer", "object"]}}]},
        "user": {
            "type": ["object", "string"],
            "pattern": "^(click|view)$",
            "properties": {"id": {"type": "integer", "maximum": 40}, "tags": {"items": {"enum": ["x", "click", "signup"]}, "uniqueItems": True}},
        },
    },
}


@query(
    "variant_validate",
    f"""
select _id, concat_ws(',',
  case when json_type(j, '$.k') is null then 'required:$.k' end, case when json_type(j, '$.user') is null then 'required:$.user' end,
  case when json_type(j, '$.k') is not null and not (coalesce(json_type(j, '$.k') = 'UBIGINT' and try_cast(j->>'$.k' as double) >= 100, false)
            or json_type(j, '$.k') = 'ARRAY') then 'anyOf:$.k' end,
  case when json_type(j, '$.user') = 'NULL' then 'type:$.user' end,
  case when json_type(j, '$.user') = 'VARCHAR' and j->>'$.user' not in ('click', 'view') then 'pattern:$.user' end,
  case when json_type(j, '$.user.id') = 'VARCHAR' then 'type:$.user.id' end,
  case when json_type(j, '$.user.id') = 'UBIGINT' and try_cast(j->>'$.user.id' as bigint) > 40 then 'maximum:$.user.id' end,
  case when j->>'$.user.tags[0]' not in ('x', 'click', 'signup') then 'enum:$.user.tags[0]' end,
  case when json_type(j, '$.note') is not null then 'additionalProperties:$.note' end) as violations
from {_DOCS}""",
)
def variant_validate(t):
    texts = t.given("events").select(F.col("event_id").cast("string").alias("_id"), F.expr(_TEXT).alias("txt"))
    judged = jsonschema.judge(texts, "txt", _SCHEMA)
    return judged.select("_id", F.concat_ws(",", "violations").alias("violations"))
