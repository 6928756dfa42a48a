"""Document statements over a collection with one nested document per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import documents as D
from daybook.suite.registry import query


def flat(coll, *more):
    """The whole document as columns, arrays as joined text."""
    return coll.select(
        "_id",
        D.at("name").alias("name"),
        D.at("status").alias("status"),
        D.at("rank").alias("rank"),
        D.at("address.zip").alias("zip"),
        D.at("address.city").alias("city"),
        F.concat_ws(",", D.at("tags")).alias("tags"),
        *more,
    )


FLAT = "_id, name, status, rank, zip, city, array_to_string(tags, ',') as tags"


def changed(**columns: str) -> str:
    """Select list of the flat document with some columns replaced."""
    parts = {
        "_id": "_id", "name": "name", "status": "status", "rank": "rank", "zip": "zip", "city": "city",
        "tags": "array_to_string(tags, ',')",
    }
    parts.update(columns)
    return ", ".join(f"{e} as {c}" for c, e in parts.items())


@query("doc_find", f"select {FLAT} from orders_docs where city is not null and rank > 100 and tags[2] = '5'")
def doc_find(t):
    found = D.find(t.orders_docs, D.at("address.city").isNotNull() & (D.at("rank") > 100) & (D.at("tags[1]") == "5"))
    return flat(found)


@query(
    "doc_find_variant",
    """
select event_id, cast(props->>'$.k' as bigint) as k from events where cast(props->>'$.k' as bigint) between 20 and 60""",
)
def doc_find_variant(t):
    k = F.try_variant_get(F.parse_json("props"), "$.k", "bigint")
    return t.given("events").select("event_id", k.alias("k")).filter(F.col("k").between(20, 60))


@query("doc_fields", "select _id, name as party, zip as zip_code, tags[3] as label, upper(status) as state from orders_docs")
def doc_fields(t):
    return D.fields(
        t.orders_docs,
        {
            "_id": F.col("_id"),
            "party": "name",
            "zip_code": "address.zip",
            "label": "tags[2]",
            "state": F.upper(D.at("status")),
        },
    )


@query(
    "doc_fields_object",
    """select concat('{"id":"', _id, '","party":"', upper(name), '","rank":', rank, ',"zip":"', zip, '"}') as doc
from orders_docs""",
)
def doc_fields_object(t):
    return D.fields_object(
        t.orders_docs,
        {"id": F.col("_id"), "party": F.upper(D.at("name")), "rank": "rank", "zip": "address.zip"},
    )


@query(
    "doc_group_having",
    """
select status, tags[2] as priority, count(*) as n, max(rank) as top_rank from orders_docs
group by 1, 2 having max(rank) > 10""",
)
def doc_group_having(t):
    return D.group_having(
        t.orders_docs,
        {"status": "status", "priority": "tags[1]"},
        {"n": "count(*)", "top_rank": "max(doc.rank)"},
        having="top_rank > 10",
    )


@query("doc_sort_page", f"select {FLAT} from orders_docs order by rank desc, _id limit 30 offset 15")
def doc_sort_page(t):
    return flat(D.sort_page(t.orders_docs, ["doc.rank DESC"], limit=30, offset=15))


@query("doc_get_one", f"select {FLAT} from orders_docs where _id = '77'")
def doc_get_one(t):
    return flat(D.get_one(t.orders_docs, "77"))


@query("doc_count", "select count(*) as n from orders_docs")
def doc_count(t):
    return D.count(t.orders_docs)


def _renumbered(coll, prefix: str):
    return coll.withColumn("_id", F.concat(F.lit(prefix), "_id"))


@query(
    "doc_add",
    f"""
select {FLAT} from orders_docs
union all select {changed(_id="concat('n', _id)")} from orders_docs where status = 'F'""",
)
def doc_add(t):
    new = _renumbered(t.orders_docs.filter("doc.status = 'F'"), "n")
    return flat(D.add(t.orders_docs, new))


def _changes(t):
    """New versions of the finished orders, and as many documents not seen before."""
    done = D.set_path(t.orders_docs.filter("doc.status = 'F'"), "name", F.concat(D.at("name"), F.lit(" (new)")))
    return done.unionByName(_renumbered(done, "n"))


_NEW_NAME = "concat(name, ' (new)')"


@query(
    "doc_upsert",
    f"""
select {FLAT} from orders_docs where status <> 'F'
union all select {changed(name=_NEW_NAME)} from orders_docs where status = 'F'
union all select {changed(_id="concat('n', _id)", name=_NEW_NAME)} from orders_docs where status = 'F'""",
)
def doc_upsert(t):
    older = t.orders_docs.filter("doc.status = 'F'").withColumn("version", F.lit(1))
    newer = _changes(t).withColumn("version", F.lit(2))
    return flat(D.add_or_replace(t.orders_docs, D.latest(older.unionByName(newer), "version")))


@query(
    "doc_upsert_one",
    f"""
select {changed(status="'X'")} from orders_docs where _id = '42'
union all select {FLAT} from orders_docs where _id <> '42'""",
)
def doc_upsert_one(t):
    one = D.set_path(D.get_one(t.orders_docs, "42"), "status", "X")
    return flat(D.add_or_replace_one(t.orders_docs, "42", one))


@query(
    "doc_replace",
    f"""
select {FLAT} from orders_docs where status <> 'F'
union all select {changed(name=_NEW_NAME)} from orders_docs where status = 'F'""",
)
def doc_replace(t):
    return flat(D.replace(t.orders_docs, _changes(t)))


@query(
    "doc_remove",
    f"""
select {FLAT} from orders_docs where not (city is null or rank > 1000) and _id <> '3'""",
)
def doc_remove(t):
    kept = D.remove(t.orders_docs, "doc.address.city is null or doc.rank > 1000")
    return flat(D.remove_one(kept, "3"))


@query(
    "doc_remove_topn",
    f"""
select {FLAT} from orders_docs
where _id not in (select _id from orders_docs where status = 'O' order by rank desc, _id limit 50)""",
)
def doc_remove_topn(t):
    return flat(D.remove_first(t.orders_docs, ["doc.rank DESC"], 50, "doc.status = 'O'"))


@query(
    "doc_set",
    f"""
select {changed(zip="case when rank > 500 then concat('Y', rank) else zip end")},
       case when status = 'F' then rank + 1 end as grade from orders_docs""",
)
def doc_set(t):
    coll = D.set_path(t.orders_docs, "address.zip", F.concat(F.lit("Y"), D.at("rank")), "doc.rank > 500")
    coll = D.set_path(coll, "grade", D.at("rank") + 1, "doc.status = 'F'")
    coll = D.set_path(coll, "nowhere.grade", 1)
    return flat(coll, D.at("grade").alias("grade"))


@query(
    "doc_change",
    f"select {changed(city='case when city is not null and rank < 800 then upper(city) else city end')} from orders_docs",
)
def doc_change(t):
    coll = D.change_path(t.orders_docs, "address.city", F.upper(D.at("address.city")), "doc.rank < 800")
    return flat(D.change_path(coll, "absent", 1))


@query(
    "doc_unset",
    "select _id, case when status = 'F' then null else city end as city, zip, rank from orders_docs",
)
def doc_unset(t):
    coll = D.unset(t.orders_docs, "address.city", condition="doc.status = 'F'")
    coll = D.unset(coll, "tags", "name")
    if set(coll.schema["doc"].dataType.fieldNames()) & {"tags", "name"}:
        raise AssertionError("unset members are still in the document")
    return coll.select(
        "_id", D.at("address.city").alias("city"), D.at("address.zip").alias("zip"), D.at("rank").alias("rank")
    )


_PATCH_SQL = '{"status":"S","address":{"city":null,"street":"7 Quay Lane"},"extra":{"a":1,"b":null}}'


@query(
    "doc_patch",
    f"""
select _id, j->>'$.name' as name, j->>'$.status' as status, j->>'$.address.zip' as zip, j->>'$.address.city' as city,
       j->>'$.address.street' as street, cast(j->>'$.extra.a' as integer) as a, j->>'$.extra.b' as b
from (select _id, case when rank > 300 then json_merge_patch(base, '{_PATCH_SQL}') else base end as j
      from (select _id, rank, json_object('name', name, 'status', status,
                                          'address', json_object('zip', zip, 'city', city)) as base
            from orders_docs))""",
)
def doc_patch(t):
    change = {
        "status": "S",
        "address": {"city": None, "street": "7 Quay Lane"},
        "extra": {"a": 1, "b": None},
    }
    coll = D.patch(t.orders_docs, change, "doc.rank > 300")
    wanted = {
        "_id": F.col("_id"), "name": "name", "status": "status", "zip": "address.zip", "city": "address.city",
        "street": "address.street", "a": "extra.a",
    }
    return D.fields(coll, {**wanted, "b": F.lit(None).cast("string")})


@query(
    "doc_patch_expr",
    f"""
select _id, concat(name, ' lives at ', zip) as name, upper(city) as city, rank - 300 as rank,
       'Finnish,Basque' as translations from orders_docs""",
)
def doc_patch_expr(t):
    coll = D.patch(
        t.orders_docs,
        {
            "name": F.concat(D.at("name"), F.lit(" lives at "), D.at("address.zip")),
            "address": {"city": F.upper(D.at("address.city"))},
            "rank": D.at("rank") - 300,
            "tags": None,
            "translations": ["Finnish", "Basque"],
        },
    )
    return D.fields(
        coll,
        {
            "_id": F.col("_id"),
            "name": "name",
            "city": "address.city",
            "rank": "rank",
            "translations": F.concat_ws(",", D.at("translations")),
        },
    )


@query(
    "doc_array_insert",
    f"""
select {changed(tags="concat_ws(',', tags[1], name, tags[2], tags[3], zip)")} from orders_docs""",
)
def doc_array_insert(t):
    coll = D.array_insert(t.orders_docs, "tags[1]", D.at("name"))
    return flat(D.array_insert(coll, "tags[9]", D.at("address.zip")))


@query(
    "doc_array_append",
    f"""
select {changed(tags="array_to_string(case when rank > 700 then list_append(tags, 'top') else tags end, ',')")}
from orders_docs""",
)
def doc_array_append(t):
    return flat(D.array_append(t.orders_docs, "tags", "top", "doc.rank > 700"))


@query(
    "doc_modify_topn",
    f"""
select {changed(status="case when _id in (select _id from orders_docs where city is not null order by rank, _id limit 40) then 'first' else status end")}
from orders_docs""",
)
def doc_modify_topn(t):
    coll = D.modify_first(
        t.orders_docs,
        lambda coll, hit: D.set_path(coll, "status", "first", hit),
        ["doc.rank"],
        40,
        "doc.address.city is not null",
    )
    return flat(coll)


_TEXT_SQL = """case when value > 60 then left(props, length(props) - 1)
                  when value > 40 then replace(props, '"k"', '"q"')
                  when value > 20 then '{"k": "abc"}' when value > 15 then '{"k": 1.5}' else props end"""


@query(
    "doc_validate",
    f"""
select event_id, coalesce(case when not json_valid(txt) then 'malformed' end,
       case json_type(case when json_valid(txt) then txt end, '$.k') when 'UBIGINT' then ''
            when 'BIGINT' then '' when 'VARCHAR' then 'type:k' when 'DOUBLE' then 'type:k' else 'missing:k' end,
       'missing:k') as violations
from (select event_id, {_TEXT_SQL} as txt from events)""",
)
def doc_validate(t):
    texts = t.given("events").select("event_id", F.expr(_TEXT_SQL).alias("txt"))
    judged = D.judge(texts, "txt", {"k": "integer"}, required=["k"])
    return judged.select("event_id", F.concat_ws(",", "violations").alias("violations"))


@query(
    "doc_as_table",
    """
select _id, concat('{"name":"', name, '","status":"', status, '","rank":', rank, ',"address":{"zip":"', zip, '"',
       case when city is null then '' else concat(',"city":"', city, '"') end, '},"tags":["',
       array_to_string(tags, '","'), '"]}') as doc
from orders_docs""",
)
def doc_as_table(t):
    return D.as_table(t.orders_docs)


_PARTS = "array_to_string(list_transform(lines, lambda l: l.part), ',') as parts"


def _lines(coll):
    doc = F.col("doc")
    return coll.select(
        "_id",
        F.concat_ws(",", F.transform(doc["lines"]["part"], lambda x: x.cast("string"))).alias("parts"),
        F.concat_ws(",", doc["lines"]["flag"]).alias("flags"),
        F.concat_ws(",", doc["tags"]).alias("tags"),
    )


@query(
    "doc_set_element",
    f"""
select _id, {_PARTS},
       array_to_string(list_transform(lines, lambda l, i: case when i = 1 and status = 'F' then 'X' else l.flag end), ',') as flags,
       array_to_string(list_append(tags, 'new'), ',') as tags from order_lines""",
)
def doc_set_element(t):
    coll = D.set_path(t.order_lines, "lines[0].flag", "X", "doc.status = 'F'")
    return _lines(D.set_path(coll, "tags[9]", "new"))


@query(
    "doc_change_element",
    """
select _id, array_to_string(list_transform(lines, lambda l, i: case when i = 2 then l.part + 1 else l.part end), ',') as parts,
       array_to_string(list_transform(lines, lambda l: l.flag), ',') as flags,
       concat_ws(',', case when status = 'O' then 'open' else status end, tags[2]) as tags from order_lines""",
)
def doc_change_element(t):
    coll = D.change_path(t.order_lines, "lines[1].part", D.at("lines[1].part") + 1)
    coll = D.change_path(coll, "tags[7]", "nowhere")
    return _lines(D.change_path(coll, "tags[0]", "open", "doc.status = 'O'"))


@query(
    "doc_unset_element",
    """
select _id, array_to_string(list_transform(lines[2:], lambda l: l.part), ',') as parts,
       array_to_string(list_transform(lines[2:], lambda l: l.flag), ',') as flags,
       case when status = 'F' then status else array_to_string(tags, ',') end as tags from order_lines""",
)
def doc_unset_element(t):
    coll = D.unset(t.order_lines, "lines[0]")
    return _lines(D.unset(coll, "tags[1]", condition="doc.status = 'F'"))


@query(
    "doc_validate_nested",
    f"""
select event_id, case when k is null then 'missing:user.k' when k > 60 then 'type:user.k' else '' end as violations
from (select event_id, cast(props->>'$.k' as bigint) as k from events)""",
)
def doc_validate_nested(t):
    k = F.get_json_object("props", "$.k")
    # integers beyond 64 bits and without a fraction pass, text does not
    spelled = F.when(k.cast("bigint") > 60, F.concat(F.lit('"'), k, F.lit('"'))).when(k.cast("bigint") > 30, F.concat(k, F.lit(".0"))).otherwise(
        F.concat(F.lit("9"), k, F.lit("0000000000000000000000"))
    )
    texts = t.given("events").select(
        "event_id", F.concat(F.lit('{"user":{'), F.coalesce(F.concat(F.lit('"k":'), spelled), F.lit("")), F.lit("}}")).alias("txt")
    )
    judged = D.judge(texts, "txt", {"user.k": "integer"}, required=["user.k"])
    return judged.select("event_id", F.concat_ws(",", "violations").alias("violations"))


@query("doc_deep_page", f"select {FLAT} from orders_docs order by rank desc, _id limit 5500 offset 8000")
def doc_deep_page(t):
    return flat(D.sort_page(t.orders_docs, ["doc.rank DESC"], limit=5500, offset=8000))


@query(
    "doc_modify_many",
    f"""
select {changed(status="case when _id in (select _id from orders_docs where city is not null order by rank, _id limit 11000) then 'first' else status end")}
from orders_docs""",
)
def doc_modify_many(t):
    coll = D.modify_first(
        t.orders_docs, lambda coll, hit: D.set_path(coll, "status", "first", hit), ["doc.rank"], 11000, "doc.address.city is not null"
    )
    return flat(coll)


@query(
    "doc_remove_many",
    f"select {FLAT} from orders_docs where _id not in (select _id from orders_docs order by rank, _id limit 11000)",
)
def doc_remove_many(t):
    return flat(D.remove_first(t.orders_docs, ["doc.rank"], 11000))
