"""Expression operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import exprs as X
from daybook.operators import documents as D
from daybook.suite.registry import query

C = F.col


@query(
    "expr_bool",
    """
select txn_id, (type = 'credit' and amount > 100000) or not (mode = 'A') as hit from raw_bank""",
)
def expr_bool(t):
    hit = X.any_of(
        X.all_of(C("type") == "credit", C("amount") > 100000),
        X.negate(C("mode") == "A"),
    )
    return t.raw_bank.select("txn_id", hit.alias("hit"))


@query(
    "expr_compare",
    """
select bill_no, gst >= 5000 as ge, gst > 5000 as gt, gst <= 9000 as le, gst < 9000 as lt, mode = 'A' as eq,
       mode = 'R' as eq2, mode <> 'N' as ne from purchases""",
)
def expr_compare(t):
    tests = {
        "ge": (">=", "gst", 5000), "gt": (">", "gst", 5000), "le": ("<=", "gst", 9000), "lt": ("<", "gst", 9000),
        "eq": ("=", "mode", "A"), "eq2": ("==", "mode", "R"), "ne": ("!=", "mode", "N"),
    }
    return t.purchases.select(
        "bill_no", *[X.compare(op, C(c), v).alias(name) for name, (op, c, v) in tests.items()]
    )


@query(
    "expr_is",
    """
select txn_id, type is null as no_type, type is not null as has_type, (type = 'credit') is true as is_credit,
       (type = 'credit') is false as not_credit, (type = 'credit') is not true as unless_credit from raw_bank""",
)
def expr_is(t):
    credit = C("type") == "credit"
    return t.raw_bank.select(
        "txn_id",
        X.is_(C("type"), None).alias("no_type"),
        X.is_not(C("type"), None).alias("has_type"),
        X.is_(credit, True).alias("is_credit"),
        X.is_(credit, False).alias("not_credit"),
        X.is_not(credit, True).alias("unless_credit"),
    )


@query(
    "expr_in",
    "select txn_id, type in ('credit','debit') as known, type not in ('CREDIT') as not_upper from raw_bank",
)
def expr_in(t):
    return t.raw_bank.select(
        "txn_id",
        X.in_list(C("type"), "credit", "debit").alias("known"),
        X.negate(X.in_list(C("type"), "CREDIT")).alias("not_upper"),
    )


@query(
    "expr_contained_in",
    """
select _id, list_contains(tags, '5') as has_low, list_has_all(['F','O','1','2'], tags[1:2]) as subset from orders_docs""",
)
def expr_contained_in(t):
    tags = D.at("tags")
    return t.orders_docs.select(
        "_id",
        X.contained_in(F.lit("5"), tags).alias("has_low"),
        X.array_contained_in(F.slice(tags, 1, 2), X.json_array("F", "O", "1", "2")).alias("subset"),
    )


@query(
    "expr_like",
    """
select invoice_no, mode like '%-HIGH' as high, mode not like '_-LOW' as not_low,
       concat(mode, '%') like '1-URG%|%' escape '|' as escaped from sales""",
)
def expr_like(t):
    percent = F.concat(C("mode"), F.lit("%"))
    return t.sales.select(
        "invoice_no",
        X.like(C("mode"), "%-HIGH").alias("high"),
        X.negate(X.like(C("mode"), "_-LOW")).alias("not_low"),
        X.like(percent, "1-URG%|%", escape="|").alias("escaped"),
    )


@query(
    "expr_between",
    "select invoice_no, amount between 100000 and 200000 as inside, date not between date '1996-01-01' and date '1997-12-31' as outside from sales",
)
def expr_between(t):
    days = [F.lit(d).cast("date") for d in ("1996-01-01", "1997-12-31")]
    return t.sales.select(
        "invoice_no",
        X.between(C("amount"), 100000, 200000).alias("inside"),
        X.negate(X.between(C("date"), *days)).alias("outside"),
    )


@query(
    "expr_regexp",
    """
select txn_id, regexp_matches(description, '0(12|34)[0-9] p') as hit,
       not regexp_matches(description, '^Customer') as other from raw_bank""",
)
def expr_regexp(t):
    return t.raw_bank.select(
        "txn_id",
        X.regexp(C("description"), "0(12|34)[0-9] p").alias("hit"),
        X.negate(X.regexp(C("description"), "^Customer")).alias("other"),
    )


@query(
    "expr_regexp_column",
    """
select txn_id, regexp_matches(description, substring(type, 1, 1) || '.*t$') as hit,
       description like concat('%', substring(mode, 3, 1), '%') as near from raw_bank""",
)
def expr_regexp_column(t):
    return t.raw_bank.select(
        "txn_id",
        X.regexp(C("description"), F.concat(F.substring("type", 1, 1), F.lit(".*t$"))).alias("hit"),
        X.like(C("description"), F.concat(F.lit("%"), F.substring("mode", 3, 1), F.lit("%"))).alias("near"),
    )


@query(
    "expr_overlaps",
    """
select _id, list_has_any(tags, ['1','2','P']) as shares, not list_has_any(['LOW','URGENT'], tags) as apart
from orders_docs""",
)
def expr_overlaps(t):
    tags = D.at("tags")
    return t.orders_docs.select(
        "_id",
        X.overlaps(tags, X.json_array("1", "2", "P")).alias("shares"),
        X.negate(X.overlaps(X.json_array("LOW", "URGENT"), tags)).alias("apart"),
    )


@query(
    "expr_arith",
    """
select l_orderkey as k, l_linenumber as n, l_partkey as p, l_suppkey as s, l_quantity as q,
       l_partkey + l_suppkey as plus, l_partkey - l_suppkey as minus, l_partkey * 3 as times,
       case when l_discount <> 0 then l_quantity / l_discount end as per, l_partkey % 7 as rest, -l_linenumber as neg
from lineitem""",
)
def expr_arith(t):
    part, supp = C("l_partkey"), C("l_suppkey")
    return t.given("lineitem").select(
        C("l_orderkey").alias("k"),
        C("l_linenumber").alias("n"),
        part.alias("p"),
        supp.alias("s"),
        C("l_quantity").alias("q"),
        X.arith("+", part, supp).alias("plus"),
        X.arith("-", part, supp).alias("minus"),
        X.arith("*", part, 3).alias("times"),
        X.arith("div", C("l_quantity"), C("l_discount")).alias("per"),
        X.arith("%", part, 7).alias("rest"),
        X.sign("-", C("l_linenumber")).alias("neg"),
    )


@query(
    "expr_bits",
    """
select event_id, user_id & 12 as b_and, user_id | 12 as b_or, xor(user_id, 12) as b_xor, user_id << 3 as b_left,
       user_id >> 1 as b_right, ~user_id as b_not from events""",
)
def expr_bits(t):
    user = C("user_id")
    twelve = F.lit(12).cast("bigint")
    return t.given("events").select(
        "event_id",
        X.bits("&", user, twelve).alias("b_and"),
        X.bits("|", user, twelve).alias("b_or"),
        X.bits("^", user, twelve).alias("b_xor"),
        X.bits("<<", user, 3).alias("b_left"),
        X.bits(">>", user, 1).alias("b_right"),
        X.bit_not(user).alias("b_not"),
    )


def _stamp(column):
    """Wall clock time with six decimals, whatever the session's zone."""
    text = column.cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


_DUCK_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


@query(
    "expr_interval",
    "select event_id, "
    + ", ".join(
        f"{_DUCK_STAMP.format(f'ts {op} interval {n} {unit}')} as plus_{unit}"
        for op, n, unit in (
            ("+", 1500, "microsecond"), ("+", 90, "second"), ("-", 5, "minute"), ("+", 7, "hour"), ("+", 45, "day"),
            ("-", 2, "week"), ("+", 13, "month"), ("+", 2, "quarter"), ("-", 1, "year"),
        )
    )
    + " from events",
)
def expr_interval(t):
    amounts = {
        "microsecond": 1500, "second": 90, "minute": -5, "hour": 7, "day": 45, "week": -2, "month": 13, "quarter": 2,
        "year": -1,
    }
    return t.given("events").select(
        "event_id",
        *[_stamp(X.interval_add(C("ts"), n, unit)).alias(f"plus_{unit}") for unit, n in amounts.items()],
    )


@query(
    "expr_interval_composite",
    f"""
select event_id, {_DUCK_STAMP.format("ts + interval 10 minute + interval 20 second")} as minute_second,
       {_DUCK_STAMP.format("ts - interval 1 day - interval 2 hour - interval 3 minute - interval 4 second")} as day_second,
       {_DUCK_STAMP.format("ts + interval 1 year + interval 3 month")} as year_month,
       {_DUCK_STAMP.format("ts + interval 2 second + interval 500000 microsecond")} as second_microsecond,
       {_DUCK_STAMP.format("ts - interval 5 hour - interval 30 minute")} as hour_minute
from events""",
)
def expr_interval_composite(t):
    made = {
        "minute_second": X.interval_composite(C("ts"), "10:20", "MINUTE_SECOND"),
        "day_second": X.interval_composite(C("ts"), "1 2:3:4", "DAY_SECOND", sign=-1),
        "year_month": X.interval_composite(C("ts"), "1-3", "YEAR_MONTH"),
        "second_microsecond": X.interval_composite(C("ts"), "2.5", "SECOND_MICROSECOND"),
        "hour_minute": X.interval_composite(C("ts"), "-5:30", "HOUR_MINUTE"),
    }
    return t.given("events").select("event_id", *[_stamp(v).alias(k) for k, v in made.items()])


@query(
    "expr_interval_column",
    f"""
select event_id, {_DUCK_STAMP.format("ts + to_minutes(user_id) + to_seconds(event_id % 60)")} as minute_second,
       {_DUCK_STAMP.format("ts - to_days(cast(user_id % 9 as integer)) - to_hours(event_id % 24)")} as day_hour,
       {_DUCK_STAMP.format("ts + to_seconds(user_id) + to_microseconds((event_id % 10) * 100000)")} as second_microsecond,
       {_DUCK_STAMP.format("ts + to_hours(user_id)")} as hour_only
from events""",
)
def expr_interval_column(t):
    text = {
        "minute_second": ("MINUTE_SECOND", F.concat("user_id", F.lit(":"), C("event_id") % 60)),
        "day_hour": ("DAY_HOUR", F.concat(F.lit(" -"), C("user_id") % 9, F.lit(" "), C("event_id") % 24)),
        "second_microsecond": ("SECOND_MICROSECOND", F.concat("user_id", F.lit("."), C("event_id") % 10)),
        "hour_only": ("DAY_HOUR", C("user_id").cast("string")),
    }
    made = {name: X.interval_composite(C("ts"), amount, unit) for name, (unit, amount) in text.items()}
    return t.given("events").select("event_id", *[_stamp(v).alias(k) for k, v in made.items()])


@query(
    "expr_cast",
    """
select invoice_no, cast(try_cast(amount as decimal(12,1)) as double) as as_decimal, left(party, 9) as as_char,
       octet_length(encode(left(mode, 4))) as binary_size,
       try_cast(try_cast(trim(amount) as decimal(38,10)) as bigint) as as_signed,
       case when try_cast(trim(amount) as decimal(38,10)) >= 0 then try_cast(try_cast(trim(amount) as decimal(38,10)) as bigint) end as as_unsigned,
       cast(case when regexp_full_match(trim(date), '[0-9]{4}-[0-9]{2}-[0-9]{2}') then try_cast(trim(date) as date) end
            as varchar) as as_date
from raw_sales""",
)
def expr_cast(t):
    return t.raw_sales.select(
        "invoice_no",
        X.cast_as(C("amount"), "DECIMAL(12,1)").cast("double").alias("as_decimal"),
        X.cast_as(C("party"), "CHAR(9)").alias("as_char"),
        F.octet_length(X.cast_as(C("mode"), "BINARY(4)")).cast("bigint").alias("binary_size"),
        X.cast_as(C("amount"), "SIGNED").alias("as_signed"),
        X.cast_as(C("amount"), "UNSIGNED").cast("bigint").alias("as_unsigned"),
        X.cast_as(C("date"), "DATE").cast("string").alias("as_date"),
    )


@query(
    "expr_cast_time",
    f"""
select event_id, cast(user_id as decimal(20,0))::bigint as as_unsigned, strftime(ts, '%H:%M:%S') as as_time,
       {_DUCK_STAMP.format("ts")} as as_datetime, cast(props->>'$.k' as bigint) as as_json
from events""",
)
def expr_cast_time(t):
    stamp = _stamp(C("ts"))
    return t.given("events").select(
        "event_id",
        X.cast_as(C("user_id"), "UNSIGNED").cast("bigint").alias("as_unsigned"),
        X.cast_as(stamp, "TIME").alias("as_time"),
        _stamp(X.cast_as(stamp, "DATETIME")).alias("as_datetime"),
        F.variant_get(X.cast_as(C("props"), "JSON"), "$.k", "bigint").alias("as_json"),
    )


@query(
    "expr_json_object",
    """select concat('{"id":', event_id, ',"kind":"', event_type, '","user":{"id":', user_id, '}}') as doc from events""",
)
def expr_json_object(t):
    user = F.struct(C("user_id").alias("id"))
    return t.given("events").select(
        X.json_object({"id": C("event_id"), "kind": C("event_type"), "user": user}).alias("doc")
    )


@query(
    "expr_json_array",
    """select event_id, concat('["', event_type, '","', upper(event_type), '"]') as doc from events""",
)
def expr_json_array(t):
    return t.given("events").select(
        "event_id", F.to_json(X.json_array(C("event_type"), F.upper("event_type"))).alias("doc")
    )


# a JSON text with an object and an array, built from each event
_DOC = """concat('{"user":{"id":', user_id, ',"kind":"', event_type, '"},"list":[', user_id, ',', event_id, ',7],"p":', props, '}')"""


def _docs(t):
    return t.given("events").select("event_id", F.expr(_DOC).alias("doc"))


@query(
    "expr_doc_path",
    f"""
select event_id, cast(doc->>'$.user.id' as bigint) as user_id, doc->>'$.user.kind' as kind,
       cast(doc->>'$.list[1]' as bigint) as second, cast(doc->>'$.p.k' as bigint) as k, doc->>'$.no.where' as missing
from (select event_id, {_DOC} as doc from events)""",
)
def expr_doc_path(t):
    doc = C("doc")
    return _docs(t).select(
        "event_id",
        X.doc_path(doc, "$.user.id", "bigint").alias("user_id"),
        X.doc_path(doc, "$.user.kind").alias("kind"),
        X.doc_path(doc, "$.list[1]", "bigint").alias("second"),
        X.doc_path(doc, "$.p.k", "bigint").alias("k"),
        X.doc_path(doc, "$.no.where").alias("missing"),
    )


@query(
    "expr_doc_path_wildcard",
    f"""
select event_id, concat_ws(',', user_id, event_id, 7) as elements,
       concat_ws(',', user_id, event_type) as members from events""",
)
def expr_doc_path_wildcard(t):
    doc = C("doc")
    return _docs(t).select(
        "event_id",
        F.concat_ws(",", X.doc_path_elements(doc, "$.list[*]")).alias("elements"),
        F.concat_ws(",", X.doc_path_members(F.get_json_object(doc, "$.user"))).alias("members"),
    )


@query(
    "expr_doc_path_anywhere",
    "select _id, concat_ws(',', name, concat('inner ', zip)) as names from orders_docs",
)
def expr_doc_path_anywhere(t):
    coll = D.set_path(t.orders_docs, "address.name", F.concat(F.lit("inner "), D.at("address.zip")))
    schema: T.StructType = coll.schema["doc"].dataType
    names = X.doc_path_anywhere(C("doc"), schema, "name")
    return coll.select("_id", F.concat_ws(",", names).alias("names"))


@query(
    "expr_contained_in_scalar",
    """
select event_id, cast(props->>'$.k' as bigint) = 40 as has_k, event_type = 'click' as is_click,
       list_contains([user_id, event_id, 7], 7) as in_list from events""",
)
def expr_contained_in_scalar(t):
    events = t.given("events").withColumn("doc", F.expr(_DOC))
    return events.select(
        "event_id",
        X.json_contained_in(40, C("props"), "$.k", "bigint").alias("has_k"),
        X.contained_in("click", C("event_type"), T.StringType()).alias("is_click"),
        X.json_contained_in(7, C("doc"), "$.list", "bigint").alias("in_list"),
    )


@query(
    "expr_doc_path_objects",
    """
select _id, array_to_string(list_transform(lines, lambda l: l.part), ',') as parts,
       array_to_string(list_transform(lines, lambda l: l.flag), ',') as flags, lines[1].n as first_n from order_lines""",
)
def expr_doc_path_objects(t):
    doc = F.to_json("doc")
    return t.order_lines.select(
        "_id",
        F.concat_ws(",", X.doc_path_elements(doc, "$.lines[*].part")).alias("parts"),
        F.concat_ws(",", X.doc_path_elements(doc, "$.lines[*].flag")).alias("flags"),
        X.doc_path(doc, "$.lines[0].n", "int").alias("first_n"),
    )


@query(
    "expr_doc_path_anywhere_arrays",
    "select _id, array_to_string(list_transform(lines, lambda l: l.part), ',') as parts from order_lines",
)
def expr_doc_path_anywhere_arrays(t):
    schema: T.StructType = t.order_lines.schema["doc"].dataType
    return t.order_lines.select("_id", F.concat_ws(",", X.doc_path_anywhere(C("doc"), schema, "part")).alias("parts"))


@query(
    "expr_func",
    "select ledger_id, upper(name) as up, substring(name, 1, 4) as head, length(type) as n from ledgers",
)
def expr_func(t):
    return t.ledgers.select(
        "ledger_id",
        X.func("upper", C("name")).alias("up"),
        X.func("substring", C("name"), 1, 4).alias("head"),
        X.func("length", C("type")).alias("n"),
    )
