"""Table statements, document statements and expressions on small frames."""

import datetime

import pytest
from books import tuples
from pyspark.sql import functions as F

from daybook.functions import borders as N
from daybook.functions import exprs as X
from daybook.operators import documents as D
from daybook.operators import tables as B


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            ("1", ("Ines", ("4051", None, "9 Mill Row"), [2, 3])),
            ("2", ("Tariq", ("777001", "Basel", "5 Canal Way"), [3, 4])),
            ("3", ("Uma", None, [])),
        ],
        "_id string, doc struct<name: string, address: struct<zip: string, city: string, street: string>, list: array<int>>",
    )


def docs(coll):
    return {r._id: r.doc for r in D.as_table(coll).collect()}


def test_merge_patch_merges_objects_and_removes_with_null(people):
    once = D.patch(people, {"name": "Noor", "address": {"zip": "8002"}}, "_id = '1'")
    assert docs(once)["1"] == '{"name":"Noor","address":{"zip":"8002","street":"9 Mill Row"},"list":[2,3]}'
    assert docs(once)["2"] == docs(people)["2"]
    gone = D.patch(once, {"address": None}, "_id = '1'")
    assert docs(gone)["1"] == '{"name":"Noor","list":[2,3]}'


def test_merge_patch_adds_and_replaces_members(people):
    more = D.patch(people, {"translations": ["Welsh"], "info": {"by": {"name": "S", "age": None}}})
    assert docs(more)["3"] == '{"name":"Uma","list":[],"translations":["Welsh"],"info":{"by":{"name":"S"}}}'
    filled = D.patch(people, {"address": {"zip": "1", "city": None}}, "_id = '3'")
    assert docs(filled)["3"] == '{"name":"Uma","address":{"zip":"1"},"list":[]}'
    typed = D.patch(people, {"address": "none", "list": {"n": 1}})
    assert docs(typed)["2"] == '{"name":"Tariq","address":"none","list":{"n":1}}'


def test_merge_patch_only_where(people):
    some = D.patch(people, {"extra": {"a": 1}, "address": {"country": "FR"}}, "doc.name = 'Tariq'")
    got = docs(some)
    assert got["2"].endswith('"extra":{"a":1}}') and '"country":"FR"' in got["2"]
    assert got["1"] == docs(people)["1"] and got["3"] == docs(people)["3"]


def test_merge_patch_expressions(people):
    coll = D.patch(
        people,
        {
            "zip": F.try_subtract(D.at("address.zip").try_cast("bigint"), F.lit(300000)),
            "street": F.concat(D.at("name"), F.lit(" lives in "), D.at("address.street")),
        },
        "_id = '2'",
    )
    row = D.fields(D.get_one(coll, "2"), {"zip": "zip", "street": "street"}).first()
    assert tuple(row) == (477001, "Tariq lives in 5 Canal Way")


def test_set_change_unset(people):
    assert docs(D.set_path(people, "address.city", "Rome"))["1"].count("Rome") == 1
    assert docs(D.set_path(people, "address.city", "Rome"))["3"] == docs(people)["3"]  # no parent
    assert docs(D.set_path(people, "no.where", 1)) == docs(people)
    assert docs(D.set_path(people, "age", 7, "_id = '2'"))["2"].endswith('"age":7}')
    assert "Rome" not in docs(D.change_path(people, "address.city", "Rome"))["1"]
    assert "Rome" in docs(D.change_path(people, "address.city", "Rome"))["2"]
    assert docs(D.unset(people, "address", "list"))["2"] == '{"name":"Tariq"}'
    assert docs(D.unset(people, "address.city", "name", condition="doc.name = 'Tariq'"))["2"].startswith('{"address":{"zip"')
    for change in (lambda: D.set_path(people, "_id", "9"), lambda: D.unset(people, "_id"), lambda: D.patch(people, {"_id": 1})):
        with pytest.raises(ValueError):
            change()


def test_arrays(people):
    assert docs(D.array_append(people, "list", 9))["3"].endswith('"list":[9]}')
    assert docs(D.array_insert(people, "list[1]", 9))["1"].endswith('"list":[2,9,3]}')
    assert docs(D.array_insert(people, "list[0]", 9))["2"].endswith('"list":[9,3,4]}')
    assert docs(D.array_insert(people, "list[7]", 9))["2"].endswith('"list":[3,4,9]}')
    assert docs(D.array_append(people, "name", 9)) == docs(people)
    with pytest.raises(ValueError):
        D.array_insert(people, "list", 9)


def test_add_upsert_replace_remove(spark, people):
    one = D.set_path(D.get_one(people, "1"), "name", "New")
    with pytest.raises(Exception, match="duplicate"):
        D.add(people, one).collect()
    renamed = one.withColumn("_id", F.lit("9"))
    assert D.add(people, renamed).count() == 4
    for twice in (D.add, D.add_or_replace, D.replace):
        with pytest.raises(Exception, match="duplicate|twice"):
            twice(people, renamed.unionByName(renamed)).collect()
    assert docs(D.add_or_replace(people, one.unionByName(renamed)))["1"].startswith('{"name":"New"')
    assert D.add_or_replace(people, one.unionByName(renamed)).count() == 4
    with pytest.raises(Exception, match="does not match"):
        D.add_or_replace_one(people, "2", one).collect()
    assert docs(D.add_or_replace_one(people, "2", one.drop("_id")))["2"].startswith('{"name":"New"')
    assert docs(D.replace_one(people, "2", one))["2"].startswith('{"name":"New"')
    assert D.replace(people, renamed).count() == 3
    assert docs(D.remove(people, "doc.address.city = 'Basel'")).keys() == {"1", "3"}
    assert docs(D.remove_one(people, "1")).keys() == {"2", "3"}
    assert docs(D.remove_first(people, ["doc.name DESC"], 1)).keys() == {"1", "2"}
    versions = one.withColumn("v", F.lit(1)).unionByName(D.set_path(one, "name", "Newest").withColumn("v", F.lit(2)))
    assert docs(D.latest(versions, "v"))["1"].startswith('{"name":"Newest"')


def test_null_ids_and_ties(spark, people):
    nameless = people.limit(1).withColumn("_id", F.lit(None).cast("string"))
    both = people.unionByName(nameless)
    assert D.remove_one(both, "1").count() == 3
    assert D.add(people, nameless.unionByName(nameless)).count() == 5
    versions = D.set_path(people, "name", "B").unionByName(D.set_path(people, "name", "A")).withColumn("v", F.lit(1))
    assert {r.doc["name"] for r in D.latest(versions, "v").collect()} == {"B"}


def test_array_elements(spark):
    coll = spark.createDataFrame(
        [("1", (["a", "b"], [(1, "x"), (2, "y")])), ("2", ([], [])), ("3", (None, [(5, None)]))],
        "_id string, doc struct<tags: array<string>, lines: array<struct<n: int, s: string>>>",
    )
    tags = lambda c: {r._id: r.doc.tags for r in c.collect()}
    lines = lambda c: {r._id: r.doc.lines for r in c.collect()}
    assert tags(D.set_path(coll, "tags[0]", "Q")) == {"1": ["Q", "b"], "2": ["Q"], "3": None}
    assert tags(D.set_path(coll, "tags[7]", "Q", "_id <> '2'")) == {"1": ["a", "b", "Q"], "2": [], "3": None}
    assert tags(D.change_path(coll, "tags[0]", "Q")) == {"1": ["Q", "b"], "2": [], "3": None}
    assert tags(D.unset(coll, "tags[0]")) == {"1": ["b"], "2": [], "3": None}
    assert tags(D.unset(coll, "tags[1]", condition="_id = '1'"))["1"] == ["a"]
    assert lines(D.change_path(coll, "lines[0].n", 9)) == {"1": [(9, "x"), (2, "y")], "2": [], "3": [(9, None)]}
    assert lines(D.set_path(coll, "lines[1].s", "z"))["1"] == [(1, "x"), (2, "z")]
    assert lines(D.unset(coll, "lines[0].s"))["1"] == [(1, None), (2, "y")]
    assert lines(D.unset(coll, "lines[0]")) == {"1": [(2, "y")], "2": [], "3": []}
    for path in ("tags[*]", "tags[-1]", "tags[x]"):
        with pytest.raises(ValueError):
            D.set_path(coll, path, "Q")
    doc = F.col("doc")
    found = coll.select(X.doc_path_anywhere(doc, coll.schema["doc"].dataType, "n").alias("n")).collect()
    assert [r.n for r in found] == [["1", "2"], [], ["5"]]


def test_array_paths_and_membership_in_json(spark):
    texts = ['{"a":[7]}', '{"a":[]}', '{"a":["q",null]}', '{"a":[{"b":1},{"c":2}]}', '{"a":5}', '{"x":1}', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        X.doc_path_elements(F.col("t"), "$.a[*]").alias("e"),
        X.doc_path_elements(F.col("t"), "$.a[*].b").alias("b"),
        X.json_contained_in(7, F.col("t"), "$.a", "int").alias("seven"),
        X.json_contained_in(5, F.col("t"), "$.a", "int").alias("five"),
        X.json_contained_in(None, F.col("t"), "$.a", "int").alias("null"),
    ).collect()
    assert [r.e for r in got] == [["7"], [], ["q", None], ['{"b":1}', '{"c":2}'], None, None, None]
    assert [r.b for r in got][:4] == [[], [], [], ["1"]]
    assert [r.seven for r in got] == [True, False, False, False, False, None, None]
    assert [r.five for r in got] == [False, False, False, False, True, None, None]
    assert [r.null for r in got] == [False, False, True, False, False, None, None]


def test_whole_numbers_of_any_size(spark):
    texts = ['{"k":{"n":99999999999999999999999999}}', '{"k":{"n":3.0}}', '{"k":{"n":3.5}}', '{"k":{}}', '{"k":{"n":"3"}}']
    df = spark.createDataFrame([(t,) for t in texts], "txt string")
    found = [r.violations for r in D.judge(df, "txt", {"k.n": "integer"}, required=["k.n"]).collect()]
    assert found == [[], [], ["type:k.n"], ["missing:k.n"], ["type:k.n"]]


def test_overlaps(people):
    lists = D.at("list")

    def ids(condition):
        return sorted(r._id for r in D.find(people, condition).collect())

    assert ids(X.overlaps(X.json_array(1, 2, 3), lists)) == ["1", "2"]
    assert ids(X.overlaps(lists, X.json_array(4))) == ["2"]
    assert ids(~X.overlaps(X.json_array(1, 2, 3), lists)) == ["3"]
    assert ids(X.array_contained_in(lists, X.json_array(2, 3))) == ["1", "3"]


def test_paths(people):
    assert D.fields(people, {"z": "address.zip", "x": "list[1]"}).orderBy("z").collect()[1].x == 3
    with pytest.raises(ValueError):
        D.at("a[b]")


def test_validate(spark):
    texts = ['{"k":1,"s":"x"}', '{"k":"1","s":"x"}', '{"k":1}', "{", '{"k":1.5,"s":null}', None]
    df = spark.createDataFrame([(t,) for t in texts], "txt string")
    good, bad = D.validate(df, "txt", {"k": "integer", "s": "string"}, required=["s"])
    assert [r.txt for r in good.collect()] == [texts[0]]
    found = {r.txt: r.violations for r in bad.collect()}
    assert found[texts[1]] == ["type:k"] and found[texts[2]] == ["missing:s"] and found["{"] == ["malformed"]
    assert "type:k" in found[texts[4]] and found[None] == ["malformed"]
    everything, nothing = D.validate(df, "txt", {}, level="OFF")
    assert everything.count() == 6 and nothing.count() == 0
    with pytest.raises(ValueError):
        D.validate(df, "txt", {}, level="MAYBE")


def test_table_changes(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "c", None)], "id int, s string, n int")
    assert tuples(B.update(df, {"s": "'z'", "n": "n + id"}, "s = 'a'")) == [(1, "z", 11), (2, None, 20), (3, "c", None)]
    assert tuples(B.update_topn(df, "id", {"n": "0"}, ["n DESC"], 1)) == [(1, "a", 10), (2, None, 0), (3, "c", None)]
    assert tuples(B.delete(df, "s = 'a'")) == [(2, None, 20), (3, "c", None)]
    assert B.delete(df).count() == 0
    assert tuples(B.delete_topn(df, "id", ["n"], 1)) == [(1, "a", 10), (2, None, 20)]
    assert tuples(B.insert(df, df.select("id").limit(1)))[-1][0] == 3
    assert [r.id for r in B.page(df, ["n DESC"], 2, 1).collect()] == [1, 3]
    for wrong in (lambda: B.update(df, {"x": "1"}), lambda: B.insert(df, df.withColumn("x", F.lit(1)))):
        with pytest.raises(ValueError):
            wrong()


def test_parameters(spark, sales):
    named = B.free_sql(spark, "select invoice_no from {sales} where party = :p", {"p": "Harbour Bakery"}, sales=sales)
    placed = B.free_sql(spark, "select invoice_no from {sales} where party = ? and amount > ?", ["Harbour Bakery", 1000], sales=sales)
    assert named.count() == 2 and placed.count() == 1
    hostile = B.free_sql(spark, "select * from {sales} where party = :p", {"p": "x' or '1'='1"}, sales=sales)
    assert hostile.count() == 0
    assert [r.invoice_no for r in B.page_after(sales, ["amount DESC", "invoice_no"], 2, [1000, "A-6"]).collect()] == ["A-2", "A-5"]
    assert [r.invoice_no for r in B.page_after(sales, ["invoice_no"], 2).collect()] == ["A-1", "A-2"]
    sales.createOrReplaceTempView("tst_sales")
    assert B.list_tables(spark, "ts__sales") == ["tst_sales"] and B.list_tables(spark, "ts_sales") == []
    assert B.list_tables(spark, "tst%") == ["tst_sales"] and B.list_tables(spark, "nothing%") == []


@pytest.mark.parametrize(
    "unit, value, want",
    [
        ("SECOND_MICROSECOND", "1.5", "2024-01-31 00:00:01.500000"),
        ("MINUTE_MICROSECOND", "1:2.000003", "2024-01-31 00:01:02.000003"),
        ("MINUTE_SECOND", "10:20", "2024-01-31 00:10:20.000000"),
        ("HOUR_MICROSECOND", "1:2:3.4", "2024-01-31 01:02:03.400000"),
        ("HOUR_SECOND", "1:2:3", "2024-01-31 01:02:03.000000"),
        ("HOUR_MINUTE", "-1:30", "2024-01-30 22:30:00.000000"),
        ("DAY_MICROSECOND", "1 0:0:0.000001", "2024-02-01 00:00:00.000001"),
        ("DAY_SECOND", "1 2:3:4", "2024-02-01 02:03:04.000000"),
        ("DAY_MINUTE", "1 2:3", "2024-02-01 02:03:00.000000"),
        ("DAY_HOUR", "1 2", "2024-02-01 02:00:00.000000"),
        ("DAY_HOUR", "5", "2024-01-31 05:00:00.000000"),
        ("YEAR_MONTH", "1-1", "2025-02-28 00:00:00.000000"),
    ],
)
def test_composite_intervals(spark, unit, value, want):
    start = F.lit(datetime.datetime(2024, 1, 31)).cast("timestamp_ntz")
    moved = X.interval_composite(start, value, unit)
    assert spark.range(1).select(F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0] == want


def test_wrong_names_are_refused():
    for wrong in (
        lambda: X._composite_parts("SECOND_DAY", "1"),
        lambda: X._composite_parts("DAY_HOUR", "1 2 3"),
        lambda: X._composite_parts("DAY_MONTH", "1 2"),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_expressions(spark):
    row = spark.range(1).select(
        X.arith("/", 1, 0).alias("div"),
        X.arith("%", 7, 4).alias("mod"),
        X.is_(F.lit(None).cast("boolean"), True).alias("unknown"),
        X.like(F.lit("50%"), "50|%", "|").alias("escaped"),
        X.cast_as(F.lit("12.345"), "DECIMAL(5,1)").cast("string").alias("dec"),
        X.cast_as(F.lit("abcdef"), "CHAR(3)").alias("chars"),
        X.cast_as(F.lit("x"), "SIGNED").alias("bad"),
        X.cast_as(F.lit("12.7"), "SIGNED").alias("rounded"),
        X.cast_as(F.lit(-5), "UNSIGNED").alias("negative"),
        X.cast_as(F.lit("18446744073709551615"), "UNSIGNED").cast("string").alias("largest"),
        X.cast_as(F.lit("18446744073709551616"), "UNSIGNED").alias("beyond"),
        X.cast_as(F.lit("2024-01-02 03:04:05"), "TIME").alias("time"),
        X.func("upper", "x").alias("up"),
    ).first()
    assert tuple(row) == (None, 3, False, True, "12.3", "abc", None, 13, None, "18446744073709551615", None, "03:04:05", "X")
    with pytest.raises(ValueError):
        X.cast_as(F.lit(1), "MONEY")
    with pytest.raises(ValueError):
        X.interval_add(F.lit(1), 1, "FORTNIGHT")


def test_borders(spark):
    texts = ("0000-00-00", "2024-01-02 00:00:00", None, "2024-01-05garbage", "2024-01-05T10:00", "2024-01-05 1", "2024-13-05")
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    dates = [r[0] for r in df.select(N.zero_date(F.col("d"))).collect()]
    assert dates == [None, datetime.date(2024, 1, 2), None, None, datetime.date(2024, 1, 5), None, None]
    assert df.select(N.zero_date(F.col("d"), "round")).first()[0] == datetime.date(1, 1, 1)
    with pytest.raises(Exception, match="zero date"):
        df.select(N.zero_date(F.col("d"), "error")).collect()
    with pytest.raises(ValueError):
        N.zero_date(F.col("d"), "guess")
    sets = spark.createDataFrame([("a,b",), ("",), (None,)], "s string")
    assert [r[0] for r in sets.select(N.set_members(F.col("s"))).collect()] == [["a", "b"], [], None]
