"""First n rows, deep pages and parameters."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import references as R
from daybook.operators import tables as B


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(5)
    data = [(f"k{i}", dice.choice([None, *range(40)]), dice.choice([None, "a", "b", "C", "é", ""]), float("nan") if i % 97 == 0 else dice.random()) for i in range(3000)]
    return spark.createDataFrame(data, "id string, n int, s string, x double").repartition(5).cache()


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(B, "IN_PLACE", 50)
    monkeypatch.setattr(B, "CUTS", 7)


@pytest.mark.parametrize("by", [["n", "id"], ["n DESC", "s", "id DESC"], ["x DESC", "id"], ["length(s) DESC", "n", "id"], ["s", "x", "id"]])
@pytest.mark.parametrize("offset,limit", [(0, 100), (1234, 77), (2990, 100), (5000, 100)])
def test_deep_pages(rows, small, by, offset, limit):
    wanted = [r.id for r in B.order(rows, *by).collect()][offset : offset + limit]
    assert [r.id for r in B.page(rows, by, limit, offset).collect()] == wanted


def test_first_n_by_comparison(rows, small):
    wanted = [r.id for r in B.order(rows.filter("n > 3"), "s DESC", "id").collect()][:900]
    changed = B.update_topn(rows, "id", {"s": "'first'"}, ["s DESC"], 900, "n > 3")
    assert sorted(r.id for r in changed.filter("s = 'first'").collect()) == sorted(wanted) and changed.count() == 3000
    assert B.delete_topn(rows, "id", ["s DESC"], 900, "n > 3").filter(F.col("id").isin(wanted)).isEmpty()
    assert B.delete_topn(rows, "id", ["s DESC"], 900, "n > 3").count() == 2100
    # more than there are
    assert B.update_topn(rows, "id", {"s": "'first'"}, ["n"], 2999, "n > 3").filter("s = 'first'").count() == rows.filter("n > 3").count()
    with pytest.raises(ValueError, match="as text"):
        B.first_keys(rows, "id", [F.col("n")], 900)


def test_boundaries_of_keys_that_repeat(spark, small):
    df = spark.createDataFrame([(1 if i < 10 else 2 if i < 2000 else 3,) for i in range(2100)], "n int")
    assert B.boundaries(df, ["n"], [1, 10, 11, 1500, 2000, 2001, 2100, 2101]) == [(1,), (1,), (2,), (2,), (2,), (3,), (3,), None]
    assert B.boundaries(df, ["n DESC"], [1, 101, 2100]) == [(3,), (2,), (1,)]
    assert B.boundaries(df.limit(0), ["n"], [1]) == [None]


def test_parameters(spark):
    values = {"t": "it's \\ :n ?", "n": -5, "big": 2**40, "d": Decimal("1.50"), "x": 0.1, "day": date(2024, 1, 2), "at": datetime(2024, 1, 2, 3, 4, 5, 6), "raw": b"\x00\xff", "no": None, "yes": True, "many": [1, 2]}
    one = spark.range(1).select(*[F.expr(B.bind(f":{name}", {name: value})).alias(name) for name, value in values.items()]).first()
    assert {k: bytes(v) if isinstance(v, bytearray) else v for k, v in one.asDict().items()} == values
    assert B.bind("a = ':x' and `:y` = ? and b::int = ?", [1, 2]) == "a = ':x' and `:y` = 1 and b::int = 2"
    for text, params in ((":a", {}), (":a", {"a": 1, "b": 2}), ("? ?", [1]), ("?", [1, 2])):
        with pytest.raises(ValueError):
            B.bind(text, params)


def test_names_with_one_beginning_leave_few_candidates(spark):
    names = spark.createDataFrame([(f"Customer#{i:09d}",) for i in range(0, 4000, 20)], "name string")
    texts = spark.createDataFrame([(f"Customer#{i:09d} payment, Customer#x",) for i in range(4000)], "t string")
    # anchored at the beginning they share, each text would have at least one
    assert R.contains_candidates(texts, "t", names, "name").count() <= 4000 / 10
    wanted = {f"Customer#{i:09d} payment, Customer#x" for i in range(0, 4000, 20)}
    assert {r.t for r in R.contains_any(texts, "t", names, "name").collect()} == wanted
